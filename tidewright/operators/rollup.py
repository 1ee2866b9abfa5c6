"""Hourly observations to daily values."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import compass, fixed, text
from ..functions.numbers import one_decimal


def at_hours(hourly: DataFrame, hour: str, hours: Sequence[int] = tuple(fixed.TARGET_HOURS)
             ) -> DataFrame:
    return hourly.where(F.col(hour).isin(*hours))


def at_first_maximum(value: Column, of: Column, *when: Column) -> Column:
    """Aggregate: the value at the earliest of the largest measures."""
    order = F.struct(of, *[-w for w in when])
    return F.max_by(value, F.when(of.isNotNull(), order))


def daily_weather(hourly: DataFrame, station: str, day: str, hour: str, temp: str, wind: str,
                  direction: str, rain: str, code: str, order: Sequence[str] = ()) -> DataFrame:
    """Daily temperatures, strongest wind and its direction, rain, weather code.

    The direction is that of the first hour with the strongest wind; ``order``
    tells rows of one hour apart where there are several.
    """
    daily = at_hours(hourly, hour).groupBy(station, day).agg(
        *weather_values(hour, temp, wind, direction, rain, code, order))
    return weather_texts(daily)


def weather_values(hour: str, temp: str, wind: str, direction: str, rain: str, code: str,
                   order: Sequence[str] = ()) -> list[Column]:
    """The aggregates of a day's weather; weather_texts() ends them."""
    return [
        one_decimal(F.avg(temp)).alias("気温_平均"), one_decimal(F.max(temp)).alias("気温_最高"),
        one_decimal(F.min(temp)).alias("気温_最低"), one_decimal(F.max(wind)).alias("風速_最大"),
        at_first_maximum(F.col(direction), F.col(wind), F.col(hour),
                         *[F.col(c) for c in order]).alias("_direction"),
        one_decimal(F.sum(rain)).alias("降水量"),
        F.max(F.col(code).cast("int")).alias("天気コード")]


def weather_texts(daily: DataFrame) -> DataFrame:
    """Direction and weather of aggregated days as words."""
    return (daily.withColumn("風向", F.coalesce(compass.sector16(F.col("_direction")), F.lit("")))
            .withColumn("天気", text.weather_text(F.col("天気コード"))).drop("_direction"))


def daily_waves(hourly: DataFrame, station: str, day: str, hour: str, height: str,
                direction: str, period: str) -> DataFrame:
    """Daily highest wave, mean direction as a sector, mean period."""
    daily = at_hours(hourly, hour).groupBy(station, day).agg(
        one_decimal(F.max(height)).alias("最大波高"),
        one_decimal(F.avg(direction)).alias("_direction"),
        one_decimal(F.avg(period)).alias("波周期"))
    return daily.withColumn(
        "波向", F.coalesce(compass.sector16(F.col("_direction")), F.lit(""))).drop("_direction")


def daily_water(hourly: DataFrame, station: str, day: str, hour: str, temp: str) -> DataFrame:
    """Daily mean sea temperature; days without any value are left out."""
    return (at_hours(hourly, hour).groupBy(station, day)
            .agg(one_decimal(F.avg(temp)).alias("水温")).where(F.col("水温").isNotNull()))
