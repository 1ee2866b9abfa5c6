"""Hourly and daily payloads that hold one array per variable."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions.numbers import one_decimal, round_columns, to_int


def unpack(payload: DataFrame, keys: Sequence[str], arrays: Sequence[str],
           block: str = "hourly") -> DataFrame:
    """One row per time: arrays side by side, short ones filled with null."""
    zipped = F.arrays_zip(*[F.col(f"{block}.{name}").alias(name) for name in ["time", *arrays]])
    rows = payload.select(*keys, F.explode(zipped).alias("_row"))
    return rows.select(*keys, *[F.col("_row")[name].alias(name) for name in ["time", *arrays]])


def hourly_rows(payload: DataFrame, keys: Sequence[str], arrays: Sequence[str],
                hours: Sequence[int] | None = tuple(fixed.TARGET_HOURS)) -> DataFrame:
    """Rows of an hourly payload with ``day`` (text) and ``hour``; bad times left out."""
    rows = unpack(payload, keys, arrays).withColumns({
        "day": F.substring("time", 1, 10),
        "hour": to_int(F.substring("time", 12, 2)).cast("int")})
    rows = rows.where((F.length("time") >= 13) & F.col("hour").isNotNull())
    return rows if hours is None else rows.where(F.col("hour").isin(*hours))


def daily_rows(payload: DataFrame, keys: Sequence[str], array: str, name: str) -> DataFrame:
    """Rows of a daily payload, one decimal; days without value left out."""
    rows = unpack(payload, keys, [array], "daily").where(F.col(array).isNotNull())
    return rows.select(*keys, F.col("time").alias("day"),
                       one_decimal(F.col(array).cast("double")).alias(name))


def forecast_rows(marine: DataFrame, weather: DataFrame, keys: Sequence[str], time: str = "time",
                  hours: Sequence[int] = tuple(fixed.TARGET_HOURS)) -> DataFrame:
    """Sea and weather forecast of the same hours; rows without wave or wind left out.

    marine: time, wave_height, wave_direction, wind_wave_height; weather: time,
    wind_speed_10m, wind_direction_10m, precipitation. ``time`` is text.
    """
    on = [*keys, time]
    rows = (marine.where(to_int(F.substring(time, 12, 2)).isin(*hours))
            .where(F.col("wave_height").isNotNull())
            .join(weather.where(F.col("wind_speed_10m").isNotNull()), on))
    raw = rows.select(
        *keys, F.col(time).alias("t"), F.col("wave_height").alias("wave"),
        F.col("wind_speed_10m").alias("wind"),
        F.coalesce(F.col("wind_direction_10m").cast("int"), F.lit(0)).alias("dir"),
        F.col("wave_direction").cast("int").alias("wave_dir"),
        F.col("wind_wave_height").alias("wind_wave"),
        F.coalesce("precipitation", F.lit(0.0)).alias("rain"))
    return round_columns(round_columns(raw, 2, "wave", "wind_wave"), 1, "wind", "rain")


def read_forecast(spark, path: str, by_line: bool = False) -> DataFrame:
    """Rows of a stored forecast document, or of all documents of a folder with one in each line."""
    row = ("struct<t:string,wave:double,wind:double,dir:int,waveDir:int,windWave:double,"
           "rain:double>")
    document = spark.read.schema(f"updated string, rows array<{row}>").option(
        "multiLine", not by_line).json(path)
    return document.select("updated", F.inline("rows")).withColumnsRenamed(
        {"waveDir": "wave_dir", "windWave": "wind_wave"})
