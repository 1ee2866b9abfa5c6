"""Catch records joined with condition and current tables."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed, sky
from ..functions.numbers import zero_as_null


def with_conditions(catch: DataFrame, condition: DataFrame, day: str, station: str,
                    condition_day: str, condition_station: str,
                    columns: Mapping[str, str]) -> DataFrame:
    """Every catch row with the condition columns of its day and station.

    ``condition`` has one row per day and station (see keep_last). It is not
    hinted: it is small for a region and a broadcast then, but grows with
    stations, and the planner measures that. The catch side is never reduced or
    widened, so a hot day and station only makes one side of the join uneven,
    which adaptive execution splits.
    """
    right = condition.select(
        F.col(condition_day).alias("_day"), F.col(condition_station).alias("_station"),
        *[F.col(f"`{name}`").alias(out) for name, out in columns.items()])
    return (catch.join(right, (catch[day] == right["_day"]) & (catch[station] == right["_station"]),
                       "left").drop("_day", "_station"))


def points_wide(current: DataFrame, day: str, point: str, points: Sequence[str],
                columns: Mapping[str, str]) -> DataFrame:
    """One row per day with the columns of some points side by side."""
    return current.where(F.col(point).isin(*points)).groupBy(day).agg(
        *[F.max(F.when(F.col(point) == name, F.col(column))).alias(f"{name}_{out}")
          for name in points for column, out in columns.items()])


def with_point_currents(catch: DataFrame, current: DataFrame, day: str, spot: str,
                        current_day: str, point: str, columns: Mapping[str, str],
                        points: Sequence[str] = tuple(fixed.TWO_POINTS),
                        word: str = fixed.TWO_POINT_SPOT_WORD) -> DataFrame:
    """Catch rows with the currents at two points, where the spot has a word in it.

    ``current`` has one row per day and point. Both points come with one join.
    """
    wide = points_wide(current, current_day, point, points, columns).withColumnRenamed(
        current_day, "_day")
    condition = (catch[day] == wide["_day"]) & catch[spot].contains(word)
    return catch.join(wide, condition, "left").drop("_day")


def record_export(catch: DataFrame, trend: DataFrame, species: str, day: str, count: str,
                  label: str, out_label: str = "_wt_trend") -> DataFrame:
    """Rows with species and day; counts at least one; the day's trend label."""
    labels = trend.select(F.col(day).alias("_day"), F.col(label).alias(out_label))
    rows = catch.where((F.coalesce(F.col(species), F.lit("")) != "") & F.col(day).isNotNull())
    return (rows.join(labels, rows[day] == labels["_day"], "left").drop("_day")
            .withColumn(count, F.coalesce(zero_as_null(F.col(count)), F.lit(1.0)))
            .withColumn(out_label, F.coalesce(out_label, F.lit(fixed.UNKNOWN))))


def condition_rows(gaps: DataFrame, weather: DataFrame, water: DataFrame, waves: DataFrame,
                   station: str, day: str) -> DataFrame:
    """One condition row per missing station day: observations and calendar columns."""
    keys = [station, day]
    rows = (gaps.join(weather, keys, "left").join(water, keys, "left")
            .join(waves, keys, "left"))
    return (rows.withColumn("月齢", sky.moon_age(F.col(day)))
            .withColumn("潮汐", sky.tide_class(F.col("月齢")))
            .withColumn("月相", sky.moon_phase(F.col("月齢"))))
