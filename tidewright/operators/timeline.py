"""One row per station day: sea, current, moon and what was caught."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions.numbers import round_columns
from .profile import big_thresholds, catch_sets
from .trend import calendar_trend


def timeline(conditions: DataFrame, current: DataFrame, catch: DataFrame, station: str,
             day: str, point: str, at_station: str, at_point: str, species: str,
             weight: str) -> DataFrame:
    """Daily series of one station with trends, catch species and big-catch species.

    conditions: station, day, water, moon, phase; current: point, day, speed,
    direction; both with one row per key. catch: day, species, weight.
    """
    days = conditions.where(F.col(station) == at_station)
    flow = current.where(F.col(point) == at_point)
    water = calendar_trend(days, station, day, "water", fixed.TEMP_TREND, 2).select(
        day, F.col("ma7").alias("water_ma7"), F.col("label").alias("water_trend"),
        F.col("change1").alias("water_change1"))
    speed = calendar_trend(flow, point, day, "speed", fixed.SPEED_TREND, 3).select(
        day, "speed", F.col("ma7").alias("speed_ma7"), F.col("label").alias("speed_trend"))
    sets = catch_sets(catch, big_thresholds(catch, species, weight, digits=None), day, species,
                      weight)
    joined = (days.select(day, "water", "moon", "phase")
              .join(water, day, "left").join(speed, day, "left")
              .join(flow.select(day, "direction"), day, "left")
              .join(sets, day, "left")
              .withColumns({f"species_{kind}": F.coalesce(kind, F.array().cast("array<string>"))
                            for kind in ("caught", "big")}).drop("caught", "big"))
    return round_columns(joined, 2, "water", "moon", "speed", "speed_ma7", "direction")
