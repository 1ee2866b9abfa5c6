"""Which days are missing, and how to ask for them."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def calendar(spark: SparkSession, first: str, last: str, day: str = "day") -> DataFrame:
    """Every day of a span."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias(day))


def coverage_gaps(wanted: DataFrame, stored: DataFrame, day: str, station: str,
                  stations: Sequence[str], until: Column) -> DataFrame:
    """Wanted days up to a last day that a station has no stored row for.

    Stored rows of stations that are not asked for do not matter.
    """
    days = wanted.where(F.col(day) <= until).select(day).distinct()
    needed = days.withColumn(station, F.explode(F.array(*[F.lit(s) for s in stations])))
    return needed.join(stored.select(day, station), [day, station], "left_anti")


def date_chunks(days: DataFrame, station: str, day: str, longest: int = 60) -> DataFrame:
    """Runs of consecutive days, cut after a number of days: first, last, days."""
    by_day = Window.partitionBy(station).orderBy(day)
    runs = (days.select(station, day).distinct()
            .withColumn("_run", F.date_sub(F.col(day), F.row_number().over(by_day))))
    in_run = Window.partitionBy(station, "_run").orderBy(day)
    return (runs.withColumn("_part", F.floor((F.row_number().over(in_run) - 1) / longest))
            .groupBy(station, "_run", "_part")
            .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                 F.count(day).alias("days")).drop("_run", "_part"))
