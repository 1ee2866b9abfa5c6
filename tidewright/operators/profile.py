"""Statistical profiles: summaries, frequencies and distributions by group."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import compass, fixed
from ..functions.numbers import blank_as_null, finite, round_columns, zero_as_null
from .ranks import cell_anchor, value_counts, values_at_ranks

SUMMARY = ["n", "mean", "median", "std", "min", "max", "p25", "p75"]


def metrics_long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per input row and metric: keys, ``metric``, ``value``.

    A generator rather than unpivot(): it passes the keys through unchanged, so
    a plan that reads the result twice can share one shuffle.
    """
    pairs = [F.lit(len(metrics))]
    for metric in metrics:
        pairs += [F.lit(metric), F.col(f"`{metric}`").cast("double")]
    return df.select(*keys, F.stack(*pairs).alias("metric", "value"))


def summary(df: DataFrame, keys: Sequence[str], value: str = "value",
            digits: int = 2) -> DataFrame:
    """Count, mean, median, population deviation, range and quartiles by key.

    Quartiles are interpolated linearly. A key without values has n = 0 and
    nulls; a single value has no deviation.
    """
    return summary_of_counts(value_counts(df, keys, value), keys, digits)


def summary_of_counts(counts: DataFrame, keys: Sequence[str], digits: int = 2) -> DataFrame:
    """Like summary, on rows per key and value."""
    value, off = F.col("value"), F.col("value") - cell_anchor(F.col("cell"))
    cell_sums = [
        F.sum(F.col("n") * value).alias("_sum"), F.sum(F.col("n") * off).alias("_off"),
        F.sum(F.col("n") * off * off).alias("_off2"),
        F.min("value").alias("_min"), F.max("value").alias("_max")]
    # Squared deviations cell by cell, then moved to the mean of the key: no
    # difference of large sums, so narrow spreads far from zero stay exact.
    from_mean = cell_anchor(F.col("cell")) + F.col("_off") / F.col("_in_cell") - F.col("mean")
    spread = (F.col("_off2") - F.col("_off") * F.col("_off") / F.col("_in_cell")
              + F.col("_in_cell") * from_mean * from_mean)
    key_values = [
        {"_total": F.sum("_sum"), "min": F.min("_min"), "max": F.max("_max")},
        {"mean": F.max(F.col("_total") / F.col("n"))},
        {"_spread": F.sum(F.when(F.col("_in_cell") > 0, spread))}]
    found = values_at_ranks(counts, keys, {
        "_m0": lambda n: F.floor((n - 1) / 2), "_m1": lambda n: F.floor(n / 2),
        "_a0": lambda n: F.floor((n - 1) * 0.25),
        "_a1": lambda n: F.least(F.floor((n - 1) * 0.25) + 1, n - 1),
        "_b0": lambda n: F.floor((n - 1) * 0.75),
        "_b1": lambda n: F.least(F.floor((n - 1) * 0.75) + 1, n - 1),
    }, cell_sums, key_values)

    def quartile(percent: int, low: str, high: str) -> Column:
        at = (F.col("n") - 1) * percent / 100.0
        below = F.floor(at).cast("double")
        return F.when(F.col(low) == F.col(high), F.col(low)).otherwise(
            F.col(low) * (below + 1 - at) + F.col(high) * (at - below))

    middle = F.when(F.col("_m0") == F.col("_m1"), F.col("_m0")).otherwise(
        (F.col("_m0") + F.col("_m1")) / 2.0)
    deviation = F.sqrt(F.greatest(F.col("_spread"), F.lit(0.0)) / F.col("n"))
    out = {
        "mean": F.col("mean"), "median": middle,
        "std": F.when(F.col("n") >= 2, deviation),
        "min": F.col("min"), "max": F.col("max"),
        "p25": quartile(25, "_a0", "_a1"), "p75": quartile(75, "_b0", "_b1"),
    }
    raw = found.select(*keys, "n", *[column.alias(name) for name, column in out.items()])
    return round_columns(raw, digits, *out)


def frequency(df: DataFrame, keys: Sequence[str], value: str, digits: int = 1) -> DataFrame:
    """Share of each value within its key, in percent; empty values not counted."""
    counted = (df.where(F.col(value).isNotNull() & (F.col(value) != ""))
               .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")))
    return _share(counted, keys, digits)


def _share(counted: DataFrame, keys: Sequence[str], digits: int) -> DataFrame:
    """The total of a key is a second aggregate, reduced in each task, and joined by the key."""
    rows, by = counted, {k: f"_total_{i}" for i, k in enumerate(keys)}
    totals = counted.groupBy(*[F.col(k).alias(n) for k, n in by.items()]).agg(
        F.sum("n").alias("_total"))
    if not keys:  # one total, joined by a few parts of the rows
        by = {"_part": "_total_part"}
        rows = counted.withColumn("_part", F.pmod(F.hash(*counted.columns), F.lit(16)))
        totals = totals.withColumn("_total_part", F.explode(F.sequence(F.lit(0), F.lit(15))))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in by.items()])
    shared = rows.join(totals, on).withColumn("pct", F.col("n") / F.col("_total") * 100)
    return round_columns(shared.select(*counted.columns, "pct"), digits, "pct")


def amount(count: Column) -> Column:
    """Catch count as a whole number; missing, zero and non-finite mean one."""
    return F.coalesce(zero_as_null(finite(count)), F.lit(1.0)).cast("long")


def month_totals(df: DataFrame, keys: Sequence[str], day: str, count: str) -> DataFrame:
    """Catch count by month of the year, all twelve months present."""
    month = F.month(day)
    wide = df.where(F.col(day).isNotNull()).groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(month == m, amount(F.col(count)))), F.lit(0)).alias(str(m))
          for m in range(1, 13)])
    return wide.unpivot([*keys], [F.col(f"`{m}`") for m in range(1, 13)], "month", "total"
                        ).withColumn("month", F.col("month").cast("int"))


def width_bins(df: DataFrame, keys: Sequence[str], value: str, fallback: str | None = None,
               width: int = 2, unit: str = "℃") -> DataFrame:
    """Rows per bin of equal width. A missing or zero value uses the fallback."""
    picked = finite(F.col(value))
    if fallback is not None:
        picked = F.coalesce(zero_as_null(picked), finite(F.col(fallback)))
    low = (F.floor(picked / width) * width).cast("long")
    label = F.concat(low.cast("string"), F.lit("〜"), (low + width).cast("string"), F.lit(unit))
    return (df.select(*keys, label.alias("bin")).where(F.col("bin").isNotNull())
            .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n")))


def edge_bins(df: DataFrame, keys: Sequence[str], value: str,
              edges: Sequence[tuple] = tuple(fixed.SPEED_BINS)) -> DataFrame:
    """Rows per bin with the given upper edges (exclusive)."""
    (first, name), *others = edges
    label = F.when(F.col(value) < first, name)
    for edge, name in others:
        label = label.otherwise(name) if edge is None else label.when(F.col(value) < edge, name)
    return (df.where(F.col(value).isNotNull()).select(*keys, label.alias("bin"))
            .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n")))


def sector_shares(df: DataFrame, keys: Sequence[str], degrees: str) -> DataFrame:
    """Share of each of eight compass sectors, in percent."""
    sectors = df.select(*keys, compass.sector8(F.col(degrees)).alias("sector"))
    return frequency(sectors, keys, "sector")


def catch_days(df: DataFrame, group: str, day: str) -> DataFrame:
    return df.where(F.col(day).isNotNull()).select(group, day).distinct()


def point_profiles(catch: DataFrame, current: DataFrame, group: str, day: str, point: str,
                   speed: str, temp: str, salinity: str, direction: str
                   ) -> tuple[DataFrame, DataFrame]:
    """Current conditions at every point on the catch days of a group.

    Gives (summaries of speed, temperature and salinity; sector shares). A
    point without any speed and temperature is left out of both.
    """
    days = catch_days(catch, group, day).join(current, day)
    keys = [group, point]
    numbers = summary(metrics_long(days, keys, [speed, temp, salinity]), [*keys, "metric"])
    known = F.sum(F.when(F.col("metric").isin(speed, temp), F.col("n")))
    numbers = (numbers.withColumn("_known", known.over(Window.partitionBy(*keys)))
               .where(F.col("_known") > 0).drop("_known"))
    present = days.groupBy(*keys).agg((F.count(speed) + F.count(temp)).alias("_known")).where(
        F.col("_known") > 0).drop("_known")
    return numbers, sector_shares(days, keys, direction).join(present, keys, "left_semi")


def label_shares(catch: DataFrame, trend: DataFrame, group: str, day: str,
                 label: str) -> DataFrame:
    """Share of catch days under each trend label; days without trend not counted."""
    days = catch_days(catch, group, day).join(trend.select(day, label), day, "left")
    return frequency(days, [group], label)


def headline(df: DataFrame, group: str, day: str, least_days: int = 2) -> DataFrame:
    """Rows, catch days, first and last day by group; groups of few days dropped."""
    per_day = df.groupBy(group, day).agg(F.count(F.lit(1)).alias("n"))
    return per_day.groupBy(group).agg(
        F.sum("n").alias("total_records"), F.count(day).alias("catch_days"),
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
    ).where(F.col("catch_days") >= least_days)


def fleet_and_boat(df: DataFrame, boat: str, keys: Sequence[str], value: str,
                   fleet: str = "all") -> DataFrame:
    """Summaries for every boat and for the whole fleet from one pass."""
    by_boat = value_counts(df, [boat, *keys], value)
    both = (by_boat.withColumn(boat, F.explode(F.array(F.lit(fleet), F.col(boat).cast("string"))))
            .groupBy(boat, *keys, "value", "cell").agg(F.sum("n").alias("n")))
    return summary_of_counts(both, [boat, *keys])


def month_means(df: DataFrame, day: str, point: str, means: Mapping[str, str],
                digits: int, count_of: str, maxima: Mapping[str, str] | None = None,
                count_name: str = "days") -> DataFrame:
    """Means (and maxima) by year, month and point; null values not counted."""
    aggs = [F.avg(column).alias(name) for name, column in means.items()]
    aggs += [F.max(column).alias(name) for name, column in (maxima or {}).items()]
    raw = df.groupBy(F.year(day).alias("year"), F.month(day).alias("month"), point).agg(
        *aggs, F.count(count_of).alias(count_name))
    return round_columns(raw, digits, *means, *(maxima or {}))


def big_thresholds(df: DataFrame, group: str, weight: str, share: float = 0.8,
                   digits: int | None = 2) -> DataFrame:
    """Weight at which the upper part of each group's catch begins."""
    named = df.where(F.col(weight).isNotNull() & F.col(group).isNotNull() & (F.col(group) != ""))
    found = values_at_ranks(value_counts(named, [group], weight), [group],
                            {"threshold": lambda n: F.floor(n * share)}).drop("n")
    return found if digits is None else round_columns(found, digits, "threshold")


def catch_sets(df: DataFrame, thresholds: DataFrame, day: str, group: str, weight: str
               ) -> DataFrame:
    """Per day the sorted groups caught (``caught``), and those with a big catch (``big``).

    A group has a big catch on a day if its heaviest catch reaches the threshold,
    so the rows are reduced to one per day and group before anything is joined.
    """
    heaviest = df.where(F.col(day).isNotNull()).groupBy(day, group).agg(
        F.max(weight).alias("_heaviest"))
    marked = heaviest.join(thresholds.select(group, "threshold"), group, "left")
    big = F.when(F.col("_heaviest") >= F.col("threshold"), F.col(group))
    return marked.groupBy(day).agg(F.sort_array(F.collect_list(group)).alias("caught"),
                                   F.sort_array(F.collect_list(big)).alias("big"))


def table_counts(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows, distinct days and day range of each key of a table."""
    return headline(df, key, day, least_days=0)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values, in order."""
    return df.where(blank_as_null(F.col(column)).isNotNull()
                    ).select(column).distinct().orderBy(column)
