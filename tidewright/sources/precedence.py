"""Several sources for the same rows: which one counts."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..operators.latest import keep_first


def first_source(sources: Mapping[str, DataFrame], keys: Sequence[str],
                 order: Sequence[str] = tuple(fixed.SOURCE_ORDER)) -> DataFrame:
    """For every key all rows of the first source that has it, with ``source``.

    The keys of each source are reduced in every task and joined back, so the
    rows of a key (a day of a gridded field, say) never meet in one task; of the
    sources only the key columns are read for that.
    """
    ranked = [sources[name].withColumns({"source": F.lit(name), "_priority": F.lit(i)})
              for i, name in enumerate(n for n in order if n in sources)]
    rows = reduce(DataFrame.unionByName, ranked)
    best = rows.groupBy(*keys).agg(F.min("_priority").alias("_priority"))
    return rows.join(best, [*keys, "_priority"], "left_semi").select(
        *[c for c in rows.columns if c != "_priority"])


def one_row_by_source(sources: Mapping[str, DataFrame], keys: Sequence[str],
                      order: Sequence[str] = tuple(fixed.SOURCE_ORDER)) -> DataFrame:
    """Like first_source where a source has one row per key: a single aggregate."""
    ranked = [sources[name].withColumns({"source": F.lit(name), "_priority": F.lit(i)})
              for i, name in enumerate(n for n in order if n in sources)]
    return keep_first(reduce(DataFrame.unionByName, ranked), keys, ["_priority"]).drop("_priority")


def archive_and_forecast(archive: DataFrame, forecast: DataFrame, keys: Sequence[str], day: str,
                         as_of: Column, lag_days: int = fixed.ARCHIVE_LAG_DAYS) -> DataFrame:
    """Archive up to some days ago, forecast from the day after."""
    border = F.date_sub(as_of, lag_days)
    return one_row_by_source(
        {"forecast": forecast.where(F.col(day) > border),
         "archive": archive.where(F.col(day) <= border)}, keys, ["forecast", "archive"])


def hourly_else_daily(hourly: DataFrame, daily: DataFrame, chunk: Sequence[str]) -> DataFrame:
    """Daily values only for chunks without any hourly value."""
    return hourly.unionByName(daily.join(hourly.select(*chunk).distinct(), [*chunk], "left_anti"))
