"""Calendar-day trends of daily series."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed
from ..functions.numbers import round_columns


def trend_label(change: Column, words: Mapping = fixed.TEMP_TREND) -> Column:
    """Label of a change; compared from the steepest step down."""
    chain = F.when(change.isNull(), fixed.UNKNOWN)
    for bound, name in words["rise"]:
        chain = chain.when(change >= bound, name)
    for bound, name in words["fall"]:
        chain = chain.when(change <= bound, name)
    return chain.otherwise(words["flat"])


def calendar_trend(daily: DataFrame, point: str, day: str, value: str,
                   words: Mapping = fixed.TEMP_TREND, digits: int = 2) -> DataFrame:
    """Seven-day mean, one-day and seven-day change and label of a daily series.

    ``daily`` has one row per point and day; days may be missing. Windows count
    calendar days, so a missing day gives a shorter mean and a null change, and
    the label follows the rounded change. One point's days go to one task, which
    is a bounded number of rows.
    """
    # Newest first: a mean adds its days up from the newest to the oldest, which
    # settles the last digit.
    by_day = Window.partitionBy(point).orderBy(F.unix_date(day).desc())

    def days_before(days: int) -> Column:
        return F.max(value).over(by_day.rangeBetween(days, days))

    known = daily.where(F.col(value).isNotNull())
    windows = known.withColumns({
        "ma7": F.avg(value).over(by_day.rangeBetween(0, 6)),
        "change1": F.col(value) - days_before(1),
        "change7": F.col(value) - days_before(7),
    })
    return round_columns(windows, digits, "ma7", "change1", "change7").withColumn(
        "label", trend_label(F.col("change7"), words))


def last_days(daily: DataFrame, point: str, day: str, days: int = 30,
              number: str = "_nth") -> DataFrame:
    """The calendar days up to the latest day of each point, present or not, numbered from 0."""
    return daily.groupBy(point).agg(F.max(day).alias("_latest")).select(
        point, F.posexplode(F.sequence(F.date_sub("_latest", days - 1), F.col("_latest"),
                                       F.expr("interval 1 day"))).alias(number, day))


def trailing_period(df: DataFrame, day: str, last: Column, months: int) -> DataFrame:
    """Rows of the period of whole months that ends at a day."""
    return df.where(F.col(day).between(F.add_months(last, -months), last))
