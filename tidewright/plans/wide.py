"""The tables published from a master: catch, integrated and two-point."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions.text import external_source
from ..operators.enrich import with_conditions, with_point_currents
from ..operators.normalise import catch_columns, design_sorted

OWNERS = ["boat_id", "area_id"]


def catch_table(master: DataFrame, by_design: bool = False, force_empty: bool = False) -> DataFrame:
    """Nineteen columns; newest first if asked for, else in no order."""
    return catch_columns(design_sorted(master) if by_design else master, force_empty)


def _published(master: DataFrame) -> DataFrame:
    return master.select(*fixed.CATCH_COLUMNS, *OWNERS).withColumn(
        "source", external_source(F.col("source")))


def _blank(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in order, every missing value an empty text."""
    return rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                         for c in columns])


def integrated_columns() -> list[str]:
    return [*fixed.CATCH_COLUMNS, *fixed.CONDITION_TO_INTEGRATED.values(), *OWNERS]


def integrated_table(master: DataFrame, condition: DataFrame) -> DataFrame:
    """Catch columns, fifteen condition columns and owners: 36 texts.

    ``condition`` has one row per 日付 and 地点名.
    """
    rows = with_conditions(_published(master), condition, "date", "nearest_station", "日付",
                           "地点名", fixed.CONDITION_TO_INTEGRATED)
    return _blank(rows, integrated_columns())


def two_point_columns() -> list[str]:
    return [*fixed.CATCH_COLUMNS, *fixed.CONDITION_TO_TWO_POINT_HEAD.values(),
            *[f"{point}_{name}" for point in fixed.TWO_POINTS
              for name in fixed.CURRENT_TO_TWO_POINT.values()],
            *fixed.CONDITION_TO_TWO_POINT_TAIL.values(), *OWNERS]


def two_point_table(master: DataFrame, condition: DataFrame, current: DataFrame) -> DataFrame:
    """Catch columns, conditions and the currents at two points: 44 texts.

    ``current`` has one row per date and point.
    """
    rows = with_conditions(
        _published(master), condition, "date", "nearest_station", "日付", "地点名",
        {**fixed.CONDITION_TO_TWO_POINT_HEAD, **fixed.CONDITION_TO_TWO_POINT_TAIL})
    rows = with_point_currents(rows, current, "date", "spot", "date", "point",
                               fixed.CURRENT_TO_TWO_POINT)
    return _blank(rows, two_point_columns())
