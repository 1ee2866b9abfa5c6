"""Gridded ocean fields in long form: day, depth, lat, lon and variables."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed


def with_known_names(grid: DataFrame,
                     aliases: Mapping[str, Sequence[str]] = fixed.VARIABLE_ALIASES) -> DataFrame:
    """Columns renamed to the usual names; of several aliases the first present counts."""
    present = set(grid.columns)
    renames = {}
    for name, others in aliases.items():
        found = next((other for other in others if other in present), None)
        if found and found != name:
            renames[found] = name
    return grid.withColumnsRenamed(renames)


def in_box(grid: DataFrame, box: Mapping[str, tuple] = fixed.GRID_BOX) -> DataFrame:
    """Cells inside the box; plain comparisons, so the file scan skips the rest."""
    for column, (low, high) in box.items():
        if column in grid.columns:
            grid = grid.where(F.col(column).between(low, high))
    return grid


def by_day(reanalysis: DataFrame, forecast: DataFrame, day: str,
           last: str = fixed.REANALYSIS_LAST_DAY) -> DataFrame:
    """Reanalysis up to a day, forecast after it."""
    border = F.lit(last).cast("date")
    return reanalysis.where(F.col(day) <= border).unionByName(
        forecast.where(F.col(day) > border), allowMissingColumns=True)


def merge_variables(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Fields of different variables on their common cells; the first value counts."""
    merged = parts[0]
    for part in parts[1:]:
        shared = [c for c in part.columns if c in merged.columns and c not in keys]
        renamed = part.withColumnsRenamed({c: f"_{c}" for c in shared})
        merged = merged.join(renamed, [*keys], "full_outer")
        merged = merged.withColumns({c: F.coalesce(c, f"_{c}") for c in shared}).drop(
            *[f"_{c}" for c in shared])
    return merged
