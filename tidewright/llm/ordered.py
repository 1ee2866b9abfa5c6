"""Runs of ascending doc_id, for operators that need a document's neighbours or a file order.

Bounds are quantiles of doc_id, one number per run, so nothing but doc_id is read to find them.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def bounds(docs: DataFrame, runs: int | None = None) -> list[int]:
    """Ascending doc_ids that cut the table into about ``runs`` runs (the number of shuffle
    partitions by default) of like size."""
    runs = runs or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / runs for i in range(1, runs)]
    if not shares:
        return []
    found = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), shares, 100 * runs))
    return sorted(set(found.first()[0] or []))


def run(doc_id: Column, cuts: list[int]) -> Column:
    """Number of the run: how many bounds are not above. A null comes first.

    Looked up in two steps, so the work is the square root of the number of runs.
    """
    if not cuts:
        return F.lit(0)
    size = math.isqrt(len(cuts)) + 1
    groups = [cuts[i:i + size] for i in range(0, len(cuts), size)]
    value = F.coalesce(doc_id.cast("long"), F.lit(-1 << 63))
    coarse = F.size(F.filter(F.lit([g[0] for g in groups]), lambda x: x <= value))
    fine = F.array(*[F.lit(g) for g in groups])
    return F.when(coarse == 0, 0).otherwise(
        (coarse - 1) * size + F.size(F.filter(F.get(fine, coarse - 1), lambda x: x <= value)))
