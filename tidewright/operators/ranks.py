"""Exact order statistics of large groups.

A percentile aggregate keeps every distinct value of a group in one task. Here
a group is first counted by value, then by cell: a fixed logarithmic grid over
the doubles that grows with a value, so cells sort as values do. Running counts
over the cells tell which cell holds a wanted rank, and only the values of those
few cells are put in order. No task ever sees more than one cell's distinct
values or one group's cell counts.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import finite

CELLS_PER_E_FOLD = 512
# ln of the smallest double is above -745, so shifted cells stay positive.
_SHIFT = 746 * CELLS_PER_E_FOLD


def cell(value: Column) -> Column:
    size = F.floor(F.ln(F.abs(value)) * CELLS_PER_E_FOLD) + _SHIFT
    return F.when(value > 0, size).when(value < 0, -size).when(value == 0, F.lit(0))


def cell_anchor(cell_no: Column) -> Column:
    """A value inside or at the border of a cell."""
    size = F.exp((F.abs(cell_no) - _SHIFT) / float(CELLS_PER_E_FOLD))
    return F.when(cell_no == 0, F.lit(0.0)).otherwise(F.signum(cell_no) * size)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number of rows (``n``) per key and value, with the value's cell.

    Empty values of a key give one row with n = 0, so the key itself is kept;
    values that are not finite count as empty.
    """
    number = finite(F.col(value))
    return (df.groupBy(*keys, number.alias("value")).agg(F.count(number).alias("n"))
            .withColumn("cell", cell(F.col("value"))))


def values_at_ranks(counts: DataFrame, keys: Sequence[str],
                    ranks: Mapping[str, Callable[[Column], Column]],
                    cell_sums: Sequence[Column] = (),
                    key_values: Sequence[Mapping[str, Column]] = ()) -> DataFrame:
    """One row per key with its number of values and the value at each wanted rank.

    ``counts`` comes from value_counts. A rank, from zero, is a function of the
    number of values. ``cell_sums`` are further aggregates per cell, and
    ``key_values`` window expressions over a key's cells, worked out one mapping
    after the other; they come out as columns, too.
    """
    per_key = Window.partitionBy(*keys)

    def holds(rank: Callable[[Column], Column], size: str) -> Column:
        at = rank(F.col("n"))
        return (at >= F.col("_before")) & (at < F.col("_before") + F.col(size))

    cells = (counts.groupBy(*keys, "cell").agg(F.sum("n").alias("_in_cell"), *cell_sums)
             .withColumns({"_before": F.sum("_in_cell").over(per_key.orderBy("cell"))
                           - F.col("_in_cell"),
                           "n": F.sum("_in_cell").over(per_key)}))
    for mapping in key_values:
        cells = cells.withColumns({name: column.over(per_key) for name, column in mapping.items()})
    carried = ["n", *[name for mapping in key_values for name in mapping]]
    wanted = reduce(lambda a, b: a | b, [holds(rank, "_in_cell") for rank in ranks.values()])
    cells = cells.where(wanted | (F.col("n") == 0)).select(*keys, "cell", "_before", *carried)
    # Null-safe, so both sides read the counts in the same form and share one shuffle.
    other = counts.select(*[F.col(c).alias(f"_{c}") for c in [*keys, "cell"]], "value",
                          F.col("n").alias("_rows"))
    on = reduce(lambda a, b: a & b, [cells[c].eqNullSafe(other[f"_{c}"]) for c in [*keys, "cell"]])
    in_cell = Window.partitionBy(*keys, "cell").orderBy("value")
    values = cells.join(other, on).withColumn(
        "_before", F.col("_before") + F.sum("_rows").over(in_cell) - F.col("_rows"))
    return values.groupBy(*keys).agg(
        *[F.first(name).alias(name) for name in carried],
        *[F.max(F.when(holds(rank, "_rows"), F.col("value"))).alias(name)
          for name, rank in ranks.items()])
