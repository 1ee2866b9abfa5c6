"""Last row per key, duplicates of earlier rows, latest rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import finite, to_number
from ..session import written


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              keep_null_keys: bool = False) -> DataFrame:
    """The last row of every key in the order of the given columns, then of all others.

    An aggregate, not a window: each task reduces its rows to one per key before
    the shuffle, so a key with very many rows is no burden.
    """
    out = _one_row(df, keys, order, F.max)
    if not keep_null_keys:
        return out
    no_key = F.lit(True)
    for key in keys:
        no_key = no_key & F.col(key).isNotNull()
    return out.where(no_key).unionByName(df.where(~no_key))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the order of the given columns, then of all others."""
    return _one_row(df, keys, order, F.min)


def _one_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    ordered = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ordered]
    if not ordered and not rest:
        return df.distinct()
    row = df.groupBy(*keys).agg(pick(F.struct(*ordered, *rest)).alias("_row"))
    return row.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _filled(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for column in columns:
        condition = condition & (F.coalesce(F.col(column).cast("string"), F.lit("")) != "")
    return condition


def after_first(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Every repeat of a key: (first, again), the numbers of the two rows.

    Rows with an empty key column do not count.
    """
    rows = df.where(_filled(keys)).select(*keys, seq)
    repeated = (rows.groupBy(*keys).agg(F.min(seq).alias("first"), F.count(seq).alias("_rows"))
                .where(F.col("_rows") > 1).drop("_rows"))
    return (rows.join(repeated, [*keys]).where(F.col(seq) > F.col("first"))
            .select("first", F.col(seq).alias("again")))


def near_duplicates(df: DataFrame, keys: Sequence[str], size: str, seq: str,
                    same: Sequence[str], within: int = 2) -> DataFrame:
    """Rows that share the keys with another row of nearly the same size.

    Gives per row (``again``) its number of such partners and the smallest of
    them (``first``), instead of every pair: the output stays as long as the
    input however many rows share a key. A pair of the first and a repeat of the
    ``same`` columns is known already and none of these pairs. Sizes are doubles,
    and a partner's is not below the own less and not above the own plus
    ``within``; those that are not finite numbers are left out.

    Rows are first counted by key and size, and a band only looks into its own
    and the two neighbouring size steps. The smallest row of a band is the partner
    wanted, but for that row itself and for the repeats it is the first of; the
    bands of those few sizes are looked at once more, a few rows of each size.
    """
    rows = (df.where(_filled(keys))
            .withColumn("_size", finite(to_number(F.col(size).cast("string"))))
            .where(F.col("_size").isNotNull())
            .select(seq, "_size", *dict.fromkeys([*keys, *same])))
    repeats = (rows.where(_filled(same)).groupBy(*same)
               .agg(F.count(seq).alias("_same"), F.min(seq).alias("_same_first"))
               .where(F.col("_same") > 1))
    # The first row of each set of repeats, or the row itself, stands for its set.
    rows = rows.join(repeats, [*same], "left").select(
        *keys, F.col(seq).alias("again"), "_size", "_same", "_same_first",
        F.coalesce("_same_first", F.col(seq)).alias("_set"))
    rows = written(rows, "near-rows")  # read five times below

    def step_of(name: str) -> Column:
        """Whole number of steps below, as a double: a long has no room for large sizes."""
        return F.col(name) / within - F.pmod(F.col(name) / within, F.lit(1.0))

    step = step_of("_size")
    steps = F.explode(F.array_distinct(F.array(step - 1, step, step + 1)))
    sizes = rows.groupBy(*keys, "_size").agg(
        F.count("again").alias("_rows"), F.min("again").alias("_first"))
    over = (f"over (partition by {', '.join(f'`{k}`' for k in keys)}, _step order by _size "
            f"range between {within}D preceding and {within}D following)")
    bands = (sizes.withColumn("_step", steps).withColumn("_in_band", F.expr(f"sum(_rows) {over}"))
             .withColumn("_band_first", F.expr(f"min(_first) {over}"))
             .where((F.col("_step") == step) & (F.col("_in_band") > 1))
             .select(*keys, "_size", "_in_band", "_band_first"))
    known = F.when(F.col("again") == F.col("_same_first"), F.col("_same") - 1).when(
        F.col("_same").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    found = rows.join(bands, [*keys, "_size"]).withColumn(
        "partners", F.col("_in_band") - 1 - known).where(F.col("partners") > 0)
    passed_over = F.col("_band_first") == F.col("_set")  # the row itself, or the first of its set

    def smallest(table: DataFrame, per: Sequence[str], count: int) -> DataFrame:
        order = Window.partitionBy(*per).orderBy("again")
        return table.withColumn("_nth", F.row_number().over(order)).where(
            F.col("_nth") <= count).drop("_nth")

    def few(table: DataFrame, per: Sequence[str]) -> DataFrame:
        """The three smallest rows and the smallest rows of two sets."""
        by_set = table.groupBy(*per, "_set").agg(F.min("again").alias("again"))
        columns = [*per, "again", "_set"]
        return smallest(table.select(columns), per, 3).unionByName(
            smallest(by_set, per, 2).select(columns)).distinct()

    again = found.where(passed_over).select(*keys, F.col("_size").alias("_at")).distinct()
    again = again.withColumn("_step", F.explode(F.array_distinct(F.array(*[
        step_of("_at") + i for i in (-1, 0, 1)]))))
    near = few(rows, [*keys, "_size"]).withColumn("_step", step).join(again, [*keys, "_step"]).where(
        F.col("_size").between(F.col("_at") - within, F.col("_at") + within))
    lists = few(near, [*keys, "_at"]).groupBy(*keys, F.col("_at").alias("_size")).agg(
        F.collect_list(F.struct("again", "_set")).alias("_near"))  # five at most

    leads = F.coalesce(F.col("again") == F.col("_same_first"), F.lit(False))
    other = F.filter("_near", lambda n: F.when(leads, n["_set"] != F.col("_set")).otherwise(
        (n["again"] != F.col("again")) & (n["again"] != F.col("_set"))))
    return found.join(lists, [*keys, "_size"], "left").select(
        "again", F.when(passed_over, F.array_min(other)["again"]).otherwise(
            F.col("_band_first")).alias("first"), "partners")


def duplicates(df: DataFrame, seq: str, id_column: str, detail: str,
               same: Sequence[str], near_keys: Sequence[str], size: str) -> DataFrame:
    """All four levels of duplicates in one table: level, first, again, partners.

    The columns that are compared are worked out once and written to the shared folder.
    """
    df = written(df.select(*dict.fromkeys([seq, id_column, detail, *same, *near_keys, size])), "duplicate-rows")

    def level(name, found):
        if "partners" not in found.columns:
            found = found.withColumn("partners", F.lit(1).cast("long"))
        return found.select(F.lit(name).alias("level"), "first", "again", "partners")

    return (level("complete", after_first(df, [id_column], seq))
            .unionByName(level("source", after_first(df, [detail], seq)))
            .unionByName(level("pseudo", after_first(df, same, seq)))
            .unionByName(level("near", near_duplicates(df, near_keys, size, seq, same))))


def newest(df: DataFrame, order: Sequence[Column], rows: int) -> DataFrame:
    """The newest rows: days wanted times points per day."""
    return df.orderBy(*order).limit(rows)
