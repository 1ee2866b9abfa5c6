"""Adding and replacing rows of a keyed table."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import round_columns
from ..session import written
from .latest import keep_first


def not_stored(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in a (much larger) stored table.

    The stored keys are first cut down to those that come in: a semi-join can
    broadcast a small batch, so the stored table is only scanned for its key
    column and not shuffled.
    """
    known = stored.select(key).join(rows.select(key), key, "left_semi")
    return rows.join(known, key, "left_anti").select(*rows.columns)


def written_not_stored(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``not_stored`` for a batch of any size.

    The keys are written as tables of their own, so that the planner judges a broadcast by their size:
    of a wide table with many empty columns it takes a key for a small share and would send
    millions of keys to every executor.
    """
    keys = written(rows.select(key).distinct(), "keys")
    known = written(stored.select(key).join(keys, key, "left_semi"), "keys")
    return rows.join(known, key, "left_anti").select(*rows.columns)


def new_rows(incoming: DataFrame, existing: DataFrame, key: str, order: Sequence[str]
             ) -> DataFrame:
    """Incoming rows not stored yet, the first of each key; replays give nothing."""
    unknown = not_stored(incoming, existing.where(F.col(key) != ""), key)
    return keep_first(unknown, [key], order).select(*incoming.columns)


def add_rows(incoming: DataFrame, existing: DataFrame, key: str, order: Sequence[str]
             ) -> DataFrame:
    """Stored rows followed by the new ones."""
    return existing.unionByName(new_rows(incoming, existing, key, order)
                                .select(*existing.columns))


def add_report(incoming: DataFrame, existing: DataFrame, key: str, group: str,
               order: Sequence[str]) -> DataFrame:
    """Rows scanned, added and skipped by group, without writing anything."""
    return change_report(incoming, new_rows(incoming, existing, key, order), group)


def change_report(incoming: DataFrame, changes: DataFrame, group: str) -> DataFrame:
    """Rows scanned, added and skipped by group, where the rows that come in are known."""
    scanned = incoming.groupBy(group).agg(F.count(F.lit(1)).alias("scanned"))
    added = changes.groupBy(group).agg(F.count(F.lit(1)).alias("added"))
    return (scanned.join(added, group, "left")
            .withColumn("added", F.coalesce("added", F.lit(0)))
            .withColumn("skipped", F.col("scanned") - F.col("added")))


def without_groups(existing: DataFrame, group: str, groups: Sequence[str]) -> DataFrame:
    """Rows of all other groups; rows without a group stay."""
    return existing.where(~F.coalesce(F.col(group).isin(*groups), F.lit(False)))


def removed_keys(existing: DataFrame, group: str, groups: Sequence[str], key: str) -> DataFrame:
    """Keys that replacing the groups takes out."""
    return existing.where(F.col(group).isin(*groups)).select(key)


def ratio_guard(existing: DataFrame, incoming: DataFrame, group: str, groups: Sequence[str],
                force: bool = False, least: float = 0.5) -> DataFrame:
    """Whether each group may be replaced: one row per group asked for.

    Nothing stored: yes. Nothing coming in: never. Fewer than half as many rows:
    only when forced. A group without any incoming file is judged as well.
    """
    spark = existing.sparkSession
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(g) for g in groups])).alias(group))

    def counted(df: DataFrame, name: str) -> DataFrame:
        return (df.where(F.col(group).isin(*groups)).groupBy(group)
                .agg(F.count(F.lit(1)).alias(name)))

    counts = (wanted.join(counted(existing, "existing"), group, "left")
              .join(counted(incoming, "incoming"), group, "left")
              .fillna(0, ["existing", "incoming"]))
    ratio = F.when(F.col("existing") > 0, F.col("incoming") / F.col("existing"))
    passed = (F.when(F.col("existing") == 0, True).when(F.col("incoming") == 0, False)
              .otherwise((ratio >= least) | F.lit(force)))
    return round_columns(counts.withColumns({"ratio": ratio, "passed": passed}), 2, "ratio")


def replace_rows(incoming: DataFrame, existing: DataFrame, key: str, group: str,
                 groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of some groups exchanged for the incoming ones; other groups gain new rows."""
    return without_groups(existing, group, groups).unionByName(
        replacing_rows(incoming, existing, key, group, groups, order))


def replacing_rows(incoming: DataFrame, existing: DataFrame, key: str, group: str,
                   groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows of the replaced groups and the new ones of others.

    The ids of a replaced group are not compared with its stored rows, which go.
    """
    fresh = keep_first(incoming, [key], order)
    replaced = fresh.where(F.col(group).isin(*groups))
    others = not_stored(without_groups(fresh, group, groups), existing, key)
    return replaced.select(*existing.columns).unionByName(others.select(*existing.columns))


def replace_report(incoming: DataFrame, existing: DataFrame, key: str, group: str,
                   groups: Sequence[str]) -> DataFrame:
    """Rows scanned, added and skipped by group when some groups are replaced.

    Every id of a replaced group counts as added, as all its stored rows go.
    """
    scanned = incoming.groupBy(group).agg(F.count(F.lit(1)).alias("scanned"))
    ids = incoming.select(group, key).distinct()
    others = not_stored(without_groups(ids, group, groups), existing, key)
    added = ids.where(F.col(group).isin(*groups)).unionByName(others).groupBy(group).agg(
        F.count(F.lit(1)).alias("added"))
    return (scanned.join(added, group, "left")
            .withColumn("added", F.coalesce("added", F.lit(0)))
            .withColumn("skipped", F.col("scanned") - F.col("added")))


def check_references(files: DataFrame, dimension: DataFrame, key: str, area: str,
                     at_area: str) -> DataFrame:
    """Status of each dropped file's key: ok, unknown, or of another area."""
    dim = dimension.select(key, F.col(area).alias("_area"))
    return files.join(dim, key, "left").withColumn(
        "status", F.when(F.col("_area").isNull(), "unknown_key")
        .when(F.col("_area") != at_area, "other_area").otherwise("ok")).drop("_area")


def alias_statuses(stored: DataFrame, added: DataFrame, source: str = "from",
                   target: str = "to") -> DataFrame:
    """What becomes of each new alias: added, skipped or conflict.

    An alias to itself or one that is stored already is skipped; another target
    for a stored or newly given name is a conflict.
    """
    given = added.select(source, target).distinct()
    wanted = given.where(F.col(source) != F.col(target)).groupBy(source).agg(
        F.count(F.lit(1)).alias("_targets"))
    old = stored.select(source, F.col(target).alias("_old"))
    same = F.col(source) == F.col(target)
    known = F.col("_old").isNotNull()
    return (given.join(wanted, source, "left").join(old, source, "left")
            .withColumn("status", F.when(same, "skipped: self-mapping")
                        .when(known & (F.col("_old") == F.col(target)), "skipped: already_exists")
                        .when(known | (F.col("_targets") > 1), "conflict").otherwise("added"))
            .select(source, target, "status"))


def alias_conflicts(stored: DataFrame, added: DataFrame, source: str = "from",
                    target: str = "to") -> DataFrame:
    """All new aliases that stand in conflict."""
    statuses = alias_statuses(stored, added, source, target)
    return statuses.where(F.col("status") == "conflict").select(source, target)


def merge_aliases(stored: DataFrame, added: DataFrame, source: str = "from", target: str = "to"
                  ) -> DataFrame:
    """Stored aliases with the new ones; any conflict stops it before anything is written."""
    statuses = alias_statuses(stored, added, source, target)
    if not statuses.where(F.col("status") == "conflict").isEmpty():
        raise ValueError("some aliases have another target; alias_conflicts() gives them")
    return stored.select(source, target).unionByName(
        statuses.where(F.col("status") == "added").select(source, target))


def next_version(version: str) -> str:
    """Version text with its patch number raised; other texts stay."""
    parts = version.split(".")
    if len(parts) != 3 or not all(part.isdigit() for part in parts):
        return version
    return ".".join([*parts[:2], str(int(parts[2]) + 1)])
