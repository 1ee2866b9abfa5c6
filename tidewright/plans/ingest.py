"""Dropped catch files into the master table."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed
from ..operators import merge, normalise
from ..operators.latest import keep_first
from ..session import written
from ..sources import files, sinks
from ..sources.versions import Versioned

@dataclass
class Ingest:
    """What an ingest would do: nothing of the master is written before commit()."""

    rows: DataFrame       # the master after the ingest
    report: DataFrame     # boat_id, scanned, added, skipped
    rejected: DataFrame   # _file, reason
    removed: DataFrame    # record ids taken out by a replace
    changes: DataFrame    # rows that come in: new ones, and all of replaced boats
    replaced: tuple[str, ...] = ()  # boats whose stored rows go


def read_drops(spark: SparkSession, inbox: str, boats: DataFrame, area: str
               ) -> tuple[DataFrame, DataFrame]:
    """(rows of accepted files with boat_id, rejected files with the reason).

    Only files named for a boat are looked at. A file is refused whole if its
    boat is unknown or of another area, its header differs or a row is of
    another width.
    """
    marked, verdicts = files.judged(spark, inbox, fixed.CATCH_COLUMNS)
    boat = files.boat_of_file(F.col("_file"))
    verdicts = verdicts.withColumn("boat_id", boat).where(F.col("boat_id").isNotNull())
    sound = verdicts.where(F.col("reason").isNull() & (F.col("rows") > 0)).select("_file", "boat_id")
    status = merge.check_references(sound, boats, "boat_id", "area_id", area)
    refused = status.where(F.col("status") != "ok").select("_file", F.col("status").alias("reason"))
    rejected = refused.unionByName(verdicts.where(F.col("reason").isNotNull()).select("_file", "reason"))
    rejected = written(rejected, "rejected")  # one row a file at most
    rows = files.without_files(marked, rejected, fixed.CATCH_COLUMNS)
    return rows.withColumn("boat_id", boat).where(F.col("boat_id").isNotNull()), rejected


def ingest(master: DataFrame, drops: DataFrame, rejected: DataFrame, area: str,
           mode: str = "add", replace_boats: Sequence[str] = (), force: bool = False,
           normalise_dates: bool = True) -> Ingest:
    """Merge accepted rows into a master.

    "add" takes rows whose content id is new. "replace" exchanges all rows of the
    named boats, and refuses to if any file was rejected or any of those boats
    fails the row-count guard. Of rows with one id the first in file order counts.

    Ids are worked out once: the rows that come in, one for each id, and those that change the
    master go to the shared folder, and the result is read from there.
    """
    if mode not in ("add", "replace") or (mode == "replace") != bool(replace_boats):
        raise ValueError("replace needs boats to replace, add must not name any")
    order = [c for c in ("_file", "_place") if c in drops.columns]
    incoming = normalise.to_master(drops, F.col("boat_id"), F.lit(area), normalise_dates,
                                   passed=order)
    if mode == "add":
        fresh = written(keep_first(incoming, ["record_id"], order).select(*master.columns), "incoming")
        new = written(merge.written_not_stored(fresh, master.where("record_id <> ''"), "record_id"), "new")
        report = merge.change_report(drops, new, "boat_id")
        return Ingest(master.unionByName(new), report, rejected, master.select("record_id").limit(0), new)
    if not rejected.isEmpty():
        raise ValueError("files were rejected; the master stays as it is")
    failed = merge.ratio_guard(master, drops, "boat_id", replace_boats, force).where(
        ~F.col("passed")).select("boat_id").collect()  # at most the boats asked for
    if failed:
        raise ValueError(f"too few rows for {sorted(r.boat_id for r in failed)}")
    fresh = written(keep_first(incoming, ["record_id"], order).select(*master.columns), "incoming")
    others = merge.without_groups(fresh, "boat_id", replace_boats)
    changes = written(fresh.where(F.col("boat_id").isin(*replace_boats)).unionByName(
        merge.written_not_stored(others, master, "record_id")), "changes")
    report = merge.change_report(drops, changes, "boat_id")
    kept = merge.without_groups(master, "boat_id", replace_boats)
    return Ingest(kept.unionByName(changes), report, rejected,
                  merge.removed_keys(master, "boat_id", replace_boats, "record_id"), changes,
                  tuple(replace_boats))


def commit(result: Ingest, master: DataFrame, root: str, stamp: str) -> str | None:
    """Keep a copy of the master as it was, then write the new one to its own path.

    Nothing is written, and no path returned, if nothing comes in and nothing goes.
    """
    if result.report.where("added > 0").isEmpty() and result.removed.isEmpty():
        return None
    sinks.snapshot(master, root, stamp)
    path = f"{root}/master/{stamp}"
    result.rows.write.mode("errorifexists").parquet(path)
    return path


def commit_changes(result: Ingest, table: Versioned) -> int | None:
    """Bring an ingest into a master kept by generations and partitioned by boat_id.

    Rows of other boats are neither read nor written again, and the generation before stays as the
    copy. No generation comes about, and None is returned, if nothing comes in and nothing goes.
    """
    if result.report.where("added > 0").isEmpty() and result.removed.isEmpty():
        return None
    if result.replaced:
        return table.replace(result.changes, result.replaced)
    return table.append(result.changes)
