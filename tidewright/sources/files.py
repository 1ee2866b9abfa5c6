"""Text files: lenient and strict CSV, inbox discovery, versioned master tables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import fixed
from ..session import written

CORRUPT = "_corrupt"


def _texts(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_lenient(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                 multi_line: bool = False) -> DataFrame:
    """CSV as texts: short rows are padded, long ones cut, nothing is null."""
    rows = (spark.read.schema(_texts(columns)).option("header", True)
            .option("enforceSchema", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').csv(path))
    return rows.fillna("")


def judged(spark: SparkSession, path: str | list[str], columns: Sequence[str],
           multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows as they stand with ``_header``, a row for each file: _file, bad_rows, rows, reason).

    ``reason`` is null for a file that is sound. The verdicts are written, so the files are parsed once
    for them and once for the rows.
    """
    raw = (spark.read.schema(_texts([*columns, CORRUPT])).option("header", False)
           .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
           .option("quote", '"').option("escape", '"').csv(path)
           .withColumns({
               "_file": F.when(F.col("_metadata.file_name").startswith("part-"), F.element_at(
                   F.split("_metadata.file_path", "/"), -2)).otherwise(F.col("_metadata.file_name")),
               "_place": F.struct(F.col("_metadata.file_path").alias("path"),
                                  F.col("_metadata.file_block_start").alias("block"),
                                  F.monotonically_increasing_id().alias("row"))}))
    first = F.regexp_replace(F.col(columns[0]), "^﻿", "")
    is_header = F.lit(True)
    for name, value in zip(columns, [first, *[F.col(c) for c in columns[1:]]]):
        is_header = is_header & value.eqNullSafe(F.lit(name))
    marked = raw.withColumn("_header", is_header)
    parts = marked.groupBy("_file", "_place.path").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(F.when(F.col(CORRUPT).isNotNull(), 1)).alias("_bad"),
        F.count(F.when(F.col("_header"), 1)).alias("_headers"), F.min("_place").alias("_first"),
        F.min(F.when(F.col("_header"), F.col("_place"))).alias("_at"))
    headed = (F.col("_headers") == 1) & F.col("_at").eqNullSafe(F.col("_first"))
    verdicts = parts.groupBy("_file").agg(
        F.sum("_bad").alias("bad_rows"), (F.sum("_rows") - F.sum("_headers")).alias("rows"),
        F.min(headed).alias("_headed"))
    reason = F.when(~F.col("_headed"), "header").when(F.col("bad_rows") > 0, "width")
    return marked, written(verdicts.select("_file", "bad_rows", "rows", reason.alias("reason")), "verdicts")


def without_files(marked: DataFrame, rejected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of all files but the rejected ones, headers left out.

    The rejected files are sent to the rows: there is a row for each, of which the driver has listed
    every one, and an exchange by file would put a whole file into one task.
    """
    return marked.where(~F.col("_header")).join(F.broadcast(rejected.select("_file")), "_file", "left_anti").select(
        *columns, "_file", "_place").fillna("")


def read_strict(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """CSV files whose every row has the header's width: (rows, rejected files).

    One bad row, or a first line that is not the header, rejects its whole file;
    the rows of all other files go on. Rows carry their file's name in ``_file``
    and sort by ``_place`` as they stand in it. A file may be a folder of parts
    written by a job, which then is one file by the folder's name.
    """
    marked, verdicts = judged(spark, path, columns, multi_line)
    rejected = verdicts.where(F.col("reason").isNotNull()).select("_file", "bad_rows", "reason")
    return without_files(marked, rejected, columns), rejected


def boat_of_file(file_name: Column) -> Column:
    """Boat id in a drop file's name; null for other files."""
    return F.when(file_name.rlike(fixed.DROP_FILE_PATTERN) & ~file_name.startswith("_"),
                  F.regexp_extract(file_name, fixed.DROP_FILE_PATTERN, 1))


def master_version(columns: Sequence[str]) -> str:
    """2.0.0 or 1.0.0 by the column names; anything else is an error."""
    if list(columns) == fixed.MASTER_COLUMNS:
        return "2.0.0"
    if list(columns) == fixed.MASTER_V1_COLUMNS:
        return "1.0.0"
    raise ValueError(f"unknown master columns: {list(columns)}")


def upgrade_master(master: DataFrame, boat: str = "", area: str = "") -> DataFrame:
    """A master of either version in the present columns."""
    if master_version(master.columns) == "1.0.0":
        master = master.withColumns({"boat_id": F.lit(boat), "area_id": F.lit(area)})
    return master.fillna("").select(*fixed.MASTER_COLUMNS)


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """A stored master (CSV) of either version; the version follows from its header."""
    header = spark.read.option("header", True).csv(path).limit(0).columns
    master_version(header)
    return upgrade_master(read_lenient(spark, path, header))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files as they stand: _file, _line (from 1) and value.

    A file is read in as many splits as it has. The first number and the count of each split give
    every split the lines before it, so no file goes through one task and no line is sorted. A file
    may be a folder of one part written by a job, which then is named by the folder.
    """
    meta = F.col("_metadata.file_path")
    raw = spark.read.text(path).select(
        "value", meta.alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"))
    blocks = raw.groupBy("_path", "_block").agg(F.min("_place").alias("_first"),
                                                F.count(F.lit(1)).alias("_lines"))
    above = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_lines").over(above), F.lit(0)))
    names = F.split("_path", "/")
    name = F.element_at(names, -1)
    return raw.join(blocks, ["_path", "_block"]).select(
        F.when(name.startswith("part-"), F.element_at(names, -2)).otherwise(name).alias("_file"),
        (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias("_line"), "value")
