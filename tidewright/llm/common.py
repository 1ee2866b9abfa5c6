"""What several operators share: reading, worker-held objects, arrays of texts, kept rows."""
from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import written

#: The white space that contracts name: blank and U+0009 to U+000D. Fixed values.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_bytes(path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file, read where the job is started; ``most`` bounds what tasks carry."""
    with open(path, "rb") as file:
        data = file.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{path} is larger than {most} bytes")
    return data


def per_process(key: tuple, make):
    """An object that a worker process makes once and keeps from task to task."""
    shelf = sys.modules.setdefault("_tidewright_shelf", types.ModuleType("_tidewright_shelf"))
    if key not in shelf.__dict__:
        shelf.__dict__[key] = make()
    return shelf.__dict__[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column end to end, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 20):
    """Slices of a batch with about ``most`` bytes of text each, one row at least; no copies."""
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The whole numbers of many ranges, end to end."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(
        np.asarray(starts, np.int64) - (ends - lengths), lengths)


def raw_digest(text: Column) -> Column:
    """SHA-256 of a whole text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def one_row_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the ``doc_id`` and ``digest`` (``raw_digest``) of ``chosen``.

    Where rows agree in both, one of them is returned; they can differ in other columns only.
    The second shuffle that needs is made only where such rows exist. All columns stay. ``chosen`` is
    written, so that the queries on ``docs`` are short and it is worked out once.
    """
    names = docs.columns
    wrapped = docs.select(F.struct(*[docs[f"`{n}`"] for n in names]).alias("row"))
    wrapped = wrapped.select("row", F.col("row.doc_id").alias("doc_id"),
                             raw_digest(F.col("row.text")).alias("digest"))
    picked = written(chosen.select(F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest")), "chosen")
    rows = wrapped.join(picked, F.col("doc_id").eqNullSafe(F.col("c_id"))
                        & (F.col("digest") == F.col("c_digest")), "left_semi")
    twice = rows.groupBy("doc_id", "digest").count().where("count > 1").limit(1)
    if twice.count():
        rows = rows.dropDuplicates(["doc_id", "digest"])
    return rows.select("row.*")
