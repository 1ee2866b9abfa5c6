"""Exact dedup over a cuckoo-filter index of live digests (operator 3).

A text's key is the SHA-256 of its UTF-8 bytes without blanks and U+0009 to U+000D. The index
is a table with one row per bucket of the key space: a cuckoo filter (two candidate cells of
four 16-bit marks) and the bucket's stored keys with what is known of each: copies, and the row
that stays. A key the filter does not know is new; a key it does know is verified against the
bucket's stored keys, so a false hit costs time only. When an insertion finds no free place the
filter is doubled and filled again from the stored keys. Deletion lowers the copies and takes
the mark out with the last one.

Copies are reduced before any shuffle: each task runs an index of its own over its rows and
passes on one row per key, so a text that fills a third of the table reaches its bucket as one
row per task. Buckets are dealt by key and sized for ``PER_BUCKET`` keys.

Edge cases: null texts are empty and so equal to each other; a null doc_id sorts last; rows that
agree in everything are told apart by their place in the scan, one is kept; an empty table gives
an empty index; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import written
from .common import BLANKS, one_row_each, pieces, utf8

PER_BUCKET = 1 << 16
KEYS = "row_id long, doc_id long, digest binary, chars long, raw binary"
REDUCED = "digest binary, chars long, doc_id long, row_id long, copies long"
INDEX = ("bucket long, cells int, marks binary, digests array<binary>, chars array<long>, "
         "doc_ids array<long>, row_ids array<long>, copies array<long>")


class CuckooFilter:
    """Marks of 16 bits in cells of four; a key's second cell follows from its first and its mark."""

    SLOTS, KICKS = 4, 200

    def __init__(self, cells: int):
        self.cells = 1 << max(1, (cells - 1).bit_length())
        self.marks = [0] * (self.cells * self.SLOTS)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "little") or 1
        first = int.from_bytes(key[10:18], "little") & (self.cells - 1)
        return mark, first, self._other(first, mark)

    def _other(self, cell: int, mark: int) -> int:
        return (cell ^ (mark * 0x5BD1E995)) & (self.cells - 1)

    def __contains__(self, key: bytes) -> bool:
        mark, a, b = self._places(key)
        return mark in self.marks[a * 4:a * 4 + 4] or mark in self.marks[b * 4:b * 4 + 4]

    def _put(self, cell: int, mark: int) -> bool:
        for slot in range(cell * 4, cell * 4 + 4):
            if not self.marks[slot]:
                self.marks[slot] = mark
                return True
        return False

    def insert(self, key: bytes) -> bool:
        """False if no place was found; the filter then has lost a mark and must be rebuilt."""
        mark, a, b = self._places(key)
        if self._put(a, mark) or self._put(b, mark):
            return True
        cell = b
        for kick in range(self.KICKS):
            slot = cell * 4 + (kick + mark) % 4
            mark, self.marks[slot] = self.marks[slot], mark
            cell = self._other(cell, mark)
            if self._put(cell, mark):
                return True
        return False

    def delete(self, key: bytes) -> None:
        mark, a, b = self._places(key)
        for cell in (a, b):
            for slot in range(cell * 4, cell * 4 + 4):
                if self.marks[slot] == mark:
                    self.marks[slot] = 0
                    return

    def to_bytes(self) -> bytes:
        return np.array(self.marks, np.uint16).tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        self = cls(len(data) // 2 // cls.SLOTS)
        self.marks = np.frombuffer(data, np.uint16).tolist()
        return self


class LiveIndex:
    """A filter over stored keys. ``keys`` has [chars, doc_id, row_id, copies] by digest."""

    def __init__(self, cells: int = 64):
        self.filter, self.keys = CuckooFilter(cells), {}
        self.resized = self.false_hits = 0

    @staticmethod
    def _better(a: list, b: list) -> bool:
        """More code points, then the smaller doc_id (none comes last), then the earlier row."""
        last = 1 << 63
        return ((-a[0], last if a[1] is None else a[1], a[2])
                < (-b[0], last if b[1] is None else b[1], b[2]))

    def add(self, digest: bytes, chars: int, doc_id: int | None, row_id: int, copies: int = 1):
        row = [chars, doc_id, row_id, copies]
        if digest in self.filter:
            held = self.keys.get(digest)
            if held is not None:
                if self._better(row, held):
                    held[:3] = row[:3]
                held[3] += copies
                return
            self.false_hits += 1
        self.keys[digest] = row
        if not self.filter.insert(digest):
            self._grow()

    def _grow(self) -> None:
        cells = self.filter.cells
        while True:
            cells *= 2
            self.filter = CuckooFilter(cells)
            if all(map(self.filter.insert, self.keys)):
                self.resized += 1
                return

    def remove(self, digest: bytes, copies: int = 1) -> bool:
        """Takes copies out; the key goes with the last one. False if it was not stored."""
        if digest not in self.filter or digest not in self.keys:
            return False
        held = self.keys[digest]
        held[3] -= copies
        if held[3] <= 0:
            del self.keys[digest]
            self.filter.delete(digest)
        return True

    def rows(self) -> tuple[list, list, list, list, list]:
        held = sorted(self.keys.items())
        return ([d for d, _ in held], *([row[i] for _, row in held] for i in range(4)))


def _keys(batches):
    """row_id, doc_id, digest, code points and the digest of the text as it is (raw)."""
    for batch in (part for whole in batches for part in pieces(whole)):
        data, ends = utf8(batch.column("text"))
        ends = ends.tolist()
        held = data.tobytes()
        drop = BLANKS.encode()
        texts = [held[a:b] for a, b in zip(ends, ends[1:])]
        raw = [hashlib.sha256(x).digest() for x in texts]
        digests = [hashlib.sha256(x.translate(None, drop)).digest() for x in texts]
        chars = pc.utf8_length(batch.column("text").fill_null("")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), pa.array(digests, pa.binary()), chars,
             pa.array(raw, pa.binary())], names=["row_id", "doc_id", "digest", "chars", "raw"])


def keys(docs: DataFrame) -> DataFrame:
    """Keys of all rows, written once to the shared folder; whole texts are read once."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return written(rows.mapInArrow(_keys, KEYS), "dedup-keys")


def _add_all(index: LiveIndex, batch) -> None:
    names = batch.schema.names
    copies = batch.column("copies").to_pylist() if "copies" in names else [1] * batch.num_rows
    for row in zip(*(batch.column(n).to_pylist() for n in ("digest", "chars", "doc_id", "row_id")),
                   copies):
        index.add(*row)


def _reduced(batches):
    """One row per key of a task."""
    index = LiveIndex()
    for batch in batches:
        _add_all(index, batch)
    digests, chars, doc_ids, row_ids, copies = index.rows()
    yield pa.RecordBatch.from_arrays(
        [pa.array(digests, pa.binary()), *(pa.array(x, pa.int64())
                                           for x in (chars, doc_ids, row_ids, copies))],
        names=["digest", "chars", "doc_id", "row_id", "copies"])


def _stored(index: LiveIndex, row: dict) -> None:
    """Fills an index from its table row."""
    index.filter = CuckooFilter.from_bytes(row["marks"])
    index.keys = {d: [c, i, r, n] for d, c, i, r, n in zip(
        row["digests"], row["chars"], row["doc_ids"], row["row_ids"], row["copies"])}


def _index_row(bucket: int, index: LiveIndex) -> pa.Table:
    digests, *rest = index.rows()
    return pa.table([pa.array([bucket], pa.int64()), pa.array([index.filter.cells], pa.int32()),
                     pa.array([index.filter.to_bytes()], pa.binary()),
                     pa.array([digests], pa.list_(pa.binary())),
                     *(pa.array([x], pa.list_(pa.int64())) for x in rest)],
                    names=["bucket", "cells", "marks", "digests", "chars", "doc_ids", "row_ids",
                           "copies"])


def _inserted(key, stored: pa.Table, new: pa.Table) -> pa.Table:
    index = LiveIndex()
    for row in stored.to_pylist():
        _stored(index, row)
    for batch in new.to_batches():
        _add_all(index, batch)
    return _index_row(key[0].as_py(), index)


def _deleted(key, stored: pa.Table, gone: pa.Table) -> pa.Table:
    index = LiveIndex()
    for row in stored.to_pylist():
        _stored(index, row)
    for digest, copies in zip(gone.column("digest").to_pylist(),
                              gone.column("copies").to_pylist()):
        index.remove(digest, copies)
    return _index_row(key[0].as_py(), index)


def _bucket(buckets: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets))


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INDEX)


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // PER_BUCKET))


def insert(index: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """The index with the keys of ``rows`` (as from ``keys``) put in; written and read back.

    ``buckets`` is fixed for the life of an index.
    """
    few = rows.select("digest", "chars", "doc_id", "row_id").mapInArrow(_reduced, REDUCED)
    few = few.withColumn("bucket", _bucket(buckets))
    return written(index.groupBy("bucket").cogroup(few.groupBy("bucket"))
                   .applyInArrow(_inserted, INDEX), "dedup-index")


def delete(index: DataFrame, gone: DataFrame, left: DataFrame, buckets: int) -> DataFrame:
    """The index without the keys of ``gone``; ``left`` are the keys of the rows that remain.

    Where the row that stayed is among those deleted, its successor is chosen from ``left``.
    """
    counts = gone.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    lower = index.groupBy("bucket").cogroup(
        counts.withColumn("bucket", _bucket(buckets)).groupBy("bucket"))
    lower = written(lower.applyInArrow(_deleted, INDEX), "dedup-index")
    lost = entries(lower).join(gone.select("row_id").distinct(), "row_id", "left_semi")
    again = left.join(lost.select("digest"), "digest", "left_semi")
    emptied = lower.groupBy("bucket").cogroup(
        lost.select("digest", "copies").withColumn("bucket", _bucket(buckets)).groupBy("bucket")
    ).applyInArrow(_deleted, INDEX)
    return insert(written(emptied, "dedup-index"), again, buckets)


def entries(index: DataFrame) -> DataFrame:
    """One row per live key."""
    return index.select(F.explode(F.arrays_zip("digests", "chars", "doc_ids", "row_ids", "copies"))
                        .alias("e")).select(
        F.col("e.digests").alias("digest"), F.col("e.chars").alias("chars"),
        F.col("e.doc_ids").alias("doc_id"), F.col("e.row_ids").alias("row_id"),
        F.col("e.copies").alias("copies"))


def survivors(docs: DataFrame) -> DataFrame:
    """The row of each key that stays, with all columns of ``docs``."""
    rows = keys(docs)
    index = insert(empty_index(docs.sparkSession), rows, buckets_for(rows.count()))
    chosen = rows.join(entries(index).select("row_id"), "row_id", "left_semi")
    return one_row_each(docs, chosen.select("doc_id", F.lower(F.hex("raw")).alias("digest")))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The join back to the rows may be uneven, with one row per key on the other side, so adaptive
    execution can split a hot key.
    """
    rows = keys(docs)
    index = insert(empty_index(docs.sparkSession), rows, buckets_for(rows.count()))
    live = entries(index).select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("row_id").alias("keep_row"),
        F.col("copies").alias("group_size"))
    return rows.join(live, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
