"""Quartile bucket digests of whole texts and their likeness (operator 6).

Byte triplets in six arrangements within five bytes are hashed into 256 buckets and counted.
Each bucket is coded by the quartile its count falls into (two bits), and the length by its
logarithm (one byte); the digest is both in hexadecimal. Two digests differ by the sum of their
buckets' differences, the largest one counting double, and by their lengths; the sum is bounded,
and likeness is one minus its share of the bound.

``with_next`` puts every document beside the one that follows by doc_id: runs of ascending
doc_id are dealt out, with each run's first document also sent to the run before, so texts are
shuffled once and each task streams through its run.

Edge cases: null and empty texts have a digest like others, that of no triplets and length 0;
a null doc_id comes first; rows with equal doc_id follow each other by text; the last row is
followed by the first, a single row by itself; an empty table gives no rows; other columns are
ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import ordered
from .common import utf8

BUCKETS = 256
#: Places of the three bytes within five.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4), (0, 1, 4), (0, 3, 4))
BOUND = 2 * BUCKETS
LENGTH_POINT = 12  # difference points for each tenth of length
STEP = 1.1


def _tables() -> np.ndarray:
    draw = np.random.default_rng(6)
    return np.stack([[draw.permutation(BUCKETS) for _ in range(3)] for _ in TRIPLETS]
                    ).astype(np.uint8)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: the coded length, then the code of each bucket."""
    texts = len(offsets) - 1
    count = np.zeros((texts, BUCKETS), np.int64)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(texts, dtype=np.int64) * BUCKETS, size)
    left = np.repeat(offsets[1:], size) - np.arange(len(data))  # bytes to the text's end
    for (x, y, z), (a, b, c) in zip(TRIPLETS, _tables()):
        n = len(data) - z
        if n > 0:
            cell = a[data[x:x + n]] ^ b[data[y:y + n]] ^ c[data[z:z + n]]
            inside = left[:n] > z
            count += np.bincount((owner[:n] + cell)[inside], minlength=texts * BUCKETS
                                 ).reshape(texts, BUCKETS)
    ranked = np.sort(count, axis=1)
    code = np.zeros((texts, BUCKETS), np.uint8)
    for quarter in (1, 2, 3):
        code += count > ranked[:, [quarter * BUCKETS // 4 - 1]]
    length = np.minimum(np.round(np.log1p(size) / np.log(STEP)), 255).astype(np.uint8)
    return np.concatenate([length[:, None], code], axis=1)


def to_hex(rows: np.ndarray) -> list[str]:
    code = rows[:, 1:].reshape(len(rows), -1, 4)
    packed = (code[:, :, 0] << 6) | (code[:, :, 1] << 4) | (code[:, :, 2] << 2) | code[:, :, 3]
    whole = np.concatenate([rows[:, :1], packed], axis=1)
    return [x.tobytes().hex() for x in whole]


def from_hex(digest: str) -> np.ndarray:
    held = np.frombuffer(bytes.fromhex(digest), np.uint8)
    code = np.stack([held[1:] >> s & 3 for s in (6, 4, 2, 0)], axis=1).ravel()
    return np.concatenate([held[:1], code])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of rows of ``digests``, 0 to 1; 1 for equal ones."""
    apart = np.abs(a.astype(np.int64) - b)
    length, codes = apart[:, 0], apart[:, 1:]
    points = codes.sum(axis=1) + 3 * (codes == 3).sum(axis=1) + LENGTH_POINT * length
    return 1 - np.minimum(points, BOUND) / BOUND


def edited(text: str, following: str) -> str:
    """The last quarter of a text's code points replaced by the first as many of the next's."""
    count = len(text) // 4
    return text[:len(text) - count] + following[:count]


def _compared(doc_ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    changed = [edited(a, b) for a, b in zip(texts, following)]
    own, other, after = (digests(*utf8(pa.array(x, pa.large_string())))
                         for x in (texts, changed, following))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
         pa.array(changed, pa.string()), pa.array(to_hex(own)), pa.array(to_hex(other)),
         pa.array(likeness(own, other)), pa.array(likeness(own, after))],
        names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited",
               "near_next"])


def with_next(docs: DataFrame, most: int = 1 << 20) -> DataFrame:
    """doc_id, n_chars, edited (the edited text), fingerprint, edited_fingerprint, near_edited,
    near_next. ``most`` is about how many characters a task compares at a time."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = ordered.bounds(rows)
    low = -1 << 63
    heads = dict(rows.select(ordered.run(F.col("doc_id"), cuts).alias("run"),
                             F.coalesce("doc_id", F.lit(low)).alias("id"))
                 .groupBy("run").agg(F.min("id")).collect())  # one row per run
    order = sorted(heads)
    head = F.lit([heads.get(i) for i in range(len(cuts) + 1)]).cast("array<long>")
    before = F.lit([order[order.index(i) - 1] if i in heads else None
                    for i in range(len(cuts) + 1)]).cast("array<int>")
    placed = rows.withColumn("run", ordered.run(F.col("doc_id"), cuts).cast("int"))
    here = F.struct(F.col("run").alias("run"), F.lit(0).alias("after"))
    there = F.struct(F.get(before, F.col("run")).alias("run"), F.lit(1).alias("after"))
    first = F.coalesce("doc_id", F.lit(low)) == F.get(head, F.col("run"))
    sent = placed.withColumn("to", F.explode(F.when(first, F.array(here, there)).otherwise(
        F.array(here)))).select("to.run", "to.after", "doc_id", "text")
    dealt = sent.repartitionById(len(cuts) + 1, F.col("run")).sortWithinPartitions(
        "run", "after", F.asc_nulls_first("doc_id"), "text")

    def compared(batches):
        held, size, run, ended = [], 0, None, True
        for batch in batches:
            for here, after, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if here != run:
                    held, size, run, ended = [], 0, here, False
                if ended:
                    continue  # further rows with the doc_id of the following run's first
                held.append((doc_id, text))
                size += len(text)
                if after or size > most and len(held) > 1:
                    ids, texts = zip(*held)
                    yield _compared(ids[:-1], texts[:-1], texts[1:])
                    held, size, ended = held[-1:], len(text), bool(after)

    return dealt.mapInArrow(compared, "doc_id long, n_chars long, edited string, "
                                      "fingerprint string, edited_fingerprint string, "
                                      "near_edited double, near_next double")
