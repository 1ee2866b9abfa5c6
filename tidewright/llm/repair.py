"""Ids in files compressed by a Re-Pair grammar, with random access (operator 2).

Documents are encoded, ended by one id and dealt into runs of ascending doc_id; run by run,
consecutive documents fill shards of about ``SHARD`` ids. In a shard, frequent pairs of
neighbouring symbols are replaced by new symbols, again and again: each round counts all pairs,
takes the most frequent ones, replaces their occurrences where a pair is more frequent than the
ones it overlaps, and adds one rule for each. Rounds go on while a pair pays for its rule; symbols
get as many bits as the number of rules needs. A shard's file entry has the rules, the expansion
length of every rule, the remaining sequence, and the documents' starts, so any range of ids can
be read by expanding the symbols that cover it and no others (``decode``).

The table of shards is written through Spark's committer to the folder given (the shared folder
by default); a task that is lost writes its shards again. Where the runs begin is taken from
quantiles of doc_id, so the ids are shuffled once and texts are not. A shard's entry has its start
within the run; when it is read, one total per run is broadcast (runs are as many as shuffle
partitions), so the entries are not shuffled.

Edge cases: null and empty texts are the ending id alone; a null doc_id comes first; rows with
equal doc_id follow each other in the order of their ids; a document longer than a shard is a
shard of its own; an empty table gives an empty file; other columns are ignored.
"""
from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..session import fresh_path
from . import ordered, wordbpe
from .common import file_bytes, pieces

SHARD = 1 << 20
LEAST = 4  # occurrences from which a rule is smaller than what it replaces
HASH_BITS = 20
_HEAD = "<4sIIBBQ"  # mark, first rule, rules, bits of a symbol, bytes of a length, symbols
_MARK = b"RPG2"
SHARDS = ("run int, shard int, run_start long, n_tokens long, doc_ids array<long>, "
          "starts array<long>, entry binary")


def _frequent(a: np.ndarray, b: np.ndarray, salt: int | None) -> tuple[np.ndarray, ...]:
    """Which of the pairs are the most frequent ones, the rank of each, the pair of every rank, and
    which pairs can come ``LEAST`` times at all.

    Counted by hash cell, of which one pair speaks, or exactly if ``salt`` is None. Pairs of a
    32nd of the largest count or more are taken, the most frequent first.
    """
    if salt is None:
        key = a.astype(np.uint64) << np.uint64(32) | b
        _, cell, count = np.unique(key, return_inverse=True, return_counts=True)
    else:
        mix = a * np.uint32(0x9E3779B1 + 2 * salt & 0xFFFFFFFF)
        mix ^= b * np.uint32(0x85EBCA77 * 0xC2B2AE3D & 0xFFFFFFFF)
        bits = min(HASH_BITS, len(a).bit_length())
        mix >>= np.uint32(32 - bits)
        cell = mix.astype(np.intp)
        count = np.bincount(cell, minlength=1 << bits)
    taken = count >= max(LEAST, int(count.max(initial=0)) // 32)
    many = np.flatnonzero(taken)
    many = many[np.argsort(-count[many], kind="stable")]
    rank = np.empty(len(count), np.int32)
    rank[many] = np.arange(len(many), dtype=np.int32)
    at = np.flatnonzero(taken.take(cell))
    here = rank.take(cell.take(at))
    sample = np.zeros(len(many), np.int64)
    sample[here] = at  # one occurrence speaks for its cell
    pair_a, pair_b = a[sample], b[sample]
    if salt is not None:
        same = (a.take(at) == pair_a.take(here)) & (b.take(at) == pair_b.take(here))
        at, here = at[same], here[same]
    return at, here, pair_a, pair_b, (count >= LEAST).take(cell)


def grammar(ids: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs of symbols), their expansion lengths, and the sequence left; symbols from
    ``first`` on are rules. Rounds go on until one that counts exactly adds no rule."""
    left = ids.astype(np.uint32)
    rules, lengths = np.empty((0, 2), np.uint32), np.empty(0, np.int64)
    # A pair that came too rarely stays rare unless one of its symbols is new, so it is not
    # counted again.
    open_ = np.arange(max(0, len(left) - 1))
    salt: int | None = 0
    while len(open_):
        at, here, pair_a, pair_b, still = _frequent(left[open_], left[open_ + 1], salt)
        at, apart = open_[at], len(pair_a)
        # Of a run of one symbol, every other pair.
        begins = np.ones(len(at), bool)
        begins[1:] = (at[1:] != at[:-1] + 1) | (here[1:] != here[:-1])
        if not begins.all():
            start = at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]
            even = (at - start) % 2 == 0
            at, here = at[even], here[even]
        before, after = np.full(len(at), apart, np.int32), np.full(len(at), apart, np.int32)
        touch = at[1:] == at[:-1] + 1
        before[1:][touch], after[:-1][touch] = here[:-1][touch], here[1:][touch]
        won = (here < before) & (here < after)
        at, here = at[won], here[won]
        used = np.bincount(here, minlength=apart)
        rule = np.flatnonzero(used >= LEAST)
        if not len(rule):
            if salt is None:
                break
            salt, open_ = None, open_[still]
            continue
        number = np.zeros(apart, np.uint32)
        number[rule] = first + len(rules) + np.arange(len(rule), dtype=np.uint32)
        kept = used[here] >= LEAST
        at, here = at[kept], here[kept]
        new = np.stack([pair_a[rule], pair_b[rule]], axis=1)
        lengths = np.concatenate([lengths, _length(new[:, 0], first, lengths)
                                  + _length(new[:, 1], first, lengths)])
        rules = np.concatenate([rules, new])
        left[at] = number[here]
        counted, keep = np.zeros(len(left), bool), np.ones(len(left), bool)
        counted[open_[still]] = True
        counted[at], counted[np.maximum(at, 1) - 1], keep[at + 1] = True, True, False
        left, counted = left[keep], counted[keep]
        open_ = np.flatnonzero(counted[:-1])
        salt = salt if salt is None else salt + 1
    return rules, lengths, left


def _length(symbols: np.ndarray, first: int, lengths: np.ndarray) -> np.ndarray:
    """How many ids each symbol stands for."""
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= first
    out[rule] = lengths[symbols[rule] - first]
    return out


def _bits(symbols: np.ndarray, width: int) -> bytes:
    """Symbols of ``width`` bits: the low 16 of each, then the other bits plane by plane."""
    planes = [np.packbits((symbols >> np.uint32(bit) & np.uint32(1)).astype(bool)).tobytes()
              for bit in range(16, width)]
    return b"".join([(symbols & np.uint32(0xFFFF)).astype("<u2").tobytes(), *planes])


def _unbits(entry: bytes, at: int, n: int, width: int) -> tuple[np.ndarray, int]:
    """The symbols that ``_bits`` wrote, and where they end."""
    out, at = np.frombuffer(entry, "<u2", n, at).astype(np.uint32), at + 2 * n
    for bit in range(16, width):
        size = (n + 7) // 8
        plane = np.unpackbits(np.frombuffer(entry, np.uint8, size, at), count=n)
        out |= plane.astype(np.uint32) << np.uint32(bit)
        at += size
    return out, at


def pack(ids: np.ndarray, first: int) -> bytes:
    """The file entry of a shard."""
    rules, lengths, left = grammar(ids, first)
    width = max(16, (first + len(rules) - 1).bit_length())
    kind = np.dtype("<u2" if lengths.max(initial=0) < 1 << 16 else "<u4")
    return b"".join((struct.pack(_HEAD, _MARK, first, len(rules), width, kind.itemsize, len(left)),
                     lengths.astype(kind).tobytes(), _bits(rules.ravel(), width), _bits(left, width)))


def _open(entry: bytes):
    mark, first, rules, width, size, symbols = struct.unpack_from(_HEAD, entry)
    if mark != _MARK:
        raise ValueError("not a shard of this format")
    at = struct.calcsize(_HEAD)
    lengths = np.frombuffer(entry, f"<u{size}", rules, at).astype(np.int64)
    pairs, at = _unbits(entry, at + size * rules, 2 * rules, width)
    return first, pairs.reshape(-1, 2), lengths, _unbits(entry, at, symbols, width)[0]


def _expand(symbols: np.ndarray, first: int, pairs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of symbols; each goes to its place, known by the lengths, once it is no rule."""
    size = _length(symbols, first, lengths)
    place = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint32)
    while len(symbols):
        rule = symbols >= first
        out[place[~rule]] = symbols[~rule]
        one, other = pairs[symbols[rule] - first].T
        place = place[rule]
        place = np.concatenate([place, place + _length(one, first, lengths)])
        symbols = np.concatenate([one, other])
    return out


def decode(entry: bytes, start: int = 0, end: int | None = None) -> np.ndarray:
    """The ids of a shard from ``start`` to ``end``; only symbols that cover them are expanded."""
    first, pairs, lengths, symbols = _open(entry)
    if start == 0 and end is None:
        return _expand(symbols, first, pairs, lengths)
    ends = np.cumsum(_length(symbols, first, lengths))
    total = int(ends[-1]) if len(ends) else 0
    end = total if end is None else min(end, total)
    if start >= end:
        return np.empty(0, np.uint32)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left") + 1
    before = int(ends[a - 1]) if a else 0
    return _expand(symbols[a:b], first, pairs, lengths)[start - before:end - before]


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = 2,
          runs: int | None = None) -> None:
    """Encodes and writes the table of shards: run, shard, n_tokens, doc_ids, starts, entry."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    bounds, data = np.array(ordered.bounds(rows, runs), np.int64), file_bytes(vocabulary)

    def encoded(batches):
        encoder = wordbpe.encoder(data)
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for part in pieces(batch):
                ids = encoder.encode(part.column("text").fill_null("").to_pylist())
                doc_id = part.column("doc_id")
                run = np.searchsorted(bounds, doc_id.fill_null(-1 << 63).to_numpy(), "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(run.astype(np.int32)), doc_id,
                     pa.array([x + end for x in ids], pa.binary())], names=["run", "doc_id", "ids"])

    def shards(batches):
        encoder = wordbpe.encoder(data)
        first = max(encoder.size, end_id + 1)
        held, size, run, shard, before = [], 0, None, 0, 0

        def entry():
            ids = np.frombuffer(b"".join(x for _, x in held), encoder.kind)
            counts = [len(x) // encoder.kind.itemsize for _, x in held]
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array([run], pa.int32()), pa.array([shard], pa.int32()),
                 pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                 pa.array([starts], pa.list_(pa.int64())),
                 pa.array([pack(ids, first)], pa.binary())],
                names=["run", "shard", "run_start", "n_tokens", "doc_ids", "starts", "entry"])

        for batch in batches:
            for here, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (here != run or size >= SHARD):
                    yield entry()
                    shard, before = (shard + 1, before + size) if here == run else (0, 0)
                    held, size = [], 0
                run = here
                held.append((doc_id, ids))
                size += len(ids) // encoder.kind.itemsize
        if held:
            yield entry()

    ids = rows.mapInArrow(encoded, "run int, doc_id long, ids binary")
    ids = ids.repartitionById(len(bounds) + 1, F.col("run"))
    ids = ids.sortWithinPartitions("run", F.asc_nulls_first("doc_id"), "ids")
    ids.mapInArrow(shards, SHARDS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written table in no set order: doc_id, start (ids of all before it),
    n_tokens, ids (little-endian unsigned 32-bit)."""
    file = spark.read.schema(SHARDS).parquet(path)
    totals = file.groupBy("run").agg(F.sum("n_tokens").alias("run_tokens"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # one row per run
    totals = totals.select(F.col("run").alias("t_run"), F.coalesce(
        F.sum("run_tokens").over(before), F.lit(0)).alias("before"))

    def documents(batches):
        for batch in batches:
            for first, doc_ids, starts, entry in zip(*(c.to_pylist() for c in batch.columns)):
                ids = decode(entry)
                ends = np.array([*starts[1:], len(ids)])
                starts = np.array(starts)
                held = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(first + starts),
                     pa.array(ends - starts),
                     pa.array([held[4 * a:4 * b] for a, b in zip(starts, ends)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    rows = file.join(F.broadcast(totals), F.col("run") == F.col("t_run"))
    rows = rows.withColumn("first", F.col("before") + F.col("run_start"))
    return rows.select("first", "doc_ids", "starts", "entry").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Writes a table of documents and reads it back."""
    path = path or fresh_path(docs.sparkSession, "token-ids")
    write(docs, vocabulary, path, end_id)
    return read(docs.sparkSession, path)
