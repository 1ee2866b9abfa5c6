"""Near duplicates by a grouped prefix join on word shingles (operator 8).

Two documents link if their sets of five-word shingles have a Jaccard similarity of 0.75 or more;
components are what links reach. Nothing is sampled or cut off; the steps:

1. All shingles of the corpus are counted in ``CELLS`` cells. A shingle's token is its cell's
   count and its hash, so tokens sort from rare to common in one order for the whole corpus.
2. Documents with equal sets are one class. Classes with equal prefixes (the first quarter of the
   tokens, one of which two linked sets must share) and equal sizes are one group; only groups
   enter the join, each prefix token as one entry of that token's list.
3. Tokens of one group only go; a filter of ``FILTER_BITS`` bits spares most of them the
   shuffle. Of the lists that hold the same two groups and no other the first is enough. In the
   lists left a group stays only if some size there can still reach the similarity, given the
   places of the token in the prefixes.
4. Groups are expanded to their classes. Instead of all pairs of a list, every class is first
   verified against the one whose token comes earliest, which in a family of near copies is the
   one nearest to all; components of these links are made. Signatures of a few bits a shingle
   bound the overlap of a pair, and sets are fetched only for pairs that the bound leaves.
5. What is left are classes of a list in different components. Those outside a list's largest
   component are paired with the others that sizes and places still allow, and verified too.

So a list's pairs are not listed; a family of near copies costs one pair for each member and
token, and what lies outside its component only what the bounds cannot exclude. The counts are a
fixed table of ``CELLS`` numbers whatever the corpus; it only decides the order, as does
everything that is approximate here, and so the time, never the result. Tokens are
64-bit numbers of a hash, classes and groups 128 bits of one.

Edge cases: null and empty texts and texts without words have an empty set, link with nothing
and are their own component; a text of one to four words is one shingle; a null doc_id stands
aside when the smallest doc_id is taken; repeated rows are equal sets; an empty table gives no
rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import fresh_path, remove, written
from . import words
from .common import one_row_each, pieces, ranges, utf8
from .components import components

WORDS = 5
CELLS = 1 << 20
SLICES = 64  # parts in which the counts are added up
SIGNATURE_BITS = 16  # logarithm of the longest signature: 8 KB, for documents of many thousand words
FILTER_BITS = 1 << 25  # 4 MB; a corpus that fills the filter passes it whole


def _sets(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row, end to end, and their offsets."""
    number, _, _, text = words.words(*utf8(part.column("text")))
    return words.shingles(number, text, part.num_rows, WORDS)


def _cell(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(CELLS - 1)).astype(np.int64)


def _count(batches):
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for part in pieces(batch):
            total += np.bincount(_cell(_sets(part)[0]), minlength=CELLS)
    kind = np.uint16 if total.max() < 1 << 16 else np.int64
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(SLICES), pa.int32()), pa.array([np.dtype(kind).itemsize] * SLICES, pa.int32()),
         pa.array([x.tobytes() for x in total.astype(kind).reshape(SLICES, -1)], pa.binary())],
        names=["slice", "width", "counts"])


def _add(batches):
    """One row per slice with the sum of all counts; memory is that of the slices."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, width, counts in zip(*(c.to_pylist() for c in batch.columns)):
            here = np.frombuffer(counts, np.uint16 if width == 2 else np.int64).astype(np.int64)
            total[at] = total[at] + here if at in total else here
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([8] * len(total), pa.int32()),
         pa.array([x.tobytes() for x in total.values()], pa.binary())],
        names=["slice", "width", "counts"])


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """How many distinct shingles of all documents fall into each cell."""
    kind = "slice int, width int, counts binary"
    found = docs.select("text").mapInArrow(_count, kind).repartitionById(SLICES, F.col("slice"))
    out = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for at, _, counts in found.mapInArrow(_add, kind).collect():  # CELLS numbers in all
        out[at] += np.frombuffer(counts, np.int64)
    return out.ravel()


def _key(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _signature(values: np.ndarray) -> bytes:
    """A bit per shingle by its low bits, in about four times as many bits as there are shingles."""
    bits = 1 << min(max(6, (4 * len(values) - 1).bit_length()), SIGNATURE_BITS)
    marks = np.zeros(bits, np.uint8)
    marks[(values & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def _may_link(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    """Whether two sets may be similar, by their signatures; never False for sets that are.

    A common shingle sets a common bit, and the shingles of a set that share bits with others of it
    are as many as its size is above its bits. The longer signature is folded to the shorter.
    """
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    long_, short = max(len(a), len(b)) * 8, min(len(a), len(b)) * 8
    while long_ > short:
        long_ //= 2
        low = (1 << long_) - 1
        x, y = (x >> long_ | x & low, y) if len(a) > len(b) else (x, y >> long_ | y & low)
    most = (x & y).bit_count() + min(n_a - x.bit_count(), n_b - y.bit_count())
    return 7 * most >= 3 * (n_a + n_b)


def classify(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """row_id, doc_id, digest (of the text), n, node (the class), grp, and where a task first
    meets a group its prefix tokens."""
    rank = np.minimum(counts, (1 << 20) - 1).astype(np.uint32)

    def classified(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for part in pieces(batch):
                value, ends = _sets(part)
                token = (rank[_cell(value)].astype(np.uint64) << np.uint64(43)) | (
                    value >> np.uint64(21))  # the high bit stays free: tokens are not negative
                words.sort_each(token, ends)
                size = np.diff(ends)
                length = np.where(size > 0, size - -(-3 * size // 4) + 1, 0)
                held, first = value.tobytes(), token.tobytes()
                text, at = utf8(part.column("text"))
                text, at = text.tobytes(), at.tolist()
                digest = [hashlib.sha256(text[a:b]).digest() for a, b in zip(at, at[1:])]
                node, group, marks, fresh = [], [], [], np.zeros(len(size), bool)
                for i, (a, n, p) in enumerate(zip(ends.tolist(), size.tolist(), length.tolist())):
                    if not n:
                        node.append(None)
                        group.append(None)
                        marks.append(None)
                        continue
                    node.append(_key(held[8 * a:8 * (a + n)]))
                    key = _key(n.to_bytes(8, "little") + first[8 * a:8 * (a + p)])
                    group.append(key)
                    marks.append(_signature(value[a:a + n]))
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                sent = np.where(fresh, length, 0)
                tokens = pa.array(token[ranges(ends[:-1], sent)].astype(np.int64))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sent)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(digest, pa.binary()),
                     pa.array(size.astype(np.int32)), pa.array(node, pa.binary()), pa.array(group, pa.binary()),
                     pa.array(marks, pa.binary()), pa.ListArray.from_arrays(offsets, tokens)],
                    names=["doc_id", "digest", "n", "node", "grp", "signature", "prefix"])

    found = docs.mapInArrow(classified, "doc_id long, digest binary, n int, node binary, grp binary, "
                                        "signature binary, prefix array<long>")
    return found.withColumn("row_id", F.monotonically_increasing_id())


#: An entry's reach: a partner of size m is possible only if 3 m is not above it (the overlap of
#: two sets with their first common token at places p and q is at most min(n - p, m - q)).
_REACH = "7L * (n - pos) - 3L * n"


def _bits(rows: DataFrame, key: str) -> np.ndarray:
    """Which of ``FILTER_BITS`` bits the values of a column set; words of 64 bits."""
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    found = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return held


def _shared(rows: DataFrame) -> DataFrame:
    """Prefix tokens (s) that more than one entry has, and a few more that pass the filter.

    A second filter holds the first row of each group, so that a group met by several tasks
    comes once, or now and then more often.
    """
    tokens = rows.where("size(prefix) > 0").select("row_id", "grp", "n", "prefix")
    common = tokens.select(F.explode("prefix").alias("s")).groupBy("s").count().where("count > 1")
    held = _bits(common, "s")
    leads = _bits(tokens.groupBy("grp").agg(F.min("row_id").alias("row_id")), "row_id")

    def passed(batches):
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            row = batch.column("row_slot").to_numpy()
            batch = batch.filter(pa.array(leads[row >> 6] >> (row & 63) & 1 == 1))
            token, slot = (batch.column(c).flatten().to_numpy(zero_copy_only=False)
                           for c in ("prefix", "slot"))
            size = batch.column("prefix").value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(size)), size)
            pos = ranges(np.zeros(len(size), np.int64), size)
            here = np.flatnonzero(held[slot >> 6] >> (slot & 63) & 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[here]), *(batch.column(c).take(pa.array(owner[here]))
                                          for c in ("grp", "n")), pa.array(pos[here].astype(np.int32))],
                names=["s", "grp", "n", "pos"])

    slots = F.transform("prefix", lambda t: F.pmod(F.xxhash64(t), F.lit(FILTER_BITS)))
    row_slot = F.pmod(F.xxhash64("row_id"), F.lit(FILTER_BITS))
    return written(tokens.withColumns({"slot": slots, "row_slot": row_slot}).mapInArrow(
        passed, "s long, grp binary, n int, pos int"), "join-shared")


def lists(rows: DataFrame) -> DataFrame:
    """Entries (s, node, n, pos, reach) of all lists in which two classes may still link."""
    shared = _shared(rows).withColumn("reach", F.expr(_REACH))
    bounds = shared.groupBy(F.col("s").alias("b_s")).agg(
        F.min("grp").alias("first"), F.max("grp").alias("last"), F.min("n").alias("least"),
        F.max("reach").alias("most"), F.count(F.lit(1)).alias("size")).where("first <> last")
    bounds = written(bounds.where("most >= 3 * least"), "join-bounds")
    kept = bounds.where("size = 2").groupBy("first", "last").agg(F.min("b_s").alias("k_s"))
    kept = kept.select("k_s").unionByName(bounds.where("size > 2").select(F.col("b_s").alias("k_s")))
    bounds = bounds.join(kept, F.col("b_s") == F.col("k_s")).select("b_s", "least", "most")
    open_ = shared.join(bounds, F.col("s") == F.col("b_s")).where(
        "reach >= 3 * least AND most >= 3 * n").select("s", "grp", "n", "pos", "reach").distinct()

    members = rows.where("node IS NOT NULL").select(
        F.col("grp").alias("m_grp"), "node", F.col("n").alias("m_n")).distinct()
    expanded = open_.join(members, (F.col("grp") == F.col("m_grp")) & (F.col("n") == F.col("m_n"))
                          ).select("s", "node", "n", "pos", "reach")
    several = members.groupBy(F.col("m_grp").alias("g")).agg(F.count(F.lit(1)).alias("k")).where(
        "k > 1")
    inside = members.join(several, F.col("m_grp") == F.col("g")).select(
        F.xxhash64("g").alias("s"), "node", F.col("m_n").alias("n"), F.lit(0).alias("pos"),
        (4 * F.col("m_n").cast("long")).alias("reach"))
    return written(expanded.unionByName(inside), "join-lists")


def shingle_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """node and the shingles of one document of each class in ``pairs`` (a, b).

    Documents are picked by a filter of ``FILTER_BITS`` bits over doc_id, so texts are not
    shuffled; classes that pass it by chance are in no pair.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("p_node")).distinct()
    wanted = classes.join(nodes, F.col("node") == F.col("p_node"), "left_semi")
    held = _bits(wanted, "doc_id")

    def sets(batches):
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array(held[slots >> 6] >> (slots & 63) & 1 == 1))
            for part in pieces(batch):
                value, ends = _sets(part)
                data, at = value.tobytes(), ends.tolist()
                nodes = [_key(data[8 * a:8 * b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(value.view(np.int64)))],
                    names=["f_node", "shingles"])

    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    found = docs.select("text", slot.alias("slot")).mapInArrow(sets, "f_node binary, shingles array<long>")
    return found.join(nodes, F.col("f_node") == F.col("p_node")).select(
        F.col("f_node").alias("node"), "shingles").dropDuplicates(["node"])


def possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes (a, b) that their signatures do not tell apart."""
    known = classes.select("node", "n", "signature")
    for side in ("a", "b"):
        pairs = pairs.join(known.select(*[F.col(c).alias(f"{c}_{side}") for c in known.columns]),
                           F.col(side) == F.col(f"node_{side}")).drop(f"node_{side}")

    def kept(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("signature_a", "signature_b", "n_a", "n_b")]
            yield batch.filter(pa.array([_may_link(*row) for row in zip(*columns)], pa.bool_())).select(["a", "b"])

    return pairs.mapInArrow(kept, "a binary, b binary")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The links among pairs of classes (a, b); only pairs that may link have their sets fetched."""
    spark = docs.sparkSession
    paths = [fresh_path(spark, name) for name in ("join-pairs", "join-sets")]
    possible(pairs, classes).write.parquet(paths[0])
    pairs = spark.read.schema("a binary, b binary").parquet(paths[0])
    shingle_sets(docs, classes, pairs).write.parquet(paths[1])
    sets = spark.read.schema("node binary, shingles array<long>").parquet(paths[1])
    left = sets.select(F.col("node").alias("x_node"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("y_node"), F.col("shingles").alias("y"))
    both = pairs.join(left, F.col("a") == F.col("x_node")).join(right, F.col("b") == F.col("y_node"))
    both = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("common"),
                       (F.size("x") + F.size("y")).cast("long").alias("sizes"))
    links = written(both.where("100 * common >= 75 * (sizes - common)").select("a", "b"), "join-links")
    for path in paths:  # the links are written; nothing reads these again
        remove(spark, path)
    return links


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


_ALLOWED = "reach >= 3 * o_n AND o_reach >= 3 * n"


def to_earliest(entries: DataFrame) -> DataFrame:
    """Pairs of every class in a list with the one whose token comes earliest."""
    first = entries.groupBy(F.col("s").alias("o_s")).agg(F.min(F.struct(
        "pos", F.xxhash64("node", "s").alias("by"), "node", "n", "reach")).alias("o"))
    first = first.select("o_s", F.col("o.node").alias("o_node"), F.col("o.n").alias("o_n"),
                         F.col("o.reach").alias("o_reach"))
    pairs = entries.join(first, F.col("s") == F.col("o_s")).where(f"node <> o_node AND {_ALLOWED}")
    return pairs.select(*_ordered("node", "o_node")).distinct()


def across(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of classes of one list in different components, as far as bounds allow them.

    What the bounds leave is written: read as one query, the entries would stand in it six times, and
    the driver holds and plans such a query anew after each of its exchanges.
    """
    found = labels.select(F.col("node").alias("l_node"), "label")
    rows = entries.join(found, F.col("node") == F.col("l_node"), "left").select(
        "s", "node", "n", "reach", F.coalesce("label", "node").alias("part"))
    parts = rows.groupBy("s", "part").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"),
                                          F.max("reach").alias("reach"))
    tops = parts.groupBy(F.col("s").alias("t_s")).agg(
        F.max(F.struct("k", "part")).alias("top"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").select("t_s", F.col("top.part").alias("top"))
    parts = parts.join(tops, F.col("s") == F.col("t_s"))
    main = F.col("part") == F.col("top")
    bounds = written(parts.groupBy(F.col("s").alias("b_s")).agg(
        F.first("top").alias("top"),
        F.min(F.when(main, F.col("n"))).alias("top_n"), F.max(F.when(main, F.col("reach"))).alias("top_reach"),
        F.min(F.when(~main, F.col("n"))).alias("rest_n"), F.max(F.when(~main, F.col("reach"))).alias("rest_reach")),
        "join-parts")
    meets_top, meets_rest = (f"(reach >= 3 * {x}_n AND {x}_reach >= 3 * n)" for x in ("top", "rest"))
    rows = rows.join(bounds, F.col("s") == F.col("b_s")).select(
        "s", "node", "n", "reach", "part", main.alias("main"), F.expr(meets_rest).alias("other"),
        F.expr(f"part <> top AND ({meets_top} OR {meets_rest})").alias("rest"))
    rows = written(rows.where("rest OR other"), "join-apart")
    rest = rows.where("rest").select("s", "node", "n", "reach", "part")
    others = rows.where("other").select(
        F.col("s").alias("o_s"), F.col("node").alias("o_node"), F.col("n").alias("o_n"),
        F.col("reach").alias("o_reach"), F.col("part").alias("o_part"), F.col("main").alias("o_top"))
    pairs = rest.join(others, (F.col("s") == F.col("o_s")) & (F.col("part") != F.col("o_part"))
                      & (F.col("o_top") | (F.col("node") < F.col("o_node"))) & F.expr(_ALLOWED))
    return pairs.select(*_ordered("node", "o_node")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``, the digest of its text, and
    part, a number of its component (null for an empty set)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    rows = written(classify(docs, shingle_counts(docs)), "join-classes")
    classes = written(rows.where("node IS NOT NULL").groupBy("node", "n").agg(
        F.min("doc_id").alias("doc_id"), F.min("signature").alias("signature")), "join-nodes")
    entries = lists(rows)
    near = verified(to_earliest(entries), docs, classes)
    links = near.union(verified(across(entries, components(near)), docs, classes))
    labels = written(components(links), "join-labels")

    labelled = classes.join(labels.withColumnRenamed("node", "l_node"),
                            F.col("node") == F.col("l_node"), "left")
    smallest = labelled.where("label IS NOT NULL").groupBy(F.col("label").alias("s_label")).agg(
        F.min("doc_id").alias("smallest"))
    reached = labelled.join(smallest, F.col("label") == F.col("s_label"), "left").select(
        F.col("node").alias("r_node"), F.col("n").alias("r_n"),
        F.coalesce("smallest", "doc_id").alias("component"), F.coalesce("label", "node").alias("part"))
    return rows.select("doc_id", "digest", "n", "node").join(
        reached, (F.col("node") == F.col("r_node")) & (F.col("n") == F.col("r_n")), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"), "digest", "part")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The row with a component's smallest doc_id, with all columns of ``docs``."""
    found = near_duplicates(docs).where("doc_id <=> component_id")
    alone = F.expr("if(part IS NULL, digest, NULL)")  # no component: each text stays
    chosen = found.groupBy("part", "doc_id", alone.alias("alone")).agg(F.min("digest").alias("digest"))
    return one_row_each(docs, chosen.select("doc_id", F.lower(F.hex("digest")).alias("digest")))
