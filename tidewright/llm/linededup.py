"""Repeated lines, found over ranges of line hashes and returned as bitmaps (operator 11).

A line's key is the line without blanks and U+0009 to U+000D at both ends, A-Z as a-z. A key of
``LEAST`` code points or more keeps its lines in the document with the smallest doc_id that holds it
and loses them in all others. DataFrame functions only; the steps:

1. Texts are split once. Every key that counts is written as two 64-bit hashes (128 bits, which tell
   keys apart) with doc_id, the document's own two hashes and the line's number; texts stay behind.
2. Keys that hold more lines than an even share of one task are found through counts of ranges of
   the hash, which each task reduces first. There are at most as many such keys as shuffle
   partitions, so they and the smallest doc_id of each are broadcast, and their lines never meet.
3. All other lines are dealt by ranges of the hash and sorted by document and line within; a window
   in that order streams over them, the first line of a key names the document that keeps it.
4. Lines that go are gathered per document as words of 64 bits. Only words with a line to drop are
   there (``word``, ``keep``): the bitmap is compressed, a document that loses nothing has no row.

``with_bitmaps`` puts the bitmaps beside the documents and ``kept`` applies one.

Edge cases: a null text is empty, which is one empty line; rows with the same doc_id are one document
and keep each other's lines; a null doc_id is a document of its own, after all others; rows that
agree in doc_id and text have the same bitmap, which is there once; an empty table gives no bitmaps;
other columns are passed on whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written
from .common import BLANKS

LEAST = 10  # code points of a key that counts
CELLS = 1 << 16  # ranges of the hash whose lines are counted, at least
FEW = 1000  # a key with fewer lines is never split off

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _lower(text: Column) -> Column:
    """A-Z only; a text of single bytes takes the quicker way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def _own(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that stand for a document: its doc_id and its text."""
    return [F.xxhash64(doc_id, text).alias("own_a"), F.xxhash64(F.lit(1), doc_id, text).alias("own_b")]


def keyed_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """key_a, key_b, doc_id, own_a, own_b, line of every line whose key counts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _whole(F.col("text")).alias("text"))
    lines = docs.select("doc_id", *_own(F.col("doc_id"), F.col("text")),
                        F.posexplode(F.split(_lower(F.col("text")), "\n", -1)).alias("line", "key"))
    lines = lines.withColumn("key", F.btrim("key", F.lit(BLANKS))).where(
        F.char_length("key") >= least)
    return lines.select(F.xxhash64("key").alias("key_a"), F.xxhash64(F.lit(1), "key").alias("key_b"),
                        "doc_id", "own_a", "own_b", "line")


def _holder() -> Column:
    """Orders documents: by doc_id, null last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"))


def common_keys(lines: DataFrame, share: int, bits: int) -> DataFrame:
    """key_a, key_b and the first document of each key with more than ``share`` lines.

    At most (lines / share) keys; only the lines of ranges that hold as many are looked at.
    """
    cell = F.shiftrightunsigned("key_a", 64 - bits)
    full = lines.groupBy(cell.alias("cell")).count().where(F.col("count") > share).select("cell")
    near = lines.withColumn("cell", cell).join(F.broadcast(full), "cell", "left_semi")
    return near.groupBy("key_a", "key_b").agg(
        F.count(F.lit(1)).alias("lines"), F.min(_holder()).alias("holder")).where(
        F.col("lines") > share).select("key_a", "key_b", "holder")


def dropped_lines(lines: DataFrame) -> DataFrame:
    """own_a, own_b, line of every line that goes."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(FEW, lines.count() // parts)
    bits = max(CELLS, 8 * parts).bit_length() - 1
    common = written(common_keys(lines, share, bits), "line-common")
    known = lines.join(F.broadcast(common), ["key_a", "key_b"], "left")
    goes = ~F.col("doc_id").eqNullSafe(F.col("holder.doc_id"))
    hot = known.where(F.col("holder").isNotNull() & goes)

    order = [F.col("doc_id").asc_nulls_last(), F.col("line").asc()]
    rest = known.where(F.col("holder").isNull()).drop("holder").repartitionByRange("key_a")
    rest = rest.sortWithinPartitions("key_a", "key_b", *order)
    so_far = Window.partitionBy("key_a", "key_b").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    first = rest.withColumn("holder", F.first(F.struct("doc_id")).over(so_far))
    return hot.select("own_a", "own_b", "line").unionByName(
        first.where(goes).select("own_a", "own_b", "line"))


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """own_a, own_b, n_dropped and bitmap of every document that loses lines.

    The bitmap is a sorted list of (word, keep): bit i of ``keep`` says whether line 64 word + i
    stays; words that are not in the list stay whole.
    """
    lines = written(keyed_lines(docs, least), "line-keys")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("line").bitwiseAND(63))
    words = dropped_lines(lines).select(
        "own_a", "own_b", F.shiftright("line", 6).alias("word"), bit.alias("bit"))
    words = words.repartition("own_a", "own_b").groupBy("own_a", "own_b", "word").agg(
        F.bit_or("bit").alias("bits"))
    return words.groupBy("own_a", "own_b").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("keep")))).alias("bitmap"))


def _spread(bitmap: Column) -> Column:
    """A bitmap with the words that stay whole filled in, so that a word is found by its place."""
    def step(entry: Column, i: Column) -> Column:
        last = F.coalesce(F.get(bitmap, i - 1)["word"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), entry["word"] - last - 1),
                        F.array(entry["keep"]))
    return F.flatten(F.transform(bitmap, step))


def with_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """All documents as ``document`` (every column of them), n_dropped, bitmap (null: all lines
    stay) and words, the bitmap with all words up to its last."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document"))
    own = _own(F.col("document.doc_id").cast("long"), _whole(F.col("document.text")))
    found = keep_bitmaps(docs, least).withColumn("words", _spread(F.col("bitmap")))
    rows = rows.select("document", *own).join(found, ["own_a", "own_b"], "left")
    return rows.select("document", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                       "bitmap", "words")


def kept(text: Column, words: Column) -> Column:
    """A text without the lines whose bit is not set; ``words`` must be a column, not an expression."""
    def stays(_: Column, i: Column) -> Column:
        word = F.get(words, F.shiftright(i, 6))
        return word.isNull() | (F.getbit(word, i.bitwiseAND(63)) == 1)
    lines = F.split(_whole(text), "\n", -1)
    return F.when(words.isNull(), _whole(text)).otherwise(F.array_join(F.filter(lines, stays), "\n"))


def drop_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents without repeated lines, in the columns of ``docs``."""
    rows = with_bitmaps(docs, least)
    return rows.withColumn("document", F.col("document").withField(
        "text", kept(F.col("document.text"), F.col("words")))).select("document.*")
