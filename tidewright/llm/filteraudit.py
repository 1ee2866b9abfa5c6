"""What a chain of filters removes in every order of the filters (operator 13).

A document is counted by the set of filters it fails. The sets of filters already applied form a
lattice of 2^k states; applying one more filter is an edge. An order is a path from the empty to the
full set. Counting paths forward (orders that reach a state) and backward (orders from a state to the
end) gives each edge the number of orders that take it. What an edge removes is summed once, its
weight makes it a Shapley total, and every step of every order is read from the same edges.

The five filters are those of ``FILTERS``. The last compares texts over the whole table: rows are
reduced to one per text, part and label in each task, so a text that fills a third of the table
meets its smallest doc_id as one row per part and label. What follows is as long as parts times
states. The tables of the lattice follow from the number of filters alone.

Edge cases: a null text is empty and so has no words; a null part is an empty text; a null doc_id is
after all others, so such a row is a copy of any row with a doc_id and of no other null one; rows with
equal text and doc_id are no copies of each other; each row counts; a document without a label, or
with null labels, is neither good nor toxic, of several labels one of 1 is enough; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from .common import BLANKS

FILTERS = "ABCDE"
WORDS, DISTINCT, CAPITALS, SIGNS = 50, 65, 5, "[#$%&*|]"
SPREAD = 1024  # parts in which rows without doc_id are dealt


def own_failures(text: Column) -> Column:
    """Bits 0 to 3: too few words, too few distinct ones, too many capitals, odd signs."""
    words = F.split(F.btrim(text, F.lit(BLANKS)), r"[ \t\n\x0B\f\r]+", -1)
    words = F.when(words == F.array(F.lit("")), F.array().cast("array<string>")).otherwise(words)
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    tests = [F.size(words) < WORDS,
             F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * DISTINCT,
             capitals.cast("long") * 100 > F.char_length(text).cast("long") * CAPITALS,
             text.rlike(SIGNS)]
    return sum((t.cast("int") * (1 << i) for i, t in enumerate(tests[1:], 1)), tests[0].cast("int"))


def failures(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, failed (bits by filter), n, good, toxic: how many documents fail just these filters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    rows = rows.select("doc_id", "part", own_failures(F.col("text")).alias("failed"),
                       F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = rows.withColumn("spread", F.when(
        F.col("doc_id").isNull(), F.pmod(F.hash("digest", "part"), F.lit(SPREAD))).otherwise(0))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = known.withColumn("l_spread", F.lit(0))
    rows = rows.join(known, (F.col("doc_id") == F.col("l_id")) & (F.col("spread") == F.col("l_spread")),
                     "left").fillna(False, ["good", "toxic"])

    group = ["digest", "part", "failed", "good", "toxic"]
    rows = rows.groupBy("doc_id", "spread", *group).agg(F.count(F.lit(1)).alias("copies"))
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "copies"))
    rows = rows.groupBy(*group).agg(F.sum("copies").alias("n"), lead.alias("lead"))
    first = F.min(F.struct("lead.none", "lead.id")).over(Window.partitionBy("digest"))
    rows = rows.withColumn("first", first)
    unique = F.when(F.col("first.none"), F.col("n")).when(
        F.col("lead.id") == F.col("first.id"), F.col("lead.copies")).otherwise(0)
    both = F.explode(F.array(
        F.struct(F.col("failed"), unique.alias("n")),
        F.struct((F.col("failed") + 16).alias("failed"), (F.col("n") - unique).alias("n"))))
    rows = rows.select("part", "good", "toxic", both.alias("set")).where("set.n > 0")

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("set.n"))), F.lit(0)).cast("long")
    return rows.groupBy("part", F.col("set.failed").alias("failed")).agg(
        total(F.lit(True)).alias("n"), total(F.col("good")).alias("good"),
        total(F.col("toxic")).alias("toxic"))


def lattice(k: int) -> list[tuple[int, int, int]]:
    """Every edge (state, filter, orders that take it) of the lattice of k filters' subsets."""
    full = (1 << k) - 1
    states = sorted(range(full + 1), key=int.bit_count)
    forward, backward = dict.fromkeys(states, 0), dict.fromkeys(states, 0)
    forward[0] = backward[full] = 1
    edges = [(s, f) for s in states for f in range(k) if not s >> f & 1]
    for s, f in edges:
        forward[s | 1 << f] += forward[s]
    for s, f in reversed(edges):
        backward[s] += backward[s | 1 << f]
    return [(s, f, forward[s] * backward[s | 1 << f]) for s, f in edges]


def steps(spark: SparkSession, names: str) -> DataFrame:
    """filter_order, step, state, filter: the edge each order takes at each step (k! k rows)."""
    rows = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(names[i] for i in order), step, state, f))
            state |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int")


def edge_sums(failed: DataFrame, k: int) -> DataFrame:
    """What each edge removes and leaves in each part, and the Shapley total of its filter."""
    edge = F.explode(F.array(*[F.struct(
        F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("weight"))
        for s, f, w in lattice(k)]))
    rows = failed.select("part", "failed", "n", "good", "toxic", edge.alias("e")).select("*", "e.*")
    own = F.expr("shiftleft(1, filter)")
    fails = F.col("failed").bitwiseAND(own) != 0
    before = F.col("failed").bitwiseAND(F.col("state")) != 0

    def total(when: Column, what: str = "n") -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    sums = rows.groupBy("part", "state", "filter", "weight").agg(
        total(~fails & ~before).alias("kept"), total(fails & ~before).alias("removed"),
        total(fails & before).alias("redundant"), total(F.col("failed") == own).alias("unique_fails"),
        total(fails & ~before, "good").alias("good_lost"),
        total(fails & ~before, "toxic").alias("toxic_lost"))
    over = Window.partitionBy("part", "filter")
    return sums.withColumn("shapley", F.sum(F.col("weight") * F.col("removed")).over(over))


def audit(failed: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step; ``failed`` as by ``failures``."""
    sums = edge_sums(failed, len(names))
    path = F.broadcast(steps(failed.sparkSession, names))  # k! k rows whatever the data
    return sums.join(path, ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley")
