"""A uniform shuffle into shards of exact size, by a communication matrix (operator 10).

Every row order is equally likely, and so is every assignment to shards whose sizes differ by
one at most (law ``rows``). How many rows of an input partition go to a shard is drawn first:
the counts of a random deal, one hypergeometric draw after another, given the rows of each
partition and the room left in each shard. The rows are permuted inside their partition without
an exchange, the permuted partition is cut into runs of those lengths, the runs are exchanged,
and rows are permuted again inside their shard.

The matrix is drawn in two steps of DataFrame functions: first how many rows of each block of
partitions go to each shard, in one row of about the square root of the number of partitions, then
each block by itself, in as many rows. A draw takes its random number from a hash of its place in
the matrix, so a lost executor draws the same again.

Rows and their random numbers are written once, so a lost executor or a second reading cannot
deal anew. The driver holds neither counts nor rows. A shard is permuted
in slices of its second random number of about ``SLICE`` rows, so none is sorted in one task;
slices are also what keeps the exchange even when a shard is large. Keys play no part, so equal
rows and hot keys cannot make it uneven.

Edge cases: nulls in any column are carried along; repeated rows are rows like others; an empty
table gives an empty result; columns named ``shard`` or ``slot`` are replaced.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import written

SLICE = 2000
#: Counts of the matrix that are broadcast (32 MB). Input partitions are put together, without an
#: exchange, until there are no more, or one for each shard if there are more shards.
MOST_BROADCAST = 1 << 22
_PLACES = 33  # bits that monotonically_increasing_id gives to the place in a partition


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _uniform(*place: Column) -> Column:
    """A number from 0 to below 1 that depends on the place alone."""
    return F.shiftrightunsigned(F.xxhash64(*place), 11).cast("double") * F.lit(2.0 ** -53)


def hypergeometric(uniform: Column, good: Column, bad: Column, taken: Column) -> Column:
    """How many of ``taken`` rows out of ``good + bad`` are good, by inversion.

    Probabilities relative to the mode's are summed to both sides of it, 9 standard deviations (of
    the binomial of the smaller of taken and left rows) and 60 steps far at most. Beyond, Bernstein's
    bound leaves less than 2 ** -56, so the draw is right to the precision of a double.
    """
    def number(column: Column) -> Column:
        return column.cast("double")

    def walk(from_: Column, steps: Column, up: bool, p: Column, rest: Column) -> Column:
        """Sum of the probabilities, and the step at which ``rest`` is used up."""
        def ratio(k: Column) -> Column:
            if up:
                return ((p.good - k + 1) * (p.taken - k + 1)) / (k * (p.bad - p.taken + k))
            return ((k + 1) * (p.bad - p.taken + k + 1)) / ((p.good - k) * (p.taken - k))

        def step(held: Column, i: Column) -> Column:
            k = from_ + i if up else from_ - i
            return _let(held.weight * ratio(k), lambda weight: F.struct(
                weight.alias("weight"), (held.sum + weight).alias("sum"),
                F.when(held.sum > rest, held.k).otherwise(k).alias("k")))

        each = F.when(steps > 0, F.sequence(F.lit(1), steps.cast("int"))).otherwise(
            F.array().cast("array<int>"))
        return F.aggregate(each, F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"),
                                          from_.alias("k")), step)

    def drawn(p: Column) -> Column:
        all_ = F.lit(float("inf"))
        return _let(F.struct(walk(p.mode, p.up, True, p, all_).sum.alias("up"),
                             walk(p.mode, p.down, False, p, all_).sum.alias("down")),
                    lambda sums: _let(uniform * (sums.up + sums.down + 1) - 1, lambda rest: (
                        F.when(rest < 0, p.mode)
                        .when(rest < sums.up, walk(p.mode, p.up, True, p, rest).k)
                        .otherwise(walk(p.mode, p.down, False, p, rest - sums.up).k))))

    def prepared(p: Column) -> Column:
        all_ = p.good + p.bad
        least, most = F.greatest(p.taken - p.bad, F.lit(0.0)), F.least(p.good, p.taken)
        share = p.good / all_
        far = F.ceil(9 * F.sqrt(F.least(p.taken, all_ - p.taken) * share * (1 - share)) + 60)
        mode = F.least(most, F.greatest(least, F.floor(
            (p.taken + 1) * (p.good + 1) / (all_ + 2)).cast("double")))
        return _let(mode, lambda mode: F.struct(
            p.good.alias("good"), p.bad.alias("bad"), p.taken.alias("taken"), mode.alias("mode"),
            F.least(far, most - mode).alias("up"), F.least(far, mode - least).alias("down")))

    numbers = F.struct(number(good).alias("good"), number(bad).alias("bad"),
                       number(taken).alias("taken"))
    draw = _let(numbers, lambda p: _let(prepared(p), drawn))
    return F.when((taken == 0) | (good == 0), F.lit(0)).otherwise(draw).cast("long")


def _dealt(room: Column, rows: Column, place: Callable[[Column, Column], Column]) -> Column:
    """How many of each part's rows go to each shard, for parts of ``rows`` (an array of p, n) that
    fill the ``room`` of the shards exactly: an array of p and counts."""
    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)

    def row(room: Column, part: Column) -> Column:
        def draw(held: Column, shard: Column) -> Column:
            here = F.get(room, shard)
            return _let(hypergeometric(place(part.p, shard), here, held.others - here, held.taken),
                        lambda got: F.struct((held.taken - got).alias("taken"),
                                             (held.others - here).alias("others"),
                                             F.concat(held.counts, F.array(got)).alias("counts")))

        start = F.struct(part.n.alias("taken"), total(room).alias("others"),
                         F.array().cast("array<bigint>").alias("counts"))
        return F.aggregate(F.sequence(F.lit(0), F.size(room) - 1), start, draw, lambda held: held.counts)

    def deal(held: Column, part: Column) -> Column:
        return _let(row(held.room, part), lambda counts: F.struct(
            F.zip_with(held.room, counts, lambda r, n: r - n).alias("room"),
            F.concat(held.out, F.array(F.struct(part.p.alias("p"), counts.alias("counts")))).alias("out")))

    start = F.struct(room.alias("room"),
                     F.array().cast("array<struct<p: bigint, counts: array<bigint>>>").alias("out"))
    return F.aggregate(rows, start, deal, lambda held: held.out)


def matrix(rows: DataFrame, parts: int, shards: int, seed: int) -> DataFrame:
    """For each partition ``p`` of ``n`` rows (``parts`` lines), where its run for each shard ends;
    shard sizes differ by one at most."""
    wide = max(1, round(parts ** 0.5))
    ranked = rows.select("n", "p", (F.row_number().over(
        Window.orderBy("p")) - 1).alias("nth"))  # a line per partition, MOST_BROADCAST at most
    blocks = ranked.groupBy(F.expr(f"nth div {wide}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("p", "n"))).alias("parts"), F.sum("n").alias("n"))
    blocks = written(blocks, "shard-blocks")

    number = F.sequence(F.lit(0), F.lit(shards - 1))
    order = F.sort_array(F.transform(number, lambda s: F.struct(
        F.xxhash64(F.lit(seed), F.lit("larger"), s).alias("at"), s.alias("s"))))
    all_ = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + b.n)
    larger = F.transform(F.filter(F.transform(order, lambda x, i: F.struct(x.s.alias("s"), i.alias("i"))),
                                  lambda x: x.i < F.col("total") % shards), lambda x: x.s)
    whole = blocks.groupBy().agg(F.sort_array(F.collect_list(F.struct(
        F.col("block").cast("long").alias("p"), "n"))).alias("blocks"))
    whole = whole.withColumn("total", all_).withColumn("larger", larger)
    room = F.transform(number, lambda s: F.expr(f"total div {shards}")
                       + F.array_contains("larger", s).cast("long"))
    first = whole.select(F.explode(_dealt(room, F.col("blocks"), lambda p, s: _uniform(
        F.lit(seed), F.lit("block"), p, s))).alias("b")).select(
        F.col("b.p").alias("b"), F.col("b.counts").alias("room"))
    first = written(first, "shard-block-counts")
    each = blocks.join(first, F.col("block") == F.col("b")).select(F.explode(_dealt(
        F.col("room"), F.col("parts"), lambda p, s: _uniform(F.lit(seed), F.lit("part"), p, s))).alias("m"))
    ends = F.aggregate("m.counts", F.array().cast("array<bigint>"), lambda held, n: F.concat(
        held, F.array(F.coalesce(F.element_at(F.concat(F.array(F.lit(0).cast("long")), held), -1), F.lit(0)) + n)))
    return each.select("m.p", ends.alias("ends"))


def shuffle(docs: DataFrame, shards: int = 40, seed: int = 20) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` and ``slot`` (its place there, from 0)."""
    spark = docs.sparkSession
    kept = [n for n in docs.columns if n.lower() not in ("shard", "slot")]
    rows = docs.select(F.struct(*[docs[f"`{n}`"] for n in kept]).alias("row"),
                       F.rand(seed).alias("first"), F.rand(seed + 1).alias("second"))
    rows = rows.coalesce(max(1, MOST_BROADCAST // shards))
    permuted = rows.sortWithinPartitions("first").select(
        "row", "second", F.monotonically_increasing_id().alias("place"))
    permuted = written(permuted, "shard-rows").select(
        "row", "second", F.shiftright("place", _PLACES).alias("part"),
        F.col("place").bitwiseAND(F.lit((1 << _PLACES) - 1)).alias("at"))

    counts = written(permuted.groupBy(F.col("part").alias("p")).agg(F.count("*").alias("n")),
                     "shard-counts")
    parts, total = counts.select(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    runs = F.broadcast(written(matrix(counts, parts, shards, seed), "shard-matrix"))
    slices = max(1, total // (shards * SLICE))
    dealt = permuted.join(runs, F.col("part") == F.col("p")).select(
        "row", "second", "part", "at",
        F.size(F.filter("ends", lambda end: end <= F.col("at"))).alias("shard"),
        F.floor(F.col("second") * slices).cast("int").alias("slice"))

    sizes = dealt.groupBy("shard", "slice").count()
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("shard").alias("s_shard"), F.col("slice").alias("s_slice"),
                          F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    place = Window.partitionBy("shard", "slice").orderBy("second", "part", "at")
    numbered = dealt.withColumn("nth", F.row_number().over(place))
    out = numbered.join(starts, (F.col("shard") == F.col("s_shard"))
                        & (F.col("slice") == F.col("s_slice")))
    return out.select("row.*", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"))
