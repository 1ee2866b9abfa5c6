"""Names as tables of any size: names that occur in texts, prefixes and aliases of names."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions import text as texts
from ..session import written

SEED = 8  # bytes of a name that texts are searched for; shorter names are searched for whole
FILTER_BITS = 1 << 23  # 1 MB; seeds that fill it pass whole
MOST_SHORT = 1 << 20  # shorter names that go to the texts themselves, 8 MB; of more only the filter does


def _search_functions():
    """Arrow functions for windows of bytes; defined inside a function, they travel by value."""
    def windows(data: np.ndarray, starts: np.ndarray, size: int):
        """Every window of ``size`` bytes inside one text: its place and its bytes as a number."""
        count = len(data) - size + 1
        if count <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        value = np.zeros(count, np.uint64)
        for i in range(size):
            value = value << np.uint64(8) | data[i:i + count].astype(np.uint64)
        owner = np.searchsorted(starts, np.arange(len(data)), "right")
        at = np.flatnonzero(owner[:count] == owner[size - 1:])
        return at, value[at]

    def slot(value: np.ndarray, size: int, bits: int) -> np.ndarray:
        mixed = (value + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ mixed >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)

    def flat(column: pa.Array):
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
        held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        return held[offsets[0]:offsets[-1]], offsets - offsets[0]

    def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 21):
        """Parts of a batch with about ``most`` bytes of text, one row at least."""
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end

    return windows, slot, flat, slices


_windows, _slot, _flat, _slices = _search_functions()


def _seeds_of_names(names: DataFrame, most: int) -> DataFrame:
    """name, rank, offset, size, seed: of each name the window that fewest names have."""
    windows, slot, flat, slices, bits = _windows, _slot, _flat, _slices, FILTER_BITS

    def cut(batches):
        for batch in (part for whole in batches for part in slices(whole, "name")):
            data, starts = flat(batch.column("name"))
            length = np.diff(starts)
            out = []
            for size in range(1, most + 1):
                here = length >= most if size == most else length == size
                at, value = windows(data, starts[1:], size)
                owner = np.searchsorted(starts[1:], at, "right")
                kept = here[owner]
                out.append((owner[kept], (at - starts[owner])[kept], value[kept], size))
            owner = np.concatenate([o[0] for o in out])
            value = np.concatenate([o[2] for o in out])
            size = np.concatenate([np.full(len(o[0]), o[3]) for o in out])
            place = np.concatenate([slot(o[2], o[3], bits) for o in out])
            yield pa.RecordBatch.from_arrays(
                [batch.column("name").take(pa.array(owner)), batch.column("rank").take(pa.array(owner)),
                 pa.array(np.concatenate([o[1] for o in out])), pa.array(size.astype(np.int32)),
                 pa.array(value.view(np.int64)), pa.array(place)],
                names=["name", "rank", "offset", "size", "seed", "slot"])

    kind = dict(names.dtypes)["rank"]
    seeds = written(names.mapInArrow(cut, f"name string, rank {kind}, offset long, size int, seed long, "
                                          "slot long"), "name-seeds")
    common = seeds.groupBy("size", "seed").agg(F.count(F.lit(1)).alias("names"))
    rare = seeds.join(common, ["size", "seed"]).groupBy("name", "rank").agg(
        F.min(F.struct("names", "offset", "size", "seed", "slot")).alias("s"))
    return written(rare.select("name", "rank", "s.offset", "s.size", "s.seed", "s.slot"), "name-seeds")


def longest_name_in(df: DataFrame, text: str, names: DataFrame, name: str, order: str, out: str,
                    negatives: DataFrame | None = None) -> DataFrame:
    """Adds the longest name that occurs in a text, of equally long ones the first by ``order``.

    A text with one of the ``negatives`` (a table with the column ``name``) in it has no name. Names
    of any number: each is searched for by its rarest window of ``SEED`` bytes. A filter of
    ``FILTER_BITS`` bits over all seeds goes to the texts, whose windows that pass it meet the names by
    equality and are compared in full. Texts stay where they are; what passes goes on with the bytes
    around it. Names shorter than ``SEED`` bytes, up to ``MOST_SHORT``, are known to the tasks, and only a
    text's longest go on. Matches are reduced to one a text where they are found, before an exchange.
    """
    table = names.select(F.col(name).cast("string").alias("name"), F.col(order).alias("rank")).where(
        F.col("name") != "").groupBy("name").agg(F.min("rank").alias("rank"))
    table = table.withColumn("bad", F.lit(False))
    if negatives is not None:
        bad = negatives.select(F.col("name").cast("string").alias("name")).where(F.col("name") != "")
        table = table.unionByName(bad.distinct().withColumns(
            {"rank": F.lit(None).cast(dict(table.dtypes)["rank"]), "bad": F.lit(True)}))
    table = table.select("name", F.struct("bad", "rank").alias("rank"))
    seeds = _seeds_of_names(table, SEED)
    word = seeds.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)  # FILTER_BITS in all, whatever the names
    held[word.column("word").to_numpy()] = word.column("bits").to_numpy()
    sizes = [r[0] for r in seeds.select("size").distinct().collect()]  # SEED at most
    reach = seeds.agg(F.max(F.octet_length("name"))).first()[0] or 0
    short = seeds.where(F.col("size") < SEED).groupBy("size", "seed").agg(
        F.min(F.char_length("name")).alias("chars"), F.max("rank.bad").alias("bad"),
        F.min("rank.bad").alias("only_bad")).limit(MOST_SHORT + 1).toArrow()
    exact = short.num_rows <= MOST_SHORT
    known = {}
    for size in (n for n in sizes if exact and n < SEED):
        here = short.filter(pc.equal(short.column("size"), size))
        value = here.column("seed").to_numpy().view(np.uint64)
        order = np.argsort(value)
        known[size] = (value[order], here.column("chars").to_numpy()[order], *(
            here.column(c).to_numpy(zero_copy_only=False).astype(bool)[order] for c in ("bad", "only_bad")))
    slot, flat, slices, bits, whole = _slot, _flat, _slices, FILTER_BITS, SEED

    def hits(eight, left, size):
        """Places whose window of ``size`` bytes passes the filter, by parts that fit the cache."""
        for low in range(0, len(eight), 1 << 16):
            value = eight[low:low + (1 << 16)] >> np.uint64(8 * (whole - size))
            place = slot(value, size, bits)
            hit = np.flatnonzero((held[place >> 6] >> (place & 63) & 1).astype(bool)
                                 & (left[low:low + (1 << 16)] >= size))
            yield low + hit, value[hit]

    def search(batches):
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            data, starts = flat(batch.column("_text"))
            raw, n = data.tobytes(), len(data)
            padded = np.concatenate([data, np.zeros(whole, np.uint8)])
            eight = np.zeros(n, np.uint64)  # the bytes from each place on, as a number
            for i in range(whole):
                eight = eight << np.uint64(8) | padded[i:i + n]
            owners = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            left = starts[owners + 1] - np.arange(n)
            longest, short = np.zeros(batch.num_rows, np.int64), []
            for size in sizes:
                at, value = (np.concatenate(x) for x in zip(
                    (np.empty(0, np.int64), np.empty(0, np.uint64)), *hits(eight, left, size)))
                owner = owners[at]
                if size == whole:
                    low = np.maximum(at - reach, starts[owner])
                    high = np.minimum(at + reach, starts[owner + 1])
                    around = [raw[x:y] for x, y in zip(low.tolist(), high.tolist())]
                    yield found_in(batch, owner, size, value, at - low, around)
                elif exact:  # the window is the name: of each text the longest, and those that are bad
                    values, chars, bad, only_bad = known[size]
                    which = np.minimum(np.searchsorted(values, value), len(values) - 1)
                    same = values[which] == value
                    pair = np.unique(owner[same] * len(values) + which[same])
                    owner, which = np.divmod(pair, len(values))
                    good = ~only_bad[which]
                    np.maximum.at(longest, owner[good], chars[which[good]])
                    short.append((size, owner, values[which], chars[which], good, bad[which]))
                else:  # once for each text
                    order = np.lexsort((value, owner))
                    value, owner = value[order], owner[order]
                    new = np.ones(len(value), bool)
                    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
                    value, owner = value[new], owner[new]
                    yield found_in(batch, owner, size, value, np.zeros(len(value), np.int64), [b""] * len(value))
            for size, owner, value, chars, good, bad in short:
                kept = good & (chars == longest[owner]) | bad
                owner, value = owner[kept], value[kept]
                yield found_in(batch, owner, size, value, np.zeros(len(value), np.int64), [b""] * len(value))

    def found_in(batch, owner, size, value, at, around):
        return pa.RecordBatch.from_arrays(
            [batch.column("_text_id").take(pa.array(owner)), pa.array(np.full(len(at), size, np.int32)),
             pa.array(value.view(np.int64)), pa.array(at), pa.array(around, pa.binary())],
            names=["_text_id", "size", "seed", "at", "around"])

    own = F.sha2(F.col(text).cast("binary"), 256)
    rows = df.where(F.col(text).isNotNull()).select(
        own.alias("_text_id"), F.col(text).cast("string").alias("_text"))
    found = rows.mapInArrow(search, "_text_id string, size int, seed long, at long, around binary")
    met = found.join(seeds, ["size", "seed"])
    raw = F.col("name").cast("binary")
    begin = F.col("at") - F.col("offset")
    met = met.where((F.col("size") < SEED) | (begin >= 0) & (F.substr("around", (begin + 1).cast("int"), F.octet_length(raw)) == raw))
    longest = F.min(F.struct(-F.char_length("name"), F.col("rank.rank"), F.col("name")))
    best = met.groupBy("_text_id").agg(F.max("rank.bad").alias("bad"), longest.alias("best"))
    best = best.where(~F.col("bad")).select(F.col("_text_id").alias("_found_id"), F.col("best.name").alias(out))
    keyed = df.withColumn("_own_id", own)  # a column, so that texts nobody wants stay out of the exchange
    return keyed.join(best, F.col("_own_id") == F.col("_found_id"), "left").select(*df.columns, out)


def canonical_by_table(df: DataFrame, spot: str, aliases: DataFrame, prefixes: DataFrame, out: str,
                       normalise: bool = True, source: str = "from", target: str = "to",
                       blanks=fixed.SPOT_BLANKS, brackets=fixed.SPOT_BRACKETS) -> DataFrame:
    """Adds the canonical name of a raw spot name, with aliases and prefixes as tables.

    Blanks and brackets go, then the longest prefix (column ``prefix``) that leaves something, then an
    alias is followed once. Each distinct name is looked up once, its beginnings meeting the
    prefixes by equality in the lengths that prefixes have. Null and empty names become empty.
    """
    raw = F.coalesce(F.col(spot), F.lit(""))
    names = df.select(raw.alias("_raw")).distinct()
    plain = texts.nfkc(F.col("_raw")) if normalise else F.col("_raw")
    names = names.select("_raw", F.translate(plain, "".join([*blanks, *brackets]), "").alias("_bare"))
    known = prefixes.select(F.col("prefix").alias("_prefix")).where("_prefix <> ''").distinct()
    lengths = known.agg(F.collect_set(F.char_length("_prefix"))).first()[0]  # lengths, not prefixes
    longest = names.select("_raw", "_bare", F.lit(0).alias("_cut"))
    if lengths:
        length = F.explode(F.array(*[F.lit(n) for n in sorted(lengths)]))
        begun = names.select("_raw", "_bare", length.alias("_n")).where(F.col("_n") < F.char_length("_bare"))
        begun = begun.withColumn("_begin", F.left("_bare", "_n"))
        cut = begun.join(known, F.col("_begin") == F.col("_prefix")).select("_raw", "_bare", F.col("_n").alias("_cut"))
        longest = longest.unionByName(cut)
    core = longest.groupBy("_raw", "_bare").agg(F.max("_cut").alias("_cut"))
    core = core.select("_raw", F.expr("substring(_bare, _cut + 1)").alias("_core"))
    to = aliases.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    final = core.join(to, F.col("_core") == F.col("_from"), "left").select(
        F.col("_raw").alias("_key"), F.coalesce("_to", "_core").alias(out))
    return df.join(final, raw == F.col("_key"), "left").select(*df.columns, out)
