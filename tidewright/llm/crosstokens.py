"""Links between the tokens of two tokenizers over the same texts (operator 12).

A text is encoded by A (byte-level BPE) with a blank before it and by B (a piece model that adds the
blank itself). Byte offsets at which a token of both ends cut the tokens into groups; all A-B pairs
of a group are links. Steps:

1. Texts are encoded batch by batch. One NumPy state vector holds the A and B pointers of all
   documents of a batch (``lockstep``). A step compares the two tokens' ends in every document at
   once, moves the pointer that is behind, or both at a cut, emits the cuts and now and then drops
   the finished documents from the vector. Long documents enter as several lanes, begun at offsets
   where both end, so a step count does not grow with the longest text.
2. A run is what one task reads of about ``RUN_BYTES`` of text. Each of its id pairs is written once,
   with the number of its documents that hold it, and its documents as places in that list of pairs,
   a byte or two each.
3. The runs' pair counts are summed over the corpus and each A id's highest count is taken (one row
   per id of A, a bound by the vocabulary, so it is broadcast). The counts go back to the runs that
   have the pair; a run's documents are read in the order of their run, its counts before them, so
   a worker holds the pairs of one run only.

Documents never meet by id, so equal ids, nulls and repeated rows need no care; pairs are reduced
within runs before any shuffle.

Edge cases: a null or empty text, and one whose tokens' bytes differ from blank and text (B drops or
changes characters), has no tokens and zeros; strings of special tokens in a text are plain text;
rows are documents each, whatever their doc_id; an empty table gives no rows; other columns are
ignored. Groups may be of any size: their pairs are counted by distinct ids, a block at a time.
"""
from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .common import file_bytes, per_process, pieces, ranges

RUN_BYTES = 8 << 20
LANE = 512  # A tokens of a document that one lane of the state vector takes
BLOCK = 1 << 20  # links that are expanded at a time

# Letters whose classes no library disputes; other texts take the slower library.
_PLAIN = r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿŒœ–—‘’“”…а-яА-Яぁ-ゖァ-ヺー一-龥、。]*"
# Fixed value: the splitting rule of the byte-level pre-tokenizer.
_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokenizer's ids of texts and the bytes of its tokens."""

    def _measure(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.kind = np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class ByteSide(Side):
    def __init__(self, vocabulary: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_buffer(vocabulary)
        self.whole.encode_special_tokens = True
        letters, rules = _byte_letters(), json.loads(vocabulary)
        added = {t["content"] for t in rules.get("added_tokens") or []}
        tokens = [b""] * self.whole.get_vocab_size()
        for token, i in self.whole.get_vocab().items():
            tokens[i] = token.encode() if token in added else bytes(map(letters.__getitem__, token))
        self._measure(tokens)
        # Where ids rise with the rank of their merge, a quicker library gives the same ids.
        vocab, merges = rules["model"]["vocab"], rules["model"]["merges"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        split = rules.get("pre_tokenizer") or {}
        self.quick = None
        if (split.get("type"), split.get("use_regex"), split.get("add_prefix_space"),
                rules.get("normalizer")) == ("ByteLevel", True, False, None) and made == sorted(made):
            ranks = {tokens[i]: i for t, i in vocab.items() if t not in added}
            self.quick = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks,
                                           special_tokens={}).encode_ordinary
        self.plain = re.compile(_PLAIN).fullmatch

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = [self.quick(t) if self.quick and self.plain(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.whole.encode_batch_fast(
                [texts[i] for i in rest], add_special_tokens=False)):
            out[i] = found.ids
        return out


class PieceSide(Side):
    def __init__(self, vocabulary: bytes):
        import sentencepiece

        self.whole = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        pieces_ = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())]
        self._measure([bytes([int(p[3:5], 16)]) if self.whole.is_byte(i)
                       else p.replace("▁", " ").encode() for i, p in enumerate(pieces_)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.whole.encode(texts, num_threads=1)


def sides(a: bytes, b: bytes) -> tuple[ByteSide, PieceSide]:
    """The worker's own tokenizers."""
    return per_process(("sides", hash((a, b))), lambda: (ByteSide(a), PieceSide(b)))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids end to end and where each document's begin, the end included."""
    sizes = [len(x) for x in lists]
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, int(at[-1])), at


def _lanes(ends_a, at_a, ends_b, lane: int):
    """First A token and the A token after the last of stretches between two cuts."""
    number = (at_a[1:] - at_a[:-1] + lane - 1) // lane
    owner = np.repeat(np.arange(len(number)), number)
    start = ranges(np.zeros(len(number)), number) * lane + at_a[:-1][owner]
    inner = np.flatnonzero(start > at_a[:-1][owner])
    last = start[inner] - 1  # the A token before the lane; moved on to one that ends at a cut
    open_ = np.arange(len(inner))
    while len(open_):
        end = ends_a[last[open_]]
        open_ = open_[ends_b[np.searchsorted(ends_b, end)] != end]
        last[open_] += 1
    i = np.unique(np.concatenate([at_a[:-1], last + 1]))
    i = i[i < at_a[-1]]
    return i, np.append(i[1:], at_a[-1])[:len(i)]


def lockstep(ends_a: np.ndarray, at_a: np.ndarray, ends_b: np.ndarray, lane: int = LANE
             ) -> tuple[np.ndarray, np.ndarray]:
    """A and B tokens that end a group, both in order.

    Ends are rising offsets into the documents' bytes end to end; every document's last A and B
    token end together. The state is one row of pointers per lane; a step moves all of them.
    """
    i, stop = _lanes(ends_a, at_a, ends_b, lane)
    j = np.where(i > 0, np.searchsorted(ends_b, ends_a[i - 1], "right"), 0)
    cuts_a, cuts_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    ends_a = np.append(ends_a, np.iinfo(np.int64).max)
    ends_b = np.append(ends_b, np.iinfo(np.int64).max)
    while len(i):
        a, b = ends_a[i], ends_b[j]
        cut = np.flatnonzero(a == b)
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i = i + (a <= b)
        j = j + (b <= a)
        going = i < stop
        if not going.all():  # finished lanes leave the vector
            i, j, stop = i[going], j[going], stop[going]
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def _groups(last_a: np.ndarray, last_b: np.ndarray, at_a: np.ndarray):
    """First tokens, sizes and document of each group, from the tokens that end them."""
    first_a = np.concatenate([[0], last_a[:-1] + 1])[:len(last_a)]
    first_b = np.concatenate([[0], last_b[:-1] + 1])[:len(last_b)]
    owner = np.searchsorted(at_a, first_a, "right") - 1
    return first_a, last_a + 1 - first_a, first_b, last_b + 1 - first_b, owner


def links(ids_a, ids_b, groups, size_b: int):
    """Distinct id pairs of each document: its number, the pair (A id times ``size_b`` plus B id)
    and how many links have it; in order of both."""
    first_a, n_a, first_b, n_b, owner = groups
    total = n_a * n_b
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    span = int(size_b) * (int(ids_a.max(initial=0)) + 1)

    small = np.flatnonzero(total <= 4096)
    cuts = np.searchsorted(np.cumsum(total[small]), np.arange(0, total[small].sum() + BLOCK, BLOCK))
    for x, y in zip(cuts, np.append(cuts[1:], len(small))):
        here = small[x:y]
        if not len(here):
            continue
        g = np.repeat(here, total[here])
        place = ranges(np.zeros(len(here)), total[here])
        a, b = ids_a[first_a[g] + place // n_b[g]], ids_b[first_b[g] + place % n_b[g]]
        key, times = np.unique(owner[g] * span + a * size_b + b, return_counts=True)
        keys.append(key)
        counts.append(times)
    for g in np.flatnonzero(total > 4096):
        a, x = np.unique(ids_a[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
        b, y = np.unique(ids_b[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
        step = max(1, BLOCK // len(b))
        for at in range(0, len(a), step):
            pair = a[at:at + step, None] * size_b + b[None, :]
            keys.append((owner[g] * span + pair).ravel())
            counts.append((x[at:at + step, None] * y[None, :]).ravel())
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    fresh = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    counts = np.add.reduceat(counts, fresh) if len(fresh) else counts
    return keys[fresh] // span, keys[fresh] % span, counts


def _decimals(most: int):
    """Digits of the numbers below ``most``, left-aligned, and how many each has."""
    numbers = np.arange(most)
    width = len(str(most))
    size = np.ones(most, np.int64)
    for power in range(1, width):
        size += numbers >= 10 ** power
    digits = np.zeros((most, width), np.uint8)
    for place in range(width):
        rest = size - 1 - place
        digits[:, place] = np.where(rest >= 0, numbers // 10 ** np.maximum(rest, 0) % 10 + 48, 0)
    return digits, size


def texts_of_groups(ids_a, ids_b, groups, documents: int) -> list[bytes]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
    first_a, n_a, first_b, n_b, owner = groups
    most = int(max(ids_a.max(initial=0), ids_b.max(initial=0))) + 1
    digits, size = per_process(("decimals", 1 << most.bit_length()), lambda: _decimals(1 << most.bit_length()))
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    place_a = np.arange(len(ids_a)) + np.repeat(first_b, n_a)
    place_b = np.arange(len(ids_b)) + np.repeat(first_a + n_a, n_b)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark[first_a + n_a - 1 + first_b] = ord("|")
    mark[first_b + n_b - 1 + first_a + n_a] = ord(";")
    long = size[ids]
    end = np.cumsum(long + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = mark
    start = end - 1 - long
    for k in range(digits.shape[1]):
        has = np.flatnonzero(long > k)
        if len(has):
            out[start[has] + k] = digits[ids[has], k]
    tokens = np.bincount(owner, n_a + n_b, documents).astype(np.int64) if len(owner) else np.zeros(
        documents, np.int64)
    ends = np.concatenate([[0], np.cumsum(tokens)])
    stop = np.where(ends > 0, end[ends - 1], 0) if len(end) else np.zeros(len(ends), np.int64)
    data, stop = out.tobytes(), stop.tolist()
    return [data[a:b - 1] if b > a else b"" for a, b in zip(stop, stop[1:])]


class Aligned:
    """The tokens, groups and counts of some texts."""

    def __init__(self, texts: list[str | None], a: Side, b: Side, lane: int = LANE):
        texts = [t or "" for t in texts]
        ids_a = a.encode([" " + t if t else "" for t in texts])
        ids_b = b.encode(texts)
        for n, (t, x, y) in enumerate(zip(texts, ids_a, ids_b)):
            data = b" " + t.encode() if t else b""
            if a.joined(x) != data or b.joined(y) != data:
                ids_a[n], ids_b[n] = [], []
        (self.a, self.at_a), (self.b, self.at_b) = _flat(ids_a), _flat(ids_b)
        self.last_a, self.last_b = lockstep(np.cumsum(a.length[self.a]), self.at_a,
                                            np.cumsum(b.length[self.b]), lane)
        self.documents = len(texts)
        self.groups = _groups(self.last_a, self.last_b, self.at_a)


def _per_document(owner, weight, documents: int) -> np.ndarray:
    out = np.zeros(documents, np.int64)
    np.add.at(out, owner, weight)
    return out


def _bits(last: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For each document a bit per token: whether it ends a group."""
    marks = np.zeros(int(at[-1]), np.uint8)
    marks[last] = 1
    ends = at.tolist()
    return [np.packbits(marks[x:y], bitorder="little").tobytes() for x, y in zip(ends, ends[1:])]


def _cut(data: bytes, at: np.ndarray) -> list[bytes]:
    ends = at.tolist()
    return [data[x:y] for x, y in zip(ends, ends[1:])]


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batch(schema: str, **columns) -> pa.RecordBatch:
    """A batch of some columns of a schema; the others are null."""
    rows = len(next(iter(columns.values())))
    names, types = zip(*((n, _TYPES[t]) for n, t in map(str.split, schema.split(", "))))
    return pa.RecordBatch.from_arrays(
        [pa.nulls(rows, t) if n not in columns else columns[n] if isinstance(columns[n], pa.Array)
         else pa.array(columns[n], t) for n, t in zip(names, types)], names=names)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


TOKENS = "doc_id long, a binary, b binary, a_ends binary, b_ends binary"


def encode(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, the ids of A and of B (little-endian, two bytes each, or four for more than 65,536
    tokens) and for each id a bit (lowest first) that says whether a group ends with it."""
    held = file_bytes(a_path), file_bytes(b_path)

    def encoded(batches):
        a, b = sides(*held)
        for part in (p for batch in batches for p in pieces(batch)):
            here = Aligned(part.column("text").to_pylist(), a, b)
            yield _batch(TOKENS, doc_id=part.column("doc_id"),
                         a=_cut(here.a.astype(a.kind).tobytes(), here.at_a * a.kind.itemsize),
                         b=_cut(here.b.astype(b.kind).tobytes(), here.at_b * b.kind.itemsize),
                         a_ends=_bits(here.last_a, here.at_a), b_ends=_bits(here.last_b, here.at_b))

    return _texts(docs).mapInArrow(encoded, TOKENS)


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of seven bits a byte, the last byte below 128; and where each number begins."""
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 9))
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(at[-1]), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        out[at[has] + k] = (values[has] >> 7 * k & 127) | np.where(size[has] > k + 1, 128, 0)
    return out, at


def unpacked(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])[:len(last)]
    out = np.zeros(len(last), np.int64)
    for k in range(int((last - first).max(initial=-1)) + 1):
        has = np.flatnonzero(last - first >= k)
        out[has] |= (data[first[has] + k] & 127).astype(np.int64) << 7 * k
    return out


KINDS = ("run long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, places binary, pairs binary, holders binary")


class Run:
    """Documents of one run, held until its list of pairs is known."""

    def __init__(self, number: int):
        self.number, self.bytes, self.parts = number, 0, []

    def add(self, part: pa.RecordBatch, here: Aligned, size_b: int) -> None:
        _, n_a, _, n_b, owner = here.groups
        digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts_of_groups(
            here.a, here.b, here.groups, here.documents)]
        rows = {"doc_id": part.column("doc_id"), "n_a": np.diff(here.at_a), "n_b": np.diff(here.at_b),
                "n_groups": np.bincount(owner, minlength=here.documents),
                "n_links": _per_document(owner, n_a * n_b, here.documents), "groups_sha256": digests}
        self.parts.append((rows, links(here.a, here.b, here.groups, size_b)))
        self.bytes += part.nbytes

    def close(self):
        """Rows of kind 0, the pairs in slices, and of kind 1, the documents. A document's places are
        the steps between its pairs in the run's list, then how many links have each."""
        pair, at = np.unique(np.concatenate([pair for _, (_, pair, _) in self.parts]), return_inverse=True)
        holders = np.bincount(at, minlength=len(pair))
        cuts = range(0, len(pair), 1 << 16)
        yield _batch(KINDS, run=[self.number] * len(cuts), kind=[0] * len(cuts),
                     pairs=[pair[x:x + (1 << 16)].tobytes() for x in cuts],
                     holders=[holders[x:x + (1 << 16)].tobytes() for x in cuts])
        read = 0
        for rows, (owner, pairs, times) in self.parts:
            here, read = at[read:read + len(pairs)], read + len(pairs)
            documents = len(rows["n_a"])
            size = np.bincount(owner, minlength=documents)
            ends = np.concatenate([[0], np.cumsum(size)])
            steps = np.diff(here, prepend=0)
            first = ends[:-1][size > 0]
            steps[first] = here[first]
            both = np.empty(2 * len(here), np.int64)
            place = np.arange(len(here)) + np.repeat(ends[:-1], size)
            both[place], both[place + np.repeat(size, size)] = steps, times
            data, begins = packed(both)
            yield _batch(KINDS, run=[self.number] * documents, kind=[1] * documents,
                         places=_cut(data.tobytes(), begins[2 * ends]), **rows)


def refer(docs: DataFrame, a_path: str, b_path: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Rows of all runs, see ``Run.close``."""
    held = file_bytes(a_path), file_bytes(b_path)

    def referred(batches):
        a, b = sides(*held)
        run = Run(TaskContext.get().partitionId() << 32)
        for part in (p for batch in batches for p in pieces(batch)):
            run.add(part, Aligned(part.column("text").to_pylist(), a, b), len(b.tokens))
            if run.bytes >= run_bytes:
                yield from run.close()
                run = Run(run.number + 1)
        if run.parts:
            yield from run.close()

    return _texts(docs).mapInArrow(referred, KINDS)


def _pairs_of_runs(batches):
    for batch in batches:
        for run, pairs, holders in zip(*(batch.column(c).to_pylist() for c in ("run", "pairs", "holders"))):
            pairs = np.frombuffer(pairs, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pairs), run)), pa.array(pairs),
                 pa.array(np.frombuffer(holders, np.int64))], names=["run", "pair", "n"])


def pair_counts(runs: DataFrame, size_b: int) -> DataFrame:
    """pair, n (documents of the corpus that hold it linked) and best: no pair of its A id has more."""
    counts = written(runs.groupBy("pair").agg(F.sum("n").alias("n")), "token-pairs")
    a_id = F.expr(f"pair div {size_b}")
    top = counts.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))  # one row per id of A
    return counts.join(F.broadcast(top), a_id == F.col("a_id")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
       "groups_sha256 string")


def _scored(part: pa.RecordBatch, n: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """Documents of a run with the sums over their links; ``n`` and ``best`` by place."""
    data = part.column("places").to_pylist()
    values = unpacked(np.frombuffer(b"".join(data), np.uint8))
    size = np.array([(np.frombuffer(d, np.uint8) < 128).sum() // 2 for d in data], np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(int(ends[-1])) + np.repeat(ends[:-1], size)
    steps, times = values[at], values[at + np.repeat(size, size)]
    owner = np.repeat(np.arange(len(size)), size)
    place = np.cumsum(steps)
    before = np.concatenate([[0], place])[ends[:-1]]
    place = place - before[owner]
    rows = {c: part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    return _batch(OUT, **rows, n_best=_per_document(owner, times * best[place], len(size)),
                  count_sum=_per_document(owner, times * n[place], len(size)))


def align(docs: DataFrame, a_path: str, b_path: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Per document its tokens, groups, links, how many links are an A id's commonest pair (n_best),
    the links' counts summed, and a digest of the groups."""
    stored = written(refer(docs, a_path, b_path, run_bytes), "token-links")
    size_b = len(PieceSide(file_bytes(b_path)).tokens)
    runs = stored.where("kind = 0").select("run", "pairs", "holders").mapInArrow(
        _pairs_of_runs, "run long, pair long, n long")
    counts = pair_counts(runs.select("pair", "n"), size_b)
    known = runs.select("run", "pair").join(counts, "pair").select(
        "run", F.lit(0).alias("kind"), "pair", "n", "best")
    rows = stored.where("kind = 1").drop("pairs", "holders")
    both = known.unionByName(rows, allowMissingColumns=True)
    both = both.repartition("run").sortWithinPartitions("run", "kind", "pair")

    def counted(batches):
        """A run's pairs come first and in the order of its list, then its documents."""
        number, held, table = None, [], None
        for batch in batches:
            cuts = np.flatnonzero(np.diff(batch.column("run").to_numpy())) + 1
            for x, y in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(x, y - x)
                if part.column("run")[0].as_py() != number:
                    number, held, table = part.column("run")[0].as_py(), [], None
                lead = int((part.column("kind").to_numpy() == 0).sum())
                if lead:
                    held.append([part.column(c).slice(0, lead).to_numpy(zero_copy_only=False)
                                 for c in ("n", "best")])
                if lead == part.num_rows:
                    continue
                if table is None:
                    n, best = map(np.concatenate, zip(*held)) if held else np.empty((2, 0), np.int64)
                    table = n.astype(np.int64), best.astype(np.int64)
                for at in range(lead, part.num_rows, 500):
                    yield _scored(part.slice(at, min(500, part.num_rows - at)), *table)

    return both.mapInArrow(counted, OUT)
