"""Byte-level BPE with pre-tokenisation by a scan instead of a regular expression (operator 7).

Each code point has a class, refined by what follows it (is a quote the start of a contraction,
does white space go on). A class is a function from the state left of a code point to the state
right of it; functions compose associatively, so blocks of text are composed side by side, the
block functions are scanned in a logarithmic number of steps, and a second pass fills in the
states and with them the boundaries. The slices between boundaries go through pair merging, each
distinct slice of a worker once; slice offsets are kept beside the ids, so any part of a text can
be decoded without the rest.

Edge cases: null and empty texts have no ids; a null doc_id is carried along; slices of any
length are merged with a heap; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import base64
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import file_bytes, per_process, pieces, utf8

# Classes of code points; a quote and white space are refined by what follows.
LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2, BLANK, SPACE, SPACES = range(8)
# States: inside a run of letters, numbers, others or white space; after a blank that belongs to
# what follows; one or two letters of a contraction still to come; after the end of a slice.
_L, _N, _O, _W, _B, _C1, _C2, _E = range(8)
STATES = CLASSES = 8
#: White space as Unicode's property has it. Fixed values.
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
           0x202F, 0x205F, 0x3000]
BLOCK = 128


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice begins, by class and state; the upper half of the classes
    is for a text's first code point, where every state counts as after the end."""
    into = np.empty((CLASSES, STATES), np.uint8)
    cut = np.ones((CLASSES, STATES), bool)
    for kind, run in ((LETTER, _L), (NUMBER, _N), (OTHER, _O), (SPACES, _W)):
        into[kind] = run
        cut[kind, run] = False
    for kind in (LETTER, NUMBER, OTHER):
        cut[kind, _B] = False
    into[LETTER, _C2], into[LETTER, _C1] = _C1, _E
    cut[LETTER, [_C2, _C1]] = False
    for kind, rest in ((QUOTE_1, _C1), (QUOTE_2, _C2)):
        into[kind] = rest
        into[kind, [_O, _B]] = _O
        cut[kind, [_O, _B]] = False
    into[BLANK], into[SPACE] = _B, _E
    first = np.repeat(into[:, [_E]], STATES, axis=1)
    return np.concatenate([into, first]), np.concatenate([cut, np.ones_like(cut)])


def _classes() -> np.ndarray:
    kind = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kind[point] = LETTER
        elif major == "N":
            kind[point] = NUMBER
    kind[_SPACES] = SPACES
    return kind


def classify(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Class of each code point; ``firsts`` are the places where texts begin."""
    kind = per_process(("classes",), _classes)[points]
    count = len(points)
    ends = np.zeros(count, bool)  # the last code point of a text
    ends[firsts[1:] - 1] = True
    ends[-1:] = True
    spaces = kind == SPACES
    last = np.flatnonzero(spaces & ~ends)
    last = last[kind[last + 1] != SPACES]  # more text follows, and no white space
    kind[last] = np.where(points[last] == 0x20, BLANK, SPACE)
    quote = np.flatnonzero((points == 0x27) & ~ends)
    one = points[quote + 1]
    kind[quote[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE_1
    far = ~ends[quote + 1] & (quote + 2 < count)
    quote, one = quote[far], one[far]
    two = points[quote + 2]
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    kind[quote[pair | ((one == ord("l")) & (two == ord("l")))]] = QUOTE_2
    kind[firsts] += CLASSES
    return kind


def boundaries(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places of the code points that begin a slice."""
    count = len(points)
    if not count:
        return np.empty(0, np.int64)
    into, cut = _machine()
    into, cut = into.ravel(), cut.ravel()
    blocks = -(-count // BLOCK)
    kind = np.zeros(blocks * BLOCK, np.int32)
    kind[:count] = classify(points, firsts)
    steps = np.ascontiguousarray(kind.reshape(blocks, BLOCK).T) * STATES
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))  # a block as one function
    for step in steps:
        whole = into[step[:, None] + whole]
    reach = 1
    while reach < blocks:  # now everything from the start of the scan to each block's end
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), 1)
        reach *= 2
    state = np.full(blocks, _E, np.uint8)
    state[1:] = whole[:-1, _E]
    found = np.empty((BLOCK, blocks), bool)
    for at, step in enumerate(steps):
        here = step + state
        found[at] = cut[here]
        state = into[here]
    return np.flatnonzero(found.T.ravel()[:count])


def ranks(vocabulary: bytes) -> dict[bytes, int]:
    rows = (line.split() for line in vocabulary.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in rows}


def merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of a slice: the neighbours of lowest rank are joined, leftmost first."""
    whole = rank.get(piece)
    if whole is not None:
        return [whole]
    size = len(piece)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(r, i, i + 2) for i in range(size - 1)
            if (r := rank.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    live = [True] * size
    while heap:
        _, at, end = heapq.heappop(heap)
        middle = after[at]
        if not live[at] or middle >= size or after[middle] != end:
            continue  # one of the two has been joined meanwhile
        live[middle] = False
        after[at] = end
        if end < size:
            before[end] = at
            further = after[end]
            r = rank.get(piece[at:further])
            if r is not None:
                heapq.heappush(heap, (r, at, further))
        left = before[at]
        if left >= 0:
            r = rank.get(piece[left:end])
            if r is not None:
                heapq.heappush(heap, (r, left, end))
    out, at = [], 0
    while at < size:
        out.append(rank[piece[at:after[at]]])
        at = after[at]
    return out


class ByteEncoder:
    """A worker's ranks and the ids of the slices it has met, ``most`` at a time."""

    def __init__(self, vocabulary: bytes, most: int = 500_000):
        self.rank, self.most, self.known = ranks(vocabulary), most, {}
        top = max(self.rank.values())
        self.kind = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.tokens = [b""] * (top + 1)
        for token, at in self.rank.items():
            self.tokens[at] = token

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids by slice (``kind``), the slices' byte offsets, and each text's first slice."""
        if len(self.known) > self.most:
            self.known = {}
        held = data.tobytes()
        points = np.frombuffer(held.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # the byte of each code point
        full = offsets[:-1][np.diff(offsets) > 0]
        cuts = at[boundaries(points, np.searchsorted(at, full))]
        ends = np.append(cuts, len(data)).tolist()
        slices = [held[a:b] for a, b in zip(ends, ends[1:])]
        known = self.known
        for piece in set(slices).difference(known):
            known[piece] = np.array(merge(piece, self.rank), self.kind).tobytes()
        return [known[x] for x in slices], cuts, np.searchsorted(cuts, offsets)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def encoder(vocabulary: bytes) -> ByteEncoder:
    return per_process(("bytes", hash(vocabulary)), lambda: ByteEncoder(vocabulary))


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids, and for every slice its first byte and first id (``slice_bytes``,
    ``slice_ids``); all three little-endian unsigned 32-bit."""
    data = file_bytes(vocabulary)

    def encoded(batches):
        held = encoder(data)
        for batch in batches:
            for part in pieces(batch):
                texts, offsets = utf8(part.column("text"))
                found, cuts, firsts = held.encode(texts, offsets)
                width = held.kind.itemsize
                size = np.array([len(x) for x in found], np.int64) // width
                before = np.concatenate([[0], np.cumsum(size)])
                ids = np.frombuffer(b"".join(found), held.kind).astype("<u4")
                out: tuple[list, list, list] = ([], [], [])
                for a, b, byte in zip(firsts, firsts[1:], offsets):
                    out[0].append(ids[before[a]:before[b]].tobytes())
                    out[1].append((cuts[a:b] - byte).astype("<u4").tobytes())
                    out[2].append((before[a:b] - before[a]).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(before[firsts])),
                     *(pa.array(x, pa.binary()) for x in out)],
                    names=["doc_id", "n_tokens", "ids", "slice_bytes", "slice_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, n_tokens long, ids binary, slice_bytes binary, "
                                    "slice_ids binary")


def decode(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``rows`` with doc_id, n_tokens and ids, and the bytes that the ids stand for."""
    data = file_bytes(vocabulary)

    def decoded(batches):
        held = encoder(data)
        for batch in batches:
            texts = [held.decode(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(
        decoded, "doc_id long, n_tokens long, ids binary, decoded binary")


def decode_bytes(ids: np.ndarray, slice_bytes: np.ndarray, slice_ids: np.ndarray,
                 start: int, end: int, held: ByteEncoder) -> bytes:
    """Bytes ``start`` to ``end`` of one text, from the slices that cover them."""
    if start >= end or not len(slice_bytes):
        return b""
    a = int(np.searchsorted(slice_bytes, start, "right")) - 1
    b = int(np.searchsorted(slice_bytes, end, "left"))
    last = int(slice_ids[b]) if b < len(slice_ids) else len(ids)
    base = int(slice_bytes[a])
    return held.decode(ids[int(slice_ids[a]):last])[start - base:end - base]
