"""Best-fit packing with a bounded number of open bins (operator 9).

Each document is encoded and ended by one id; what is longer than a sequence is cut into full
pieces and a rest. A full piece is a sequence by itself. A rest goes into the open bin with the
least room that still holds it, found in a bitset keyed by free space. At most ``OPEN`` bins are
open; when one more is needed the fullest closes first.

Each task packs the rows of its own split as they come, so nothing is shuffled, memory is
bounded, and a task that runs again packs alike. Bins left open at the end of a split are closed,
which costs a fraction of a sequence per split.

Edge cases: null and empty texts are the ending id alone; a null doc_id is carried along;
repeated rows are packed as often as they occur; an empty table gives no pieces; other columns
are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import wordbpe
from .common import file_bytes, pieces

LENGTH = 2048
OPEN = 1024
PIECES = ("doc_id long, piece int, start long, length long, ids binary, sequence_id long, "
          "offset long")
_SEQUENCES = 40  # bits for the sequences of one split


class BestFit:
    """Open bins by free space; ``room`` has bit f set if a bin with f free places is open."""

    def __init__(self, length: int = LENGTH, most_open: int = OPEN):
        self.length, self.most_open = length, most_open
        self.room, self.open, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        held = self.bins[free]
        number = held.pop()
        if not held:
            self.room &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """Number of the bin and the place in it for a piece of ``size``."""
        fits = self.room >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.made, self.length
            self.made += 1
        left = free - size
        if left:
            if self.open == self.most_open:  # the fullest closes
                fullest = (self.room & -self.room).bit_length() - 1
                if left <= fullest:
                    return number, self.length - free
                self._take(fullest)
            self.bins[left].append(number)
            self.room |= 1 << left
            self.open += 1
        return number, self.length - free


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = LENGTH,
         most_open: int = OPEN, most_pieces: int = 1_000_000) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit) and where each is packed.

    A worker holds the ids of at most about ``most_pieces`` words that are not plain; fewer cost time,
    not memory.
    """
    data = file_bytes(vocabulary)

    def packed(batches):
        encoder = wordbpe.encoder(data, most_pieces)
        bins = BestFit(length, most_open)
        first = TaskContext.get().partitionId() << _SEQUENCES
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for part in pieces(batch):
                out: list[list] = [[] for _ in range(7)]
                texts = part.column("text").fill_null("").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts)):
                    held = np.frombuffer(ids + end, encoder.kind).astype("<u4").tobytes()
                    total = len(held) // 4
                    for piece, start in enumerate(range(0, total, length)):
                        size = min(length, total - start)
                        number, place = bins.place(size)
                        for column, value in zip(out, (
                                doc_id, piece, start, size, held[4 * start:4 * (start + size)],
                                first + number, place)):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(),
                         pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(out, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(packed, PIECES)
