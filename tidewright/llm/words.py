"""Words of many texts at once, as 64-bit numbers, by numpy over the bytes of an Arrow batch.

A word is a run of bytes other than blank and U+0009 to U+000D; A-Z count as a-z. Its number is
a polynomial over random 64-bit values of its bytes, mixed; two different words of one corpus
share a number with a probability of about one in 2^64 per pair.
"""
from __future__ import annotations

import numpy as np

from .common import BLANKS, per_process

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _tables():
    value = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64, endpoint=True)
    value[65:91] = value[97:123]
    blank = np.zeros(256, bool)
    blank[list(BLANKS.encode())] = True
    value[blank] = 0
    return value, blank


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number on every bit of the result, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept by the process and lengthened by need."""
    held = per_process(("powers",), lambda: [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(held[0]) < count:
        for at, base in ((0, _BASE), (1, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(count, 2 * len(held[at])), base, np.uint64)
            steps[0] = 1
            held[at] = np.multiply.accumulate(steps)
    return held[0], held[1]


def words(data: np.ndarray, offsets: np.ndarray):
    """Word numbers, first byte, end byte, and text of each word; all in page order."""
    value, blank = _tables()
    count = len(data)
    if not count:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none
    inside = ~blank[data]
    cuts = np.zeros(count + 1, bool)
    cuts[offsets] = True  # a word ends with its text
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cuts[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cuts[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = _powers(count)
    sums = np.empty(count + 1, np.uint64)
    sums[0] = 0
    np.cumsum(value[data] * power[:count], out=sums[1:])
    number = mix((sums[ends] - sums[starts]) * inverse[starts])
    text = np.searchsorted(offsets, starts, "right") - 1
    return number, starts, ends, text


def shingles(number: np.ndarray, text: np.ndarray, texts: int, size: int = 5):
    """Distinct shingles of each text as sorted numbers, and the texts' offsets into them.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    counts = np.bincount(text, minlength=texts).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    taken = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(texts), taken)
    at = np.repeat(first - (np.cumsum(taken) - taken), taken) + np.arange(len(owner))
    end = (first + counts)[owner]
    value = np.zeros(len(at), np.uint64)
    padded = np.concatenate([number, np.zeros(size, np.uint64)])
    for step in range(size):
        here = padded[at + step]
        if step:  # a short text's sequence ends early
            here = np.where(at + step < end, here, np.uint64(0x2545F4914F6CDD1D))
        value = value * np.uint64(0x100000001B3) + here
        value = mix(value)
    cuts = np.concatenate([[0], np.cumsum(taken)])
    sort_each(value, cuts)
    fresh = new_in_each(value, cuts)
    return value[fresh], np.concatenate(
        [[0], np.cumsum(np.bincount(owner[fresh], minlength=texts))]).astype(np.int64)


def sort_each(value: np.ndarray, cuts: np.ndarray) -> None:
    """Sorts each text's part in place."""
    ends = cuts.tolist()
    for a, b in zip(ends, ends[1:]):
        if b - a > 1:
            value[a:b].sort()


def new_in_each(value: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where a sorted part has a number for the first time."""
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    fresh[cuts[:-1][cuts[:-1] < len(value)]] = True
    return fresh
