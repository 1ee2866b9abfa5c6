"""A quality classifier over document statistics (operator 4).

``statistics`` turns a whole text into numbers about its letters, symbols, words and lines.
Random Fourier features of the standardised statistics stand in for a Gaussian kernel. Ridge
scores come from normal equations that each partition sums for itself and Spark adds up cell by
cell; the driver solves a system of ``FEATURES`` + statistics + 1 unknowns. Isotonic regression
over counts by score class, from labelled rows the ridge has not seen, turns scores into
probabilities; a thousandth of a logistic curve keeps the order inside its steps.

The fit uses at most ``MOST_LABELLED`` labelled rows, those with the smallest hash of doc_id;
their ids are broadcast (under 1 MB), so texts are not shuffled. Scoring has no state but the
model and no shuffle.

Edge cases: null and empty texts have statistics of 0 and are scored; labels without a value or
a doc_id are ignored, repeated ones count as often as they occur; without labels of both kinds
every score is the share of label 1 (0.5 without labels); repeated documents get equal scores;
other columns are carried along, one named ``score`` is replaced.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import written
from . import words
from .common import pieces, utf8

MOST_LABELLED = 20_000
FEATURES = 256
WIDTH = 0.3  # standard deviation of the frequencies, one over the kernel's width
RIDGE = 1e-6
CLASSES = 1000  # of raw scores from LOW to HIGH, for the calibration
LOW, HIGH = -0.5, 1.5
FOLDS = 5  # fold 0 is held out, fold 1 calibrates, the others fit

# Character classes of UTF-8 bytes: 0 symbols, 4 trailing bytes, 5 first bytes of non-ASCII.
_KINDS = 13


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.int64)
    kind[97:123], kind[65:91], kind[48:58], kind[128:192], kind[192:] = 1, 2, 3, 4, 5
    for number, chars in ((6, b" \t\x0b\x0c\r"), (7, b"\n"), (8, b".?"), (9, b",;:"),
                          (10, b"'\"-()"), (11, b"!"), (12, b"|")):
        kind[list(chars)] = number
    return kind


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers per text; all are shares, means or logarithms."""
    texts, kind = len(offsets) - 1, _kinds()
    owner = np.repeat(np.arange(texts, dtype=np.int64) * _KINDS, np.diff(offsets))
    count = np.bincount(owner + kind[data], minlength=texts * _KINDS)
    count = count.reshape(texts, _KINDS).astype(float)
    number, starts, ends, text = words.words(data, offsets)
    n_words = np.bincount(text, minlength=texts).astype(float)
    length = (ends - starts).astype(float)
    per_word = np.maximum(n_words, 1)
    mean = np.bincount(text, length, texts) / per_word
    spread = np.sqrt(np.maximum(np.bincount(text, length ** 2, texts) / per_word - mean ** 2, 0))
    cuts = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)
    words.sort_each(number, cuts)
    new = words.new_in_each(number, cuts)
    distinct = np.bincount(text[new], minlength=texts).astype(float)
    at = np.flatnonzero(new)
    most, longest = np.zeros(texts), np.zeros(texts)
    if len(at):
        np.maximum.at(most, text[at], np.diff(np.append(at, len(number))))
        np.maximum.at(longest, text, length)
    last = kind[data[ends - 1]] if len(ends) else np.empty(0, np.int64)
    marked = np.bincount(text, (last == 0) | (last == 11), texts)
    short = np.bincount(text, length <= 3, texts)
    chars = count.sum(axis=1) - count[:, 4]
    letters = count[:, 1] + count[:, 2] + count[:, 5]
    per_char = np.maximum(chars, 1)
    return np.stack([
        np.log1p(chars), np.log1p(n_words), mean, spread, np.log1p(longest), letters / per_char,
        count[:, 2] / np.maximum(letters, 1), *(count[:, k] / per_char for k in (0, 3, 5)),
        *(count[:, k] / per_word for k in (7, 8, 9, 10, 11, 12)), distinct / per_word,
        distinct / np.sqrt(per_word), most / per_word, marked / per_word, short / per_word], axis=1)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    at: np.ndarray  # raw scores and
    value: np.ndarray  # their probabilities

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        wave = np.cos(z @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([wave, z / 10, np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        curve = 1 / (1 + np.exp(-np.clip(4 * raw - 2, -30, 30)))
        return 0.999 * np.interp(raw, self.at, self.value) + 0.001 * curve


def fold(doc_id):
    """crc32 of the doc_id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(FOLDS))


def _labelled(batches):
    for batch in batches:
        for part in pieces(batch):
            stats = statistics(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("fold"), part.column("label"),
                 pa.array(list(stats), pa.list_(pa.float64()))], names=["fold", "label", "stats"])


def _stacked(batch) -> np.ndarray:
    held = batch.column("stats")
    return held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)


def _sums(model: Model):
    """Normal equations of a partition: the sum for each pair of features, and with the label."""
    def add(batches):
        total = 0
        for batch in batches:
            x = model.features(_stacked(batch))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            total = total + x.T @ np.concatenate([x, y[:, None]], axis=1)
        if isinstance(total, np.ndarray):
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())],
                names=["i", "j", "v"])
    return add


def _classes(model: Model):
    def count(batches):
        for batch in batches:
            at = (model.raw(_stacked(batch)) - LOW) / (HIGH - LOW) * CLASSES
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.clip(at, 0, CLASSES - 1).astype(np.int64)), batch.column("label")],
                names=["c", "label"])
    return count


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence, by pooling neighbours that violate the order."""
    pools: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist()):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, n = pools.pop()
            held = pools[-1]
            held[0] = (held[0] * held[1] + v * w) / (held[1] + w)
            held[1] += w
            held[2] += n
    return np.concatenate([np.full(n, v) for v, _, n in pools]) if pools else np.empty(0)


def constant(share: float, columns: int) -> Model:
    return Model(np.zeros(columns), np.ones(columns), np.zeros((columns, 1)), np.zeros(1),
                 np.zeros(columns + 2), np.array([0.0]), np.array([share]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        most: int = MOST_LABELLED, seed: int = 4) -> Model:
    """Fits on labelled rows of folds 1 to 4."""
    columns = statistics(np.empty(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    known = (labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("double").alias("label"))
             .where("l_id IS NOT NULL AND label IS NOT NULL")
             .withColumn("fold", fold(F.col("l_id"))).where("fold > 0")
             .orderBy(F.xxhash64("l_id"), "l_id", "label").limit(most))
    rows = docs.select(F.col("doc_id").alias("d_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(known), F.col("d_id") == F.col("l_id")).select("fold", "label", "text")
    held = written(rows.mapInArrow(_labelled, "fold long, label double, stats array<double>"),
                   "quality-labelled")
    moments = held.select(
        F.avg("label"), F.count(F.lit(1)),
        *(f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(columns))).first()
    share, total = moments[0], moments[1]
    if not total or share in (0.0, 1.0):
        return constant(0.5 if not total else share, columns)
    mean = np.array(moments[2:2 + columns])
    scale = np.array(moments[2 + columns:]) + 1e-9
    draw = np.random.default_rng(seed)
    model = Model(mean, scale, draw.normal(size=(columns, FEATURES)) * WIDTH,
                  draw.uniform(0, 2 * np.pi, FEATURES), np.empty(0), np.empty(0), np.empty(0))
    cells = (held.where("fold > 1").mapInArrow(_sums(model), "i long, j long, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow())
    size = FEATURES + columns + 1
    if not cells.num_rows:
        return constant(share, columns)
    sums = np.zeros((size, size + 1))
    sums[cells.column("i").to_numpy(), cells.column("j").to_numpy()] = cells.column("v").to_numpy()
    weight = np.linalg.solve(sums[:, :-1] + RIDGE * sums[-1, -2] * np.eye(size), sums[:, -1])
    model = model._replace(weight=weight)
    counts = (held.where("fold = 1").mapInArrow(_classes(model), "c long, label double")
              .groupBy("c").agg(F.avg("label"), F.count(F.lit(1))).orderBy("c").collect())
    if not counts:
        return constant(share, columns)
    c, mean_label, n = (np.array(x, float) for x in zip(*counts))
    return model._replace(at=LOW + (c + 0.5) / CLASSES * (HIGH - LOW),
                          value=isotonic(mean_label, n))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``score``, the probability of label 1."""
    kept = docs.select(*[docs[f"`{n}`"] for n in docs.columns if n.lower() != "score"])

    def scored(batches):
        for batch in batches:
            for part in pieces(batch):
                found = model.score(statistics(*utf8(part.column("text"))))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found)], names=[*part.schema.names, "score"])

    return kept.mapInArrow(scored, T.StructType([*kept.schema, T.StructField("score", T.DoubleType())]))
