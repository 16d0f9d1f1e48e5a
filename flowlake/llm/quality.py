"""Quality classifier: ordinal regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import Words, byte_hashes, mixed, stored, text_slices

# Hashed features: words, their beginnings and shapes, and words that repeat the
# one before.
BUCKETS = 1 << 22

# Letters of the beginnings of longer words.  Compounds too rare to tell anything
# one by one tell it together.
BEGINNINGS = (4, 6)

# Rated documents the model is fitted on at most; those of the smallest hashes
# of doc_id if there are more.
SAMPLE_ROWS = 10_000

# A feature has a weight if it is in this many rated documents, and if its share
# of those above some grade differs from its share of the others by this many
# standard errors.  Others tell grades apart by chance only.
LEAST_DOCS = 5
LEAST_GAP = 4.0

# A document is kept if its chance of the best grade is at least this.
CUTOFF = 0.6

# How bytes count: letters A-Z without case in words; by class in shapes.
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CLASS = np.arange(256)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = ord("X"), ord("x"), ord("x"), ord("9")
_REPEAT = 1


def hashed_features(
    texts: pa.Array, known: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of each feature of each text, sorted by row and feature.

    A word gives its hash, those of its ``BEGINNINGS`` if it is longer, that of its
    shape (capitals, other letters, digits and marks, each run as one), and whether
    it repeats the word before.  ``known`` marks the features wanted."""
    words = Words(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(words.starts))
    lower = _LOWER.astype(np.uint8)[words.data]
    plain = byte_hashes(lower, words.begin, words.end)
    kinds = _CLASS[words.data]
    run = np.append(True, kinds[1:] != kinds[:-1])[: len(kinds)]
    run[words.begin] = True
    place = np.append(0, np.cumsum(run))
    # Told apart from words spelled like a shape.
    shapes = mixed(~byte_hashes(kinds[run].astype(np.uint8), place[words.begin], place[words.end]))
    begun = [_beginnings(words, lower, letters) for letters in BEGINNINGS]
    again = np.flatnonzero((plain[1:] == plain[:-1]) & (row[1:] == row[:-1])) + 1
    feature = np.concatenate(
        [
            (plain % np.uint64(BUCKETS)).astype(np.int64),
            (shapes % np.uint64(BUCKETS)).astype(np.int64),
            *[(hashes % np.uint64(BUCKETS)).astype(np.int64) for _, hashes in begun],
            np.full(len(again), _REPEAT),
        ]
    )
    row = np.concatenate([row, row, *[row[at] for at, _ in begun], row[again]])
    if known is not None:
        wanted = known[feature]
        row, feature = row[wanted], feature[wanted]
    found, counts = np.unique(row * BUCKETS + feature, return_counts=True)
    return found // BUCKETS, found % BUCKETS, counts


def _beginnings(words: Words, lower: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash of its first ``letters``) of each word of more letters."""
    lead = np.flatnonzero((words.data & 0xC0) != 0x80)  # first bytes of UTF-8 letters
    first, last = np.searchsorted(lead, words.begin), np.searchsorted(lead, words.end)
    at = np.flatnonzero(last - first > letters)
    # Told apart from words of as many letters, and other beginnings.
    return at, mixed(byte_hashes(lower, words.begin[at], lead[first[at] + letters]) ^ np.uint64(letters))


@dataclass
class OrdinalModel:
    """One weight per feature, shared by all grades, and a rising threshold
    between each grade and the next: P(grade <= k) = sigmoid(threshold k - score)."""

    features: np.ndarray
    rarity: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def known(self) -> np.ndarray:
        marks = np.zeros(BUCKETS, bool)
        marks[self.features] = True
        return marks

    def scores(self, texts: pa.Array, known: np.ndarray) -> np.ndarray:
        at, value, row = self.values(len(texts), *hashed_features(texts, known))
        return np.bincount(row, self.weights[at] * value, len(texts)).astype(np.float64)

    def values(self, n: int, row: np.ndarray, feature: np.ndarray, count: np.ndarray):
        """(feature's place, value, row): damped counts by rarity, over the root of
        a row's length, so that long texts neither drown a word nor add up noise."""
        at = np.searchsorted(self.features, feature)
        value = np.log1p(count) * self.rarity[at]
        length = np.sqrt(np.bincount(row, value * value, n))
        return at, value / np.sqrt(np.maximum(length, 1e-12))[row], row

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """Chance of more than grade k, one column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def fit_ordinal(
    grades: np.ndarray,
    row: np.ndarray,
    feature: np.ndarray,
    count: np.ndarray,
    rounds: int = 400,
    rate: float = 0.05,
    decay: float = 1e-4,
) -> OrdinalModel:
    """Cumulative-link fit by gradient descent (Adam) over all given rows.

    Thresholds stay ordered, as the first plus positive gaps.
    """
    n, levels = len(grades), int(grades.max()) + 1
    features, docs = np.unique(feature, return_counts=True)
    shares = np.array([(grades <= k).mean() for k in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    first = np.log(shares / (1 - shares))
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    model = OrdinalModel(features, np.log((1 + n) / docs), np.zeros(len(features)), first)
    at, value, row = model.values(n, row, feature, count)
    theta = np.concatenate([model.weights, first[:1], gaps])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    below, above = np.maximum(grades - 1, 0), np.minimum(grades, levels - 2)
    for step in range(1, rounds + 1):
        w, low, gaps = np.split(theta, [len(features), len(features) + 1])
        limits = np.concatenate([low, low + np.cumsum(np.exp(gaps))])
        score = np.bincount(row, w[at] * value, n)
        chance = 1 / (1 + np.exp(np.clip(score[:, None] - limits[None, :], -60, 60)))
        upper = np.where(grades < levels - 1, chance[np.arange(n), above], 1.0)
        lower = np.where(grades > 0, chance[np.arange(n), below], 0.0)
        inside = np.maximum(upper - lower, 1e-12)
        slope = (1 - upper - lower) / n
        by_limit = np.bincount(below, lower * (1 - lower) / inside / n, levels - 1)
        by_limit -= np.bincount(above, upper * (1 - upper) / inside / n, levels - 1)
        after = np.cumsum(by_limit[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(at, value * slope[row], len(features)) + decay * w,
                after[:1],
                after[1:] * np.exp(gaps),
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    model.weights, low, gaps = np.split(theta, [len(features), len(features) + 1])
    model.thresholds = np.concatenate([low, low + np.cumsum(np.exp(gaps))])
    return model


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        row, feature, count = hashed_features(texts)
        # Feature -1 stands for the document itself.
        row = np.append(row, np.arange(len(texts)))
        feature = np.append(feature, np.full(len(texts), -1))
        count = np.append(count, np.ones(len(texts), np.int64))
        yield pa.record_batch(
            [
                batch.column("doc_id").take(pa.array(row)),
                batch.column("grade").take(pa.array(row)),
                pa.array(feature, pa.int32()),
                pa.array(count, pa.int32()),
            ],
            names=["doc_id", "grade", "feature", "n"],
        )


def train_quality(
    docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS, **fit
) -> OrdinalModel | None:
    """Fit on the rated rows of ``docs`` (doc_id, text).

    ``ratings`` has (doc_id, grade), grades counting from 0; of several ratings
    of a document the lowest holds; null ids and grades are ignored.  At most
    ``sample_rows`` ratings are used, so what reaches the driver, their features,
    is bounded.  No model where fewer than two grades occur.
    """
    sample = (
        ratings.select(F.col("doc_id").cast("long"), F.col("grade").cast("int"))
        .where("doc_id IS NOT NULL AND grade IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = stored(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .join(F.broadcast(sample), "doc_id")  # at most sample_rows ids
        .mapInArrow(_sampled, "doc_id long, grade int, feature int, n int"),
        "features",
    )
    # A rated document without any word counts as well.
    rated = {row.grade: row.n for row in rows.where("feature < 0").groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(rated) < 2:
        return None
    chosen = _telling(rows, rated)
    wanted = docs.sparkSession.createDataFrame([(f,) for f in chosen + [-1]], "feature int")
    table = rows.join(F.broadcast(wanted), "feature").toArrow().sort_by([("doc_id", "ascending"), ("feature", "ascending")])
    doc, feature, count = (table.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "feature", "n"))
    _, first, row = np.unique(doc, return_index=True, return_inverse=True)
    grade = table.column("grade").to_numpy()[first].astype(np.int64)
    real = feature >= 0
    return fit_ordinal(grade, row[real], feature[real], count[real], **fit)


def _telling(rows: DataFrame, rated: dict[int, int]) -> list[int]:
    """Features that tell grades apart; at most as many as the sample has rows of
    them, over ``LEAST_DOCS``."""
    grades = sorted(rated)
    counts = (
        rows.where("feature >= 0")
        .groupBy("feature")
        .agg(*[F.count_if(F.col("grade") == g).alias(f"g{g}") for g in grades])
        .where(sum((F.col(f"g{g}") for g in grades), F.lit(0)) >= LEAST_DOCS)
        .toArrow()
    )
    table = np.stack([counts.column(f"g{g}").to_numpy() for g in grades])
    sizes = np.array([rated[g] for g in grades], np.float64)
    share = table.sum(axis=0) / sizes.sum()
    gap = np.zeros(table.shape[1])
    for k in range(1, len(grades)):
        low, high = sizes[:k].sum(), sizes[k:].sum()
        error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / low + 1 / high))
        gap = np.maximum(gap, np.abs(table[:k].sum(axis=0) / low - table[k:].sum(axis=0) / high) / error)
    return counts.column("feature").to_numpy()[gap >= LEAST_GAP].tolist()


def _graded(model: OrdinalModel | None, cutoff: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.known() if model else None
        for batch, texts in text_slices(batches, "text"):
            n = len(texts)
            if model:
                scores = model.scores(texts, known)
                tails = model.tails(scores)
                columns = [scores, tails.sum(axis=1), tails[:, -1], tails[:, -1] >= cutoff]
                columns = [pa.array(c) for c in columns]
            else:
                columns = [pa.nulls(n, pa.float64())] * 3 + [pa.array(np.ones(n, bool))]
            yield pa.record_batch(
                [batch.column(c) for c in batch.schema.names] + columns,
                names=[*batch.schema.names, "score", "expected_grade", "tail", "kept"],
            )

    return run


def grade_documents(docs: DataFrame, model: OrdinalModel | None, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, score, expected_grade, tail, kept) per row of ``docs`` (doc_id, text).

    ``tail`` is the chance of the best grade, ``kept`` whether it reaches
    ``cutoff``.  Texts are read whole; the weights are a bounded table.  A null or
    empty text, or one without a known feature, has score 0 and the chances of
    that.  Without a model all is kept, with null figures.  Rows that repeat are
    graded as often, a null doc_id is returned as such.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _graded(model, cutoff),
        "doc_id long, text string, score double, expected_grade double, tail double, kept boolean",
    ).drop("text")


def select_documents(docs: DataFrame, model: OrdinalModel | None, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with the columns of ``docs``."""
    inner = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.known() if model else None
        for batch, texts in text_slices(batches, "text"):
            if model:
                tails = model.tails(model.scores(texts, known))
                batch = batch.filter(pa.array(tails[:, -1] >= cutoff))
            yield batch

    return inner.mapInArrow(run, inner.schema)
