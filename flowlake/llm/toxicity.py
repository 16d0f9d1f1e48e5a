"""Toxic passages: maximum-scoring segments of token log-odds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import byte_hashes, mixed, stored, text_slices

# Ratings the model is fitted on at most; those of the smallest hashes of doc_id if
# there are more.  Everything that reaches the driver is bounded by their tokens.
SAMPLE_ROWS = 20_000

# Letters of the beginnings of longer words, which words too rare to tell anything
# one by one have in common.
BEGINNINGS = (4, 6)

LEAST_DOCS = 4  # rated texts that hold a token
PRIOR = 4.0  # texts the prior of a token counts as
SURE = 3.0  # standard errors a log-odds is moved towards none
CLIP = 4.0  # largest score of a token
DRIFT = 0.1  # what every token costs: passages end where nothing supports them
FOLDS = 4
CHANCE = 0.05  # expected passages of a clean text, below which one is significant

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True

PASSAGES = "array<struct<begin:int,end:int,score:double,chance:double>>"


class Tokens:
    """Words of a slice of texts: runs of letters, A-Z and accented Latin capitals
    without case, each with its hash and those of its beginnings."""

    def __init__(self, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        raw = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        data = _LOWER[raw]
        after = np.append(False, raw[:-1] == 0xC3)[: len(raw)]
        data[after & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)] += 32
        solid = _LETTER[raw]
        inner = offsets[(offsets > 0) & (offsets < len(raw))]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        first[inner] = solid[inner]
        last[:-1] &= ~solid[1:]
        last[inner - 1] = solid[inner - 1]
        self.begin, self.end, self.offsets = np.flatnonzero(first), np.flatnonzero(last) + 1, offsets
        self.starts = np.searchsorted(self.begin, offsets)
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.starts))
        self.lead = (raw & 0xC0) != 0x80  # first bytes of characters
        lead = np.flatnonzero(self.lead)
        low, high = np.searchsorted(lead, self.begin), np.searchsorted(lead, self.end)
        # From the shortest beginning to the whole word; 0 where the word is no longer.
        self.levels = []
        for letters in BEGINNINGS:
            at = np.flatnonzero(high - low > letters)
            found = np.zeros(len(low), np.uint64)
            found[at] = mixed(byte_hashes(data, self.begin[at], lead[low[at] + letters]) ^ np.uint64(letters))
            self.levels.append(found)
        self.levels.append(byte_hashes(data, self.begin, self.end))

    def characters(self, byte: np.ndarray, row: int) -> np.ndarray:
        """Places of bytes in a text as numbers of characters."""
        start = self.offsets[row]
        return np.cumsum(np.append(0, self.lead[start : self.offsets[row + 1]]))[byte - start]

    def signatures(self) -> np.ndarray:
        """The two smallest word hashes of each text, as one number: mostly the same
        for near copies."""
        order = np.lexsort((self.levels[-1], self.row))
        words, row = self.levels[-1][order], self.row[order]
        new = np.append(True, (words[1:] != words[:-1]) | (row[1:] != row[:-1]))[: len(words)]
        words, row = words[new], row[new]
        starts = np.searchsorted(row, np.arange(len(self.starts)))
        found = np.zeros(len(self.starts) - 1, np.uint64)
        for nth in (0, 1):
            has = starts[:-1] + nth < starts[1:]
            found[has] = mixed(found[has] ^ words[starts[:-1][has] + nth])
        return found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches, "text"):
        prints = Tokens(texts).signatures()
        yield pa.record_batch(
            [batch.column("toxic"), pa.array(prints.view(np.int64)), texts.cast(pa.string())],
            names=["toxic", "sig", "text"],
        )


def _isin(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _token_counts(level: int, known: list[np.ndarray]):
    """Texts that hold a token of a level, with its beginning, by class (twice the
    fold, plus one if toxic).

    A beginning stands for words that are not ``known``, themselves or by a longer
    beginning: a common word tells nothing of others that begin like it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            x = Tokens(texts)
            has = x.levels[level] != 0
            for longer, hashes in zip(known, x.levels[level + 1 :]):
                has &= ~_isin(longer, hashes)
            parent = np.zeros(len(x.row), np.uint64)
            for hashes in x.levels[:level]:
                parent = np.where(hashes != 0, hashes, parent)
            token, row, parent = x.levels[level][has], x.row[has], parent[has]
            order = np.lexsort((row, token))
            token, row, parent = token[order], row[order], parent[order]
            new = np.append(True, (token[1:] != token[:-1]) | (row[1:] != row[:-1]))[: len(token)]
            kind = batch.column("kind").to_numpy().astype(np.int32)[row[new]]
            columns = [token[new].view(np.int64), parent[new].view(np.int64), kind]
            yield pa.record_batch([pa.array(c) for c in columns], names=["token", "parent", "kind"])

    return run


def _known_tokens(rated: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, their beginnings, texts that hold them by class), sorted by token."""
    kinds = [f"k{k}" for k in range(2 * FOLDS)]
    known: list[np.ndarray] = []
    found = []
    for level in range(len(BEGINNINGS), -1, -1):
        counts = (
            rated.mapInArrow(_token_counts(level, known), "token long, parent long, kind int")
            .groupBy("token")
            .agg(F.min("parent").alias("parent"), *[F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(2 * FOLDS)])
            .where(sum((F.col(k) for k in kinds), F.lit(0)) >= LEAST_DOCS)
            .toArrow()
        )
        tokens, parents = (counts.column(c).to_numpy().view(np.uint64) for c in ("token", "parent"))
        found.append((tokens, parents, np.stack([counts.column(k).to_numpy() for k in kinds])))
        known.insert(0, np.sort(tokens))
    tokens, parents = (np.concatenate([part[i] for part in found]) for i in (0, 1))
    order = np.argsort(tokens)
    return tokens[order], parents[order], np.concatenate([part[2] for part in found], axis=1)[:, order]


@dataclass
class TokenScores:
    """Scores of tokens, by ascending hash."""

    tokens: np.ndarray
    scores: np.ndarray

    def of(self, x: Tokens) -> np.ndarray:
        """Score of each word: its own, or that of its longest known beginning."""
        found = np.zeros(len(x.row))
        for hashes in x.levels:
            known = _isin(self.tokens, hashes)
            found[known] = self.scores[np.searchsorted(self.tokens, hashes[known])]
        return found - DRIFT


def token_scores(
    tokens: np.ndarray, parents: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int
) -> TokenScores:
    """Log-odds of tokens held by ``toxic`` and ``clean`` texts of so many.

    The split of a token between toxic and clean texts has a Dirichlet prior of
    weight PRIOR, centred at the split of its beginning, and that of the shortest
    beginning at the split of all texts.  The log-odds against all texts loses SURE
    standard errors.  ``tokens`` are sorted; a parent comes from among them or is 0.
    """
    if not (n_toxic and n_clean and len(tokens)):
        return TokenScores(np.zeros(0, np.uint64), np.zeros(0))
    base = n_toxic / (n_toxic + n_clean)
    at = np.minimum(np.searchsorted(tokens, parents), len(tokens) - 1)
    has = (parents != 0) & (tokens[at] == parents)
    share = np.full(len(tokens), base)
    for _ in range(len(BEGINNINGS) + 1):  # once per level: parents first
        centre = np.where(has, share[at], base)
        share = (toxic + PRIOR * centre) / (toxic + clean + PRIOR)
    share = np.clip(share, 1e-6, 1 - 1e-6)
    odds = np.log(share / (1 - share)) - math.log(base / (1 - base))
    weight = toxic + clean + PRIOR
    error = np.sqrt(1 / (weight * share) + 1 / (weight * (1 - share)))
    scores = np.sign(odds) * np.clip(np.abs(odds) - SURE * error, 0, CLIP)
    return TokenScores(tokens, scores)


def maximal_segments(before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """All maximal segments of a sequence, in linear time: (first run, last run, score).

    ``before`` and ``after`` are the cumulative score before and after each run of
    positive tokens.  A segment is maximal if it scores more than any within it and
    none around it does.  Each open segment knows the nearest one to its left that
    starts lower, so looking for it never goes over the same ground twice.
    """
    held: list[tuple[float, float, int, int, int]] = []
    for run, (low, high) in enumerate(zip(before, after)):
        first, at = run, len(held) - 1
        while True:
            while at >= 0 and held[at][0] >= low:
                at = held[at][4]
            if at < 0 or held[at][1] >= high:
                held.append((low, high, first, run, at))
                break
            low, _, first, _, further = held[at]
            del held[at:]
            at = further
    return [(first, last, high - low) for low, high, first, last, _ in held]


def _segments(x: Tokens, scores: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(text, [(first word, last word, score)]) of each text with a positive word."""
    total = np.append(0.0, np.cumsum(scores))
    good = scores > 0
    # Runs of positive words, which end with a text.
    begins, ends = good.copy(), good.copy()
    same = x.row[1:] == x.row[:-1]
    begins[1:] &= ~(good[:-1] & same)
    ends[:-1] &= ~(good[1:] & same)
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    cuts = np.append(np.flatnonzero(np.append(True, x.row[begin][1:] != x.row[begin][:-1])[: len(begin)]), len(begin))
    low, high = total[begin].tolist(), total[end + 1].tolist()
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        found = maximal_segments(low[a:b], high[a:b])
        yield int(x.row[begin[a]]), [(int(begin[a + i]), int(end[a + j]), s) for i, j, s in found]


@dataclass
class ToxicModel:
    """Token scores, the extreme-value law of clean texts, and the calibration.

    The best segment of a clean text of n words stays below s with probability
    exp(-k n exp(-decay s))."""

    scores: TokenScores
    decay: float
    k: float
    intercept: float
    slope: float

    def surprise(self, segments: list[float], n: int) -> float:
        """Minus the logarithm of the chance that a clean text of ``n`` words has
        segments that sum up to as much; the best over their number."""
        if not segments:
            return 0.0
        normal = self.decay * np.sort(np.array(segments))[::-1] - math.log(self.k * max(n, 1))
        total = np.cumsum(normal)
        r = np.arange(1, len(normal) + 1)
        factorials = np.cumsum(np.log(r))
        some = total > 0
        found = (
            total[some]
            - (r[some] - 1) * np.log(total[some])
            + factorials[some]
            + factorials[some]
            - np.log(r[some])
            - (r[some] - 1) * math.log(2)
        )
        return max(0.0, float(found.max())) if len(found) else 0.0

    def probability(self, surprise: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * np.log1p(surprise), -60, 60)))


def fit_extremes(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Likeliest (decay, k) for the best segments of clean texts of ``n`` words; 0
    stands for no segment.  One text with a segment of score 1 is added, so there is
    always one."""
    best, n = np.append(best, 1.0), np.append(np.maximum(n, 1), 1)
    some = best > 0
    found = (-np.inf, 1.0, 1.0)
    for decay in np.geomspace(0.05, 10, 200):
        tail = (n * np.exp(-decay * best)).sum()
        k = some.sum() / tail
        fit = some.sum() * (math.log(k) + math.log(decay)) + np.log(n[some]).sum() - decay * best[some].sum() - k * tail
        found = max(found, (fit, float(decay), float(k)))
    return found[1:]


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3) -> tuple[float, float]:
    """(intercept, slope) of the chance of ``y``, by Newton steps; the slope is not
    negative."""
    x1 = np.stack([np.ones(len(x)), x], axis=1)
    base = (y.sum() + 0.5) / (len(y) + 1)
    theta = np.array([math.log(base / (1 - base)), 0.0])
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(x1 @ theta, -30, 30)))
        gradient = x1.T @ (chance - y) + decay * theta
        hessian = (x1 * (chance * (1 - chance))[:, None]).T @ x1 + decay * np.eye(2) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        theta = theta - step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), max(0.0, float(theta[1]))


def _held_out_segments(models: list[TokenScores]):
    """Segments of rated texts by the model that has not seen their fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            x = Tokens(texts)
            kind = batch.column("kind").to_numpy()
            scores = np.zeros(len(x.row))
            for fold, model in enumerate(models):
                mine = (kind // 2 == fold)[x.row]
                if mine.any():
                    scores[mine] = model.of(x)[mine]
            segments: list[list[float]] = [[] for _ in range(len(texts))]
            for row, found in _segments(x, scores):
                segments[row] = [s for _, _, s in found]
            yield pa.record_batch(
                [
                    batch.column("kind"),
                    pa.array(np.diff(x.starts), pa.int64()),
                    pa.array(segments, pa.list_(pa.float64())),
                ],
                names=["kind", "n", "segments"],
            )

    return run


def train_toxicity(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicModel:
    """Fit on the rated rows of ``docs`` (doc_id, text).

    ``ratings`` has (doc_id, toxic); null ids and ratings are ignored, of several of
    a document the highest holds.  At most ``sample_rows`` are used; of near copies
    with the same rating only one.  Token scores come from all of them; the law of
    clean texts and the calibration from scores of texts left out of the fit.
    Without texts of both ratings all texts get one score, their smoothed share.
    """
    sample = (
        ratings.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated = (
        rows.join(F.broadcast(sample), "doc_id")  # at most sample_rows ids
        .select("toxic", "text")
        .mapInArrow(_rows, "toxic int, sig long, text string")
        .groupBy("toxic", "sig")
        .agg(F.min("text").alias("text"))
        .select((F.pmod("sig", F.lit(FOLDS)) * 2 + F.col("toxic")).cast("int").alias("kind"), "text")
    )
    rated = stored(rated, "rated")
    sizes = np.zeros(2 * FOLDS, np.int64)
    for row in rated.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[row.kind] = row.n
    tokens, parents, table = _known_tokens(rated)

    def without(fold: int | None) -> TokenScores:
        kept = [k for k in range(2 * FOLDS) if k // 2 != fold]
        clean, toxic = ([k for k in kept if k % 2 == side] for side in (0, 1))
        return token_scores(
            tokens, parents, table[toxic].sum(axis=0), table[clean].sum(axis=0), sizes[toxic].sum(), sizes[clean].sum()
        )

    model = ToxicModel(without(None), 1.0, 1.0, 0.0, 0.0)
    n_toxic, n_all = int(sizes[1::2].sum()), int(sizes.sum())
    share = (n_toxic + 0.5) / (n_all + 2)
    model.intercept = math.log(share / (1 - share))
    if not n_toxic or n_toxic == n_all:
        return model
    folds = [without(fold) for fold in range(FOLDS)]
    seen = rated.mapInArrow(_held_out_segments(folds), "kind int, n long, segments array<double>").toArrow()
    toxic = seen.column("kind").to_numpy() % 2
    n, segments = seen.column("n").to_numpy(), seen.column("segments").to_pylist()
    best = np.array([max(s, default=0.0) for s in segments])
    model.decay, model.k = fit_extremes(best[toxic == 0], n[toxic == 0])
    surprise = np.array([model.surprise(s, m) for s, m in zip(segments, n.tolist())])
    model.intercept, model.slope = fit_logistic(np.log1p(surprise), toxic)
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(doc_id, score, predicted, n_words, passages) per row of ``docs`` (doc_id, text).

    ``passages`` are the significant segments, in order: places in the text, counted
    in characters, score, and how many such a clean text of this length is expected
    to have.  ``score`` is the chance that the document is toxic, from all segments
    together; ``predicted`` is 1 from 0.5 on.  Texts are read whole.  A null or empty
    text has no passages and the score of that.  Rows that repeat are scored as
    often, null ids are returned as such, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            x = Tokens(texts)
            counts = np.diff(x.starts)
            surprise = np.zeros(len(texts))
            passages: list[list[dict]] = [[] for _ in range(len(texts))]
            for row, found in _segments(x, model.scores.of(x)):
                n = int(counts[row])
                surprise[row] = model.surprise([s for _, _, s in found], n)
                expected = [model.k * n * math.exp(-model.decay * s) for _, _, s in found]
                good = [i for i, e in enumerate(expected) if e <= CHANCE]
                if good:
                    begin = x.characters(x.begin[[found[i][0] for i in good]], row).tolist()
                    end = x.characters(x.end[[found[i][1] for i in good]], row).tolist()
                    passages[row] = [
                        {"begin": a, "end": b, "score": found[i][2], "chance": expected[i]}
                        for i, a, b in zip(good, begin, end)
                    ]
            chance = model.probability(surprise)
            kind = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(chance),
                    pa.array((chance >= 0.5).astype(np.int32)),
                    pa.array(counts, pa.int64()),
                    pa.array(passages, pa.list_(kind)),
                ],
                names=["doc_id", "score", "predicted", "n_words", "passages"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, score double, predicted int, n_words long, passages {PASSAGES}")
