"""Toxicity: segments against brute force, fits against numbers, held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from flowlake.llm import toxicity
from flowlake.llm.queries import op11_toxicity
from flowlake.llm.toxicity import (
    ToxicModel,
    Tokens,
    TokenScores,
    fit_extremes,
    fit_logistic,
    maximal_segments,
    score_toxicity,
    train_toxicity,
)


def by_recursion(scores, low, high):
    """The best segment, then those to its left and right."""
    best = max(
        ((sum(scores[i : j + 1]), i - j, i, j) for i in range(low, high) for j in range(i, high)),
        default=(0, 0, 0, 0),
    )
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return [*by_recursion(scores, low, i), (i, j), *by_recursion(scores, j + 1, high)]


def test_segments_like_recursion():
    dice = random.Random(1)
    for _ in range(300):
        scores = [round(dice.gauss(-0.2, 1), 6) for _ in range(dice.randint(0, 25))]
        total = np.append(0, np.cumsum(scores))
        positive = [i for i, s in enumerate(scores) if s > 0]
        found = maximal_segments([total[i] for i in positive], [total[i + 1] for i in positive])
        assert [(positive[a], positive[b]) for a, b, _ in found] == by_recursion(scores, 0, len(scores))
        for a, b, s in found:
            assert s == pytest.approx(sum(scores[positive[a] : positive[b] + 1]))


def test_segments_take_linear_time():
    """Falling starts, each to be passed over once."""
    n = 200_000
    low = [-2.0 * i for i in range(n)]
    high = [-2.0 * i + 1 for i in range(n)]
    assert len(maximal_segments(low, high)) == n
    rising = maximal_segments([0.5 * i for i in range(n)], [0.5 * i + 1 for i in range(n)])
    assert [(a, b) for a, b, _ in rising] == [(0, n - 1)]


def test_segments_stay_within_a_text():
    x = Tokens(pa.array(["Bad bad, fine", "", "bad", "fine Ärger ärger"], pa.large_string()))
    assert x.starts.tolist() == [0, 3, 3, 4, 7]
    whole = x.levels[-1]
    assert whole[0] == whole[1] == whole[3] and whole[5] == whole[6]
    model = TokenScores(np.sort(whole[[0]]), np.array([2.0]))
    found = dict(toxicity._segments(x, model.of(x)))
    assert {row: [(a, b) for a, b, _ in part] for row, part in found.items()} == {0: [(0, 1)], 2: [(3, 3)]}


def test_extremes_and_logistic_fit():
    dice = np.random.default_rng(5)
    decay, k, n = 1.7, 0.01, dice.integers(20, 2000, 40_000)
    # The best segment's law, turned round; below nothing there is no segment.
    best = np.maximum(0, (np.log(k * n) - np.log(-np.log(dice.random(len(n))))) / decay)
    got = fit_extremes(best, n)
    assert got[0] == pytest.approx(decay, rel=0.05) and got[1] == pytest.approx(k, rel=0.1)
    x = dice.normal(size=5000)
    y = (dice.random(5000) < 1 / (1 + np.exp(1 - 2 * x))).astype(int)
    a, b = fit_logistic(x, y)
    loss = lambda a, b: np.log1p(np.exp(-(2 * y - 1) * (a + b * x))).sum() + 0.5e-3 * (a * a + b * b)
    assert all(loss(a, b) <= loss(a + i, b + j) for i in (-1e-3, 0, 1e-3) for j in (-1e-3, 0, 1e-3))
    assert fit_logistic(x, 1 - y)[1] == 0.0


def test_token_scores_back_off():
    tokens = np.array([3, 5, 9], np.uint64)
    parents = np.array([0, 3, 0], np.uint64)
    got = toxicity.token_scores(tokens, parents, np.array([50, 4, 10]), np.array([2, 0, 90]), 100, 900).scores
    assert got[0] > 2 and got[1] > 0 and got[2] == 0
    lone = toxicity.token_scores(tokens, np.zeros(3, np.uint64), np.array([50, 4, 10]), np.array([2, 0, 90]), 100, 900)
    assert lone.scores[1] < got[1]
    assert len(toxicity.token_scores(tokens, parents, np.zeros(3), np.ones(3), 0, 5).tokens) == 0


def rated(prose, dice, n):
    rows, labels = [], []
    for i in range(n):
        words = prose(120).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(12):
                words[dice.randrange(40, 70)] = dice.choice(["Moron,", "idiot", "Écrasé!", "scumbag" + dice.choice("abcdefgh")])
        rows.append((i, " ".join(words), "x", 3))
        labels.append((i, int(toxic)))
    return rows, labels


SCHEMA = "doc_id long, text string, score string, predicted int"


def test_passages_are_found(spark, prose):
    dice = random.Random(4)
    rows, labels = rated(prose, dice, 240)
    docs = spark.createDataFrame(rows, SCHEMA)
    ratings = spark.createDataFrame(labels + [(None, 1), (3, None), (900, 1), (0, 0)], "doc_id long, toxic int")
    model = train_toxicity(docs, ratings.where("doc_id % 5 > 0 OR doc_id IS NULL"))
    odd = [(500, None, "", 1), (501, "", "", 1), (502, "!? 12", "", 1), (None, "idiot " * 40, "", 1), (503, "idiot", "", 1)]
    odd += [rows[0], rows[0], (504, prose(30_000) + " moron idiot " * 9 + prose(30_000), "", 1)]
    got = score_toxicity(spark.createDataFrame(rows[1:] + odd, SCHEMA), model).collect()
    assert len(got) == 239 + len(odd)
    texts = {i: t for i, t, *_ in rows} | {504: odd[-1][1]}
    wrong = sum(r.predicted != int(r.doc_id % 6 == 0) for r in got if r.doc_id is not None and r.doc_id < 500)
    assert wrong <= 2
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == 1 and by_id[504].predicted == 1
    for i in (500, 501, 502):
        assert by_id[i].predicted == 0 and by_id[i].passages == [] and 0 < by_id[i].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    bad = {"moron", "idiot", "écrasé"}
    for i in (0, 6, 504):
        cut = [texts[i][p.begin : p.end] for p in by_id[i].passages]
        assert cut
        for passage in cut:
            first, last = (w.strip(",!").lower() for w in (passage.split()[0], passage.split()[-1]))
            assert all(w in bad or w.startswith("scumbag") for w in (first, last))
        assert all(p.chance <= toxicity.CHANCE for p in by_id[i].passages)


def test_without_ratings_or_rows(spark, prose):
    rows, labels = rated(prose, random.Random(4), 12)
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for ratings in (none, spark.createDataFrame([(i, 0) for i, _ in labels], "doc_id long, toxic int")):
        got = score_toxicity(docs, train_toxicity(docs, ratings)).collect()
        assert len({r.score for r in got}) == 1 and {r.predicted for r in got} == {0}
    model = train_toxicity(docs.limit(0), none)
    assert isinstance(model, ToxicModel)
    assert score_toxicity(docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    """Bounds per language on ratings that were not learned."""
    tables = "/root/testdata/sf0.1"
    got = op11_toxicity(spark, tables)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    documents = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{tables}/labels.parquet").where("toxic IS NOT NULL").dropDuplicates(["doc_id"])
    rows = got.join(documents, "doc_id").join(labels, "doc_id").collect()
    assert got.count() == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    rows = [r for r in rows if r.held_out]
    for lang, least in {"en": 0.88, "de": 0.9, "fr": 0.9, "es": 0.6}.items():
        mine = [r for r in rows if r.lang == lang]
        toxic, clean = ([r.predicted for r in mine if r.toxic == t] for t in (1, 0))
        assert sum(toxic) >= least * len(toxic) and sum(clean) <= 0.02 * len(clean) + 1
    error = math.fsum((r.score - r.toxic) ** 2 for r in rows) / len(rows)
    assert error < 0.02
