"""Quality classifier and multi-index search."""

import random

import numpy as np
import pyarrow as pa
import pytest

from flowlake.llm.multiindex import MultiIndex, nearest_vectors
from flowlake.llm.quality import (
    fit_ordinal,
    grade_documents,
    hashed_features,
    select_documents,
    train_quality,
)


@pytest.fixture
def rated(spark, prose):
    """Prose, prose with bad words, and junk: grades 2, 1 and 0."""
    dice = random.Random(7)
    rows = []
    for i in range(900):
        grade = dice.choice([0, 1, 2, 2, 2])
        words = prose(dice.choice([8, 40, 200])).split()
        if grade == 1:
            for _ in range(2):
                words[dice.randrange(len(words))] = dice.choice(["vile", "nasty", "rotten"])
        if grade == 0:
            words = dice.choice([[w.upper() + "!!" for w in words], words[:1] * len(words), [w + "###" for w in words]])
        rows.append((i, " ".join(words), grade))
    return rows


def test_held_out_grades(spark, rated):
    docs = spark.createDataFrame([(i, t, "x", 0.0) for i, t, _ in rated], "doc_id long, text string, grade string, score double")
    ratings = [(i, g) for i, _, g in rated if i % 3] + [(None, 1), (5, None), (1, rated[1][2])]
    model = train_quality(docs, spark.createDataFrame(ratings, "doc_id long, grade int"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in grade_documents(docs, model).collect()}
    held = [(got[i], g) for i, _, g in rated if i % 3 == 0]
    assert np.mean([r.kept == (g == 2) for r, g in held]) > 0.93
    means = [np.mean([r.expected_grade for r, g in held if g == k]) for k in range(3)]
    assert means[0] < 0.5 < means[1] < 1.6 < means[2]
    kept = select_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_quality_of_odd_rows(spark, rated):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "w " * 50_000), (3, "w " * 50_000)], "doc_id long, text string")
    train = spark.createDataFrame([(i, t) for i, t, _ in rated], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in rated], "doc_id long, grade int")
    model = train_quality(train, ratings)
    got = grade_documents(docs, model).collect()
    assert len(got) == 5 and {r.score for r in got if r.doc_id in (1, 2)} == {0.0}
    assert grade_documents(docs.limit(0), model).collect() == []
    assert train_quality(train, ratings.limit(0)) is None
    assert train_quality(train.limit(0), ratings) is None
    assert all(r.kept and r.score is None for r in grade_documents(docs, None).collect())
    few = train_quality(train, ratings, sample_rows=50)
    assert len(few.features) < len(model.features)


def test_ordinal_gradient_finds_the_likeliest():
    """Counts alone, no features in common: chances equal the shares of grades."""
    grades = np.array([0] * 20 + [1] * 30 + [2] * 50)
    none = np.zeros(0, np.int64)
    model = fit_ordinal(grades, none, none, none)
    assert np.allclose(model.tails(np.zeros(1)), [[0.8, 0.5]], atol=0.01)


def test_ordinal_fit_with_features_is_a_minimum():
    """No numeric slope of the penalised loss is left, in any weight or threshold."""
    dice = np.random.default_rng(3)
    n, decay = 400, 1e-2
    given = dice.random((n, 5)) < 0.4
    pull = given @ np.array([2.0, -1.0, 0.5, 0.0, -2.0]) + dice.logistic(size=n)
    grades = np.digitize(pull, [-1.0, 0.5, 1.5])
    row, feature = np.nonzero(given)
    count = dice.integers(1, 4, len(row))
    model = fit_ordinal(grades, row, feature * 7 + 3, count, rounds=6000, rate=0.01, decay=decay)
    at, value, row = model.values(n, row, feature * 7 + 3, count)

    def loss(theta):
        weights, limits = theta[:5], theta[5:]
        score = np.bincount(row, weights[at] * value, n)
        up_to = 1 / (1 + np.exp(score[:, None] - limits))
        whole = np.hstack([np.zeros((n, 1)), up_to, np.ones((n, 1))])
        places = np.arange(n)
        return -np.log(whole[places, grades + 1] - whole[places, grades]).mean() + decay / 2 * (weights**2).sum()

    theta = np.concatenate([model.weights, model.thresholds])
    assert theta.shape == (8,) and (np.diff(model.thresholds) > 0).all() and (np.abs(model.weights) > 0.05).any()
    step = 1e-5 * np.eye(8)
    slopes = np.array([(loss(theta + s) - loss(theta - s)) / 2e-5 for s in step])
    start = np.concatenate([np.zeros(5), model.thresholds])
    assert loss(theta) < loss(start) - 0.01
    assert np.abs(slopes).max() < 1e-3


def test_words_of_a_shape_share_a_feature():
    def features(*texts):
        row, feature, count = hashed_features(pa.array(texts, pa.large_string()))
        return [dict(zip(feature[row == i].tolist(), count[row == i].tolist())) for i in range(len(texts))]

    one, two, three, four, none = features("abc", "xy", "ABC ABC", "Qr!!!", "")
    assert len(one) == 2 and len(one.keys() & two.keys()) == 1 and none == {}
    assert one.keys() & three.keys() and 1 in three and three[1] == 1 and max(three.values()) == 2
    assert not four.keys() & one.keys() and four.keys() & features("Ab!")[0].keys()


def brute(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any() and len(v) == 12]
    out = {}
    for q, x in good:
        if q % every == 0:
            near = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, v in good if i != q)[:k]
            out[q] = near
    return out


@pytest.fixture
def vectors():
    made = np.random.default_rng(3)
    rows = [(i, made.standard_normal(12).tolist()) for i in range(1500)]
    rows += [(3000 + i, rows[7][1]) for i in range(40)] + [(4000, rows[7][1])]
    odd = [None, [], [0.0] * 12, [None] + [1.0] * 11, [float("nan")] * 12, [float("inf")] * 12, [1.0] * 5]
    rows += [(5000 + 100 * i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 12), rows[100], rows[200]]
    random.Random(1).shuffle(rows)
    return rows


def test_exhaustive_visit_matches_brute_force(spark, vectors):
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<double>, first int, block int")
    want = brute(dict(vectors).items(), 100, 10)
    got = nearest_vectors(table, centroids=5, visited=1.0, block_rows=90, block_queries=4).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    assert {q: [i for _, i in x] for q, x in found.items()} == {q: [i for _, i in x] for q, x in want.items()}
    assert all(a == pytest.approx(b, abs=1e-12) for q in want for (a, _), (b, _) in zip(found[q], want[q]))


def test_recall_of_a_partial_visit(spark, vectors):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    want = brute(dict(vectors).items(), 100, 10)
    got = nearest_vectors(table, centroids=8).collect()
    pairs = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, i) in pairs for q, x in want.items() for _, i in x) / sum(map(len, want.values())) >= 0.9
    assert nearest_vectors(table.limit(0)).collect() == []
    tiny = spark.createDataFrame([(0, [1.0]), (100, [2.0]), (1, [4.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, nearest_vectors(tiny).collect())) == [
        (0, 1, 100, 1.0), (0, 2, 1, 3.0), (100, 1, 0, 1.0), (100, 2, 1, 2.0)
    ]


def test_cells_are_visited_by_rising_distance():
    made = np.random.default_rng(1)
    one, two = made.random(9), made.random(7)
    counts = made.integers(0, 4, (9, 7))
    index = MultiIndex(np.zeros((9, 1)), np.zeros((7, 1)), counts)
    order = sorted((one[i] + two[j], i, j) for i in range(9) for j in range(7))
    for wanted in (1, 5, 40, 10_000):
        held, cells = 0, set()
        for _, i, j in order:
            if held >= wanted:
                break
            held += counts[i, j]
            cells.add((i, j))
        near = np.argsort(two)
        depth = index.visit(one, two, wanted)
        assert {(i, j) for i in range(9) for j in near[: depth[i]]} == cells
