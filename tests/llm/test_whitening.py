"""Whitening against exact arithmetic in Python."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from flowlake.llm import whitening
from flowlake.llm.whitening import whiten_vectors

SCHEMA = "vec_id long, embedding array<double>, n int, deviation string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)


def longs(vector):
    top, low = 2**63 - 1, -(2**63)
    return tuple(min(top, max(low, math.floor(Fraction(c) * 64) + 1_000_000)) for c in vector)


def by_hand(rows):
    """{vec_id: x}, fit list, sums, exact covariance."""
    xs = [(i, longs(v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in xs})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dims)]
    y = [[n * x[i] - sums[i] for i in range(dims)] for x in fit]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(dims)] for i in range(dims)]
    return xs, fit, sums, np.array(cov)


def check(spark, rows):
    xs, fit, sums, cov = by_hand(rows)
    n = len(fit)
    values, vectors = np.linalg.eigh(cov)
    got = whiten_vectors(table(spark, rows)).collect()
    k = max((r.component for r in got), default=0)
    assert k == min(16, int((values > values[-1] * len(sums) * np.finfo(float).eps).sum()))
    assert len(got) == k * len(xs)
    ids = sorted((i for i, _ in xs for _ in range(k)), key=str)
    assert sorted((r.vec_id for r in got), key=str) == ids
    known = dict(xs)
    for r in got:
        x = known[r.vec_id]
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert (r.n, r.wide_deviation) == (n, str(exact))
        assert r.deviation == (exact if exact < 2**63 else None)
        value, vector = values[-r.component], vectors[:, -r.component]
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        want = abs(centred @ vector) / math.sqrt(value)
        assert abs(r.whitened) == pytest.approx(want, rel=1e-6, abs=1e-6)
        assert r.explained == pytest.approx(value / np.trace(cov), rel=1e-6)
        assert r.identity_error < 1e-6
    return got


def test_like_exact_arithmetic(spark):
    dice = random.Random(3)
    rows = [(i, [dice.gauss(0, 1 + j) for j in range(20)]) for i in range(150)]
    rows += [(150 + i, rows[0][1]) for i in range(70)]  # a hot vector
    rows += [(300, None), (301, [1.0] * 19 + [None]), (302, [float("nan")] * 20), (303, [1.0] * 19 + [float("inf")])]
    got = check(spark, rows)
    # Whitened by their one sign: every row of a component follows the same vector.
    signs = {}
    _, fit, sums, cov = by_hand(rows)
    vectors = np.linalg.eigh(cov)[1]
    known = dict(by_hand(rows)[0])
    for r in got:
        side = (np.array(known[r.vec_id]) - np.array(sums) / len(fit)) @ vectors[:, -r.component]
        if abs(side) > 1e-3:
            signs.setdefault(r.component, set()).add(np.sign(side) == np.sign(r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_entries_beyond_64_bits(spark):
    dice = random.Random(4)
    rows = [(i, [dice.choice([1e15, -3e14, 0.5]) * dice.random(), dice.gauss(0, 1e14)]) for i in range(40)]
    check(spark, rows)
    far = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])]
    got = whiten_vectors(table(spark, far)).collect()
    _, fit, sums, _ = by_hand(far)
    want = {i: str(sum((3 * a - s) ** 2 for a, s in zip(longs(v), sums))) for i, v in far}
    assert {r.vec_id: r.wide_deviation for r in got} == want
    assert {r.vec_id for r in got if r.deviation is None} == {i for i, v in want.items() if int(v) >= 2**63} == {1, 2}


def test_fewer_components(spark):
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]  # one direction only
    assert {r.component for r in check(spark, flat)} == {1}
    assert whiten_vectors(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whiten_vectors(table(spark, [(1, []), (2, [])])).collect() == []
    assert whiten_vectors(table(spark, [(1, None), (2, [None])])).collect() == []
    assert whiten_vectors(table(spark, []).limit(0)).collect() == []


def test_lengths_repeated_rows_and_null_ids(spark):
    dice = random.Random(6)
    two = [(i, [dice.random(), dice.random()]) for i in range(30)]
    three = [(100 + i, [dice.random() for _ in range(3)]) for i in range(30)]
    both = {(r.vec_id, r.component): r for r in whiten_vectors(table(spark, two + three)).collect()}
    for rows in (two, three):
        for r in whiten_vectors(table(spark, rows)).collect():
            other = both[r.vec_id, r.component]
            assert (r.n, r.deviation) == (other.n, other.deviation)
            assert r.whitened == pytest.approx(other.whitened, rel=1e-9)
    again = two + two[:3] + [(None, [0.25, 0.5])]
    got = whiten_vectors(table(spark, again)).collect()
    assert len(got) == 2 * 34 and sum(r.vec_id is None for r in got) == 2
    assert {r.n for r in got} == {31}


def test_limbs_hold_any_sum():
    for total in (0, 5, -5, 2**200 + 12345, -(2**200) - 9, 2**63):
        limbs = whitening._to_limbs(total)
        assert sum(v << (whitening.LIMB_BITS * i) for i, v in enumerate(limbs)) == total
