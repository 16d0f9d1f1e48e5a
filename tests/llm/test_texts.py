"""Substring and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from flowlake.llm import lines
from flowlake.llm.lines import dedup_lines
from flowlake.llm.substrings import remove_repeats


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_repeats(rows, window):
    seen = {}
    for doc, text in rows:
        words = words_of(text)
        if doc is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                seen[key] = min(doc, seen.get(key, doc))
    out = []
    for doc, text in rows:
        words = words_of(text)
        gone = [False] * len(words)
        if doc is not None:
            for i in range(len(words) - window + 1):
                if seen[tuple(words[i : i + window])] < doc:
                    gone[i : i + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc, " ".join(kept), len(words), sum(gone)))
    return sorted(out, key=str)


@pytest.fixture
def repeats(prose):
    """Copies, near copies, shared passages, and phrases common to all."""
    dice = random.Random(8)
    passages = [prose(dice.randint(8, 40)) for _ in range(12)]
    rows = []
    for i in range(90):
        parts = [prose(dice.choice([1, 5, 30, 120]))]
        for _ in range(dice.randint(0, 3)):
            parts += [dice.choice(passages), prose(dice.choice([1, 2, 20]))]
        if i % 4 == 0 and rows:
            near = dice.choice(rows)[1].split()
            near[dice.randrange(len(near))] = prose(1)
            parts = [" ".join(near)]
        rows.append((dice.randrange(1000) * 100 + i, dice.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(i, rows[0][1]) for i in range(20, 40)]
    rows += [(1, "the of and " * 40), (2, "and the of " * 30), (3, "to the of and the " * 12)]
    rows += [(4, None), (5, ""), (6, " \n "), (None, rows[0][1]), (rows[1][0], rows[2][1]), rows[3], rows[3]]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize(("window", "anchor"), [(13, 5), (13, 13), (6, 1)])
def test_repeats_match_brute_force(spark, repeats, window, anchor):
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in repeats], "doc_id long, text string, sig int, anchor string")
    got = remove_repeats(docs.repartition(7), window, anchor)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_repeats(repeats, window)
    assert remove_repeats(docs.limit(0)).collect() == []


def test_long_text_repeats(spark, prose):
    long = prose(30_000)
    rows = [(1, long), (2, prose(50) + " " + " ".join(long.split()[5000:20_000]) + " " + prose(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, remove_repeats(docs).collect())) == plain_repeats(rows, 13)
    assert plain_repeats(rows, 13)[1][3] == 15_000


def plain_lines(rows):
    """Rows that repeat are one document, so places are those of distinct rows."""
    signed = {row: None for row in rows if row[0] is not None}
    lines = sorted((doc, text or "") for doc, text in signed)
    groups = {}
    for doc, text in lines:
        groups.setdefault(doc, []).append(text)
    assert all(len(v) == 1 for v in groups.values()), "ties are compared elsewhere"
    earlier, gone = [], set()
    for doc, text in lines:
        for n, line in enumerate(text.split("\n")):
            tokens = frozenset(words_of(line))
            if tokens:
                if any(5 * len(tokens & x) >= 4 * len(tokens | x) for x in earlier):
                    gone.add((doc, n))
                earlier.append(tokens)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for n, x in enumerate(all_lines) if (doc, n) not in gone]
        out.append((doc, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


@pytest.fixture
def pages(prose):
    dice = random.Random(9)
    boiler = [prose(n) for n in (1, 2, 4, 5, 6, 9, 10, 14, 20, 45)]
    rows = []
    for i in range(70):
        lines = [prose(dice.choice([1, 3, 8, 25])) for _ in range(dice.randint(1, 5))]
        for _ in range(dice.randint(0, 4)):
            line = dice.choice(boiler).split()
            for _ in range(dice.randint(0, 2)):
                line[dice.randrange(len(line))] = prose(1)
            if dice.random() < 0.3:
                dice.shuffle(line)
            lines.append(" ".join(line))
        lines += dice.choice([[], ["", "  "], ["a b c d e f g h i j", "b c d e f g h i j k a"]])
        rows.append((dice.randrange(500) * 100 + i, "\n".join(lines)))
    rows += [(1, None), (2, ""), (3, "\n\n"), (4, "x\r\ny\x0bz\ny z"), (None, rows[0][1]), rows[5], rows[5]]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_rows", [20_000, 4])
def test_lines_match_brute_force(spark, pages, block_rows):
    docs = spark.createDataFrame([(a, b, 1, 2, 3) for a, b in pages], "doc_id long, text string, sig int, line int, lines int")
    got = dedup_lines(docs.repartition(5), block_rows=block_rows)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_lines(pages)
    assert dedup_lines(docs.limit(0)).collect() == []


@pytest.mark.parametrize("first", [1, 4])
def test_long_lines_match_brute_force(spark, first):
    """Lines around the similarity, of all lengths from which on more bits are kept."""
    dice = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for n in (100, 127, 128, 140, 255, 256, 300, 1100, 2200):
        base = dice.sample(words, n)
        for copy in range(12):
            changed = dice.randint(int(0.12 * n), int(0.25 * n))
            line = base[changed:] + dice.sample(words, dice.choice([0, changed, changed // 2]))
            rows.append((dice.randrange(10**6), " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, dedup_lines(docs, first=first).collect()), key=str)
    assert got == plain_lines(rows)
    assert 10 < sum(r[3] for r in got) < len(rows) - 10


def test_lines_that_only_seem_alike(spark):
    """Lines just below the similarity in a shared block, where the earliest
    candidate may fail and a later one hold."""
    dice = random.Random(4)
    common = [f"w{i}" for i in range(8)]
    rows = []
    for i in range(300):
        line = list(common)
        for at in dice.sample(range(8), dice.choice([1, 1, 2])):
            line[at] = f"{dice.choice('xy')}{dice.randrange(60)}"
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, dedup_lines(docs, block_rows=50).collect()), key=str) == plain_lines(rows)


def test_same_doc_id_with_two_texts(spark):
    rows = [(1, "a b c d e\nq w e r t"), (1, "a b c d e\nz x c v b"), (2, "z x c v b\nq w e r t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_lines(docs).collect()
    assert sorted(r.n_removed for r in got if r.doc_id == 1) == [0, 1]
    assert [r.text for r in got if r.doc_id == 2] == [""]
    kept = remove_repeats(docs, 3, 2).collect()
    assert hashlib.sha256("".join(sorted(r.text for r in kept if r.doc_id == 1)).encode()).hexdigest()
    assert {r.n_removed for r in kept if r.doc_id == 1} == {0}
    assert [r.text for r in kept if r.doc_id == 2] == [""]


def test_tasks_pass_on_counts_in_stretches(spark, prose):
    """A task gave a row for each of a million buckets, and all lines were sorted
    ahead of a shuffle that hardly any of them was spared."""
    texts = [prose(n) for n in (1, 50, 4000, 4000)] + [None, ""]
    docs = spark.createDataFrame([(x,) for x in texts], "text string")
    words = [w for text in texts if text for w in words_of(text)]
    counts = lines.bucket_counts(docs.repartition(3))
    one = pa.array([" ".join(words)], pa.large_string())
    buckets = lines.Words(one).hashes() >> np.uint64(64 - lines.BUCKET_BITS)
    assert np.array_equal(counts, np.bincount(buckets.astype(np.int64), minlength=1 << lines.BUCKET_BITS))
    rows = list(lines._counts([pa.record_batch([one], names=["text"])]))
    assert sum(x.num_rows for x in rows) <= (1 << lines.BUCKET_BITS) // lines.STRETCH
    assert not lines.bucket_counts(docs.limit(0)).any()


def test_order_of_tokens_that_share_their_top_bits():
    dice = np.random.default_rng(3)
    for top in (1, 1 << 20, 1 << 63):
        owner = np.sort(dice.integers(0, 9, 500)) << 32
        tokens = dice.integers(0, 60, 500).astype(np.uint64) * np.uint64(top)
        order = lines._by_line(owner, tokens)
        want = np.lexsort((tokens, owner))
        assert np.array_equal(tokens[order], tokens[want]) and np.array_equal(owner[order], owner[want])
    assert not len(lines._by_line(np.zeros(0, np.int64), np.zeros(0, np.uint64)))


def test_a_slice_and_a_task_leave_one_line_of_each_set():
    """Sets that go on from batch to batch, and two that share a digest."""
    dice = np.random.default_rng(5)
    names = ["d1", "d2", "doc_id", "sig", "line", "n"]
    rows = np.stack([dice.integers(0, k, 400) for k in (12, 2, 50, 2, 3, 2)], axis=1)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    best = {}
    for d1, d2, *line, n in rows.tolist():
        best[d1, d2, n] = min(best.get((d1, d2, n), line), line)
    for size in (1, 7, 400):
        batches = [pa.record_batch(list(rows[i : i + size].T.copy()), names=names) for i in range(0, 400, size)]
        got = [tuple(r.values()) for x in lines._classes(iter(batches)) for r in x.to_pylist()]
        assert sorted(got) == sorted((*line, n) for (_, _, n), line in best.items())
    assert list(lines._classes(iter([]))) == []
