"""SimHash groups and embedding near-dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash

from flowlake.llm.embeddings import near_vectors
from flowlake.llm.components import connected_components
from flowlake.llm.simhash import close_pairs, fingerprint, keep_first, piece_masks, shingle_hashes, simhash_groups


def roots(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [plain_print(text) for _, text in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if rows[i][0] is not None and rows[j][0] is not None and (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    root = roots(len(rows), links)
    least = {}
    for (doc, _), r in zip(rows, root):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(
        ((doc, f"{p:016x}", least.get(r) if doc is not None else None) for (doc, _), p, r in zip(rows, prints, root)),
        key=str,
    )


@pytest.fixture
def documents(prose):
    dice = random.Random(3)
    rows = []
    for i in range(60):
        words = prose(dice.choice([1, 3, 4, 5, 60, 300])).split(" ")
        rows.append((i, " ".join(words)))
        for k in range(dice.randint(0, 4)):
            near = list(words)
            near[dice.randrange(len(near))] = prose(1)
            rows.append((100 + 10 * i + k, "\n".join(near).upper() if k == 1 else "  ".join(near)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, "a b c d e"), (903, "É é\x1cx y"), rows[5]]
    return rows


def test_simhash_matches_brute_force(spark, documents):
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in documents], "doc_id long, text string, print string, node int")
    for options in ({}, {"block_rows": 3}):
        got = sorted((tuple(r) for r in simhash_groups(docs, **options).collect()), key=str)
        assert got == plain_groups(documents)
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, c in plain_groups(documents) if d == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_simhash_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(empty).collect() == []


def test_fingerprint_bits():
    assert fingerprint(shingle_hashes("")) == 0
    text = "Some Words of a text that has more than four"
    assert fingerprint(shingle_hashes(text)) % 2**64 == plain_print(text)


@pytest.mark.parametrize("radius", range(8))
def test_bit_slices_find_every_close_pair(radius):
    made = np.random.default_rng(radius)
    centre = made.integers(0, 2**63, 20, dtype=np.uint64)
    prints = np.repeat(centre, 15)
    for _ in range(5):
        prints ^= np.uint64(1) << made.integers(0, 64, len(prints), dtype=np.uint64)
    starts = np.array([0, 1, 150, 150, 200, 300])
    want = {
        (i, j)
        for a, b in zip(starts, starts[1:])
        for i in range(a, b)
        for j in range(i + 1, b)
        if int(prints[i] ^ prints[j]).bit_count() <= radius
    }
    i, j = close_pairs(prints, starts, radius)
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_any_close_pair_shares_a_choice_of_pieces():
    masks = piece_masks()
    dice = random.Random(1)
    for _ in range(500):
        flips = sum(1 << b for b in dice.sample(range(64), 4))
        assert any(flips & (m % 2**64) == 0 for m in masks)


def test_components(spark):
    dice = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, x) for x in range(201, 260)] + [(7, 7)]
    links += [(dice.randrange(300, 360), dice.randrange(300, 360)) for _ in range(40)]
    dice.shuffle(links)
    want = {x: r for x, r in enumerate(roots(400, links)) if x != r}
    got = connected_components(spark.createDataFrame(links + [(None, 3)], "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


def test_vectors_match_brute_force(spark):
    made = np.random.default_rng(4)
    base = made.standard_normal((40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(0, 40, 3):
        for k in range(6):
            rows.append((100 + 10 * i + k, (base[i] + 0.08 * made.standard_normal(16)).tolist()))
    rows += [(i + 1000, (3 * base[3]).tolist()) for i in range(70)]
    rows += [(2000 + i, (base[6] + 0.05 * made.standard_normal(16)).tolist()) for i in range(80)]
    rows += [(5000, base[0][:8].tolist()), (5001, base[0][:8].tolist()), (5002, (1e200 * base[0]).tolist())]
    odd = [(6000, None), (6001, [0.0] * 16), (6002, [None] + [1.0] * 15), (6003, [float("nan")] * 16), (6004, []), (6005, [float("inf")] * 16)]
    dice = random.Random(1)
    dice.shuffle(rows)
    unit = [np.array(v) / np.abs(v).max() for _, v in rows]
    unit = [v / np.sqrt(v @ v) for v in unit]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9 - 1e-12
    ]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    place = {i: n for n, i in enumerate(order)}
    root = roots(len(rows), [(place[i], place[j]) for i, j in links])
    counts = [0] * len(rows)
    for i, j in links:
        counts[i] += 1
        counts[j] += 1
    want = sorted(
        [(rows[i][0], counts[i], rows[order[root[place[i]]]][0]) for i in range(len(rows))] + [(i, 0, i) for i, _ in odd]
    )
    table = spark.createDataFrame([(a, b, 1, 2) for a, b in rows + odd], "vec_id long, embedding array<double>, node int, fit int")
    for options in ({"bits": 6, "tables": 60}, {"bits": 4, "tables": 40, "block_rows": 20}):
        found = near_vectors(table, **options).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert near_vectors(table.limit(0)).collect() == []
