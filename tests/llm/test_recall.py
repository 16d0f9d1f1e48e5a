"""Near-dedup of vectors with its own bits and tables against brute force."""

import numpy as np
from flowlake.llm.embeddings import near_vectors


def test_planted_pairs_are_found(spark):
    made = np.random.default_rng(12)
    planted = [0.9001] * 1500 + [0.92] * 500 + [0.95] * 500
    base, other = made.standard_normal((2, len(planted), 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    other -= (base * other).sum(axis=1)[:, None] * base
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = np.array(planted)[:, None]
    vectors = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * other])
    links = np.argwhere(np.triu(vectors @ vectors.T, 1) >= 0.9)
    n = len(planted)
    assert links.tolist() == [[i, i + n] for i in range(n)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(table).collect()}
    assert all(found[i] in ((0, i), (1, i)) and found[i + n] in ((0, i + n), (1, i)) for i in range(n))
    got = np.array([found[i + n] == (1, i) for i in range(n)])
    shares = {c: f"{got[np.array(planted) == c].sum()}/{planted.count(c)}" for c in sorted(set(planted))}
    print("pairs found by cosine:", shares)
    assert (~got[:1500]).sum() <= 15 and (~got[1500:2000]).sum() <= 3 and got[2000:].all(), shares
