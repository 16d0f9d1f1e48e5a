"""Multi-index search over vectors of several lengths."""

import numpy as np
from flowlake.llm.multiindex import nearest_vectors


def test_each_length_is_searched_among_its_own(spark):
    made = np.random.default_rng(6)
    rows = [(i, made.standard_normal(dim).tolist()) for i, dim in enumerate([12] * 300 + [7] * 150 + [1] * 5)]
    rows += [(1000, [1.0] * 20)]
    want = {}
    for q, x in rows:
        if q % 50 == 0:
            near = [(float(np.sqrt(((np.array(x) - v) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(x)]
            want[q] = [i for _, i in sorted(near)[:10]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(nearest_vectors(table, every=50, centroids=4, visited=1.0).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert len(want[300]) == 10 and len(want[450]) == 4 and want.pop(1000) == []
    assert got == want
