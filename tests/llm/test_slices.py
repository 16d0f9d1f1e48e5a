"""Memory of a Python worker while it counts phrases."""

import tracemalloc

import numpy as np
import pyarrow as pa

from flowlake.llm import phrases


def test_a_slice_is_gone_before_the_next(monkeypatch):
    limit = 1 << 20
    monkeypatch.setattr(phrases, "SLICE_BYTES", limit)
    draw = np.random.default_rng(1)
    words = [f"w{i:04d}" for i in range(5000)]
    texts = [" ".join(draw.choice(words, 1000)) + "." for _ in range(4 * limit // 6000)]
    batch = pa.record_batch([pa.array(texts), pa.array(["en"] * len(texts))], names=["text", "lang"])
    run = phrases._fingerprints((1, 2), [])
    for _ in run(iter([batch])):  # makes what the process keeps
        pass
    tracemalloc.start()
    counted = dict.fromkeys((1, 2), 0)
    for part in run(iter([batch])):
        for k, n in zip(part.column("k").to_pylist(), part.column("n").to_pylist(), strict=True):
            counted[k] += n
        del part
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counted == {1: 1000 * len(texts), 2: 999 * len(texts)}
    assert peak < 24 * limit
