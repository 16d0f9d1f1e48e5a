"""Embedding near-dedup by random-hyperplane sign hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import forest, in_lanes, stored, whole_groups
from flowlake.llm.components import connected_components

THRESHOLD = 0.9

# Two vectors at angle t share a bit with probability 1 - t / pi: at cosine 0.9
# a pair meets in one of the tables with probability 0.996, at 0.95 with 0.99997.
BITS = 11
TABLES = 28

# Rows of a bucket compared in one block of lanes.
BLOCK_ROWS = 2048

# Groups up to this size are compared side by side, larger ones by a product.
SMALL = 48


def usable(column: str) -> Column:
    """True for vectors that are neither null, zero nor hold null or non-finite parts."""
    vector = F.col(column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def to_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of lists of one length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so no square over- or underflows."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _hashed(bits: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column("vector")], np.int64)
            codes: list = [None] * len(lengths)
            for dim in np.unique(lengths).tolist():
                if dim not in planes:
                    made = np.random.default_rng([seed, dim])
                    planes[dim] = made.standard_normal((dim, bits * tables))
                at = np.flatnonzero(lengths == dim)
                rows = to_matrix(batch.column("vector").take(pa.array(at)))
                signs = (unit(rows) @ planes[dim] > 0).reshape(len(at), tables, bits)
                packed = (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)
                for row, code in zip(at.tolist(), packed):
                    codes[row] = code
            yield pa.record_batch(
                [*batch.columns, pa.array(codes, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "codes"],
            )

    return run


def _near(vectors: np.ndarray, starts: np.ndarray, threshold: float):
    """Index pairs of the same group at ``threshold`` or more."""
    left, right = [], []
    sizes = np.diff(starts)
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    rows = np.repeat(starts[:-1][small], sizes[small])
    within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes[small]) - sizes[small], sizes[small])
    rows, after = rows + within, np.repeat(sizes[small], sizes[small]) - within - 1
    for shift in range(1, SMALL):
        rows, after = rows[after >= shift], after[after >= shift]
        if not len(rows):
            break
        for at in np.array_split(rows, len(rows) // 65536 + 1):
            cosine = np.einsum("ij,ij->i", vectors[at], vectors[at + shift])
            left.append(at[cosine >= threshold])
            right.append(left[-1] + shift)
    for group in np.flatnonzero(sizes > SMALL).tolist():
        low, high = int(starts[group]), int(starts[group + 1])
        for at in range(low, high, 512):
            stop = min(at + 512, high)
            cosine = vectors[at:stop] @ vectors[low:high].T
            i, j = np.nonzero(cosine >= threshold - 1e-9)
            i, j = i + at, j + low
            i, j = i[i < j], j[i < j]
            # The same sum, term by term, whatever the size of the group.
            for part in np.array_split(np.arange(len(i)), len(i) // 65536 + 1):
                exact = np.einsum("ij,ij->i", vectors[i[part]], vectors[j[part]])
                left.append(i[part][exact >= threshold])
                right.append(j[part][exact >= threshold])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _linked(threshold: float):
    keys = ["slot", "dim", "code", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys, 8192):
            column = {k: table.column(k).to_numpy() for k in ("node", "copies", "slot", "lane", "low", "high")}
            dims = table.column("dim").to_numpy()
            codes = to_matrix(table.column("codes")).astype(np.int32)
            i, j = [], []
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)  # groups are sorted within a table
                where = np.searchsorted(at, starts[:-1][dims[starts[:-1]] == dim])
                vectors = unit(to_matrix(table.column("vector").take(pa.array(at))))
                a, b = _near(vectors, np.append(where, len(at)), threshold)
                i.append(at[a])
                j.append(at[b])
            i, j = np.concatenate(i), np.concatenate(j)
            # Two lanes of one block: its own rows meet in the block of one lane.
            fresh = (column["low"][i] == column["high"][i]) | (column["lane"][i] != column["lane"][j])
            i, j = i[fresh], j[fresh]
            # A pair counts in the first table it shares.
            for part in np.array_split(np.arange(len(i)), len(i) // 65536 + 1):
                same = codes[i[part]] == codes[j[part]]
                fresh = same.argmax(axis=1) == column["slot"][i[part]]
                yield from _emit(column, i[part][fresh], j[part][fresh])

    return run


def _emit(column: dict, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links per node, as (node, null, count), and a forest, as (node, root, null)."""
    if not len(i):
        return
    nodes, copies = column["node"], column["copies"]
    at, where = np.unique(np.concatenate([i, j]), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([copies[j], copies[i]])).astype(np.int64)
    root = forest(where[: len(i)], where[len(i) :], len(at))
    member = np.flatnonzero(root != np.arange(len(at)))
    a = np.concatenate([nodes[at], nodes[at[member]]])
    b = pa.array(
        np.concatenate([np.zeros(len(at), np.int64), nodes[at[root[member]]]]),
        mask=np.arange(len(a)) < len(at),
    )
    n = pa.array(np.concatenate([counts, np.zeros(len(member), np.int64)]))
    yield pa.record_batch([pa.array(a), b, n], names=["a", "b", "n"])


def near_vectors(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    bits: int = BITS,
    tables: int = TABLES,
    seed: int = 11,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding).

    Vectors that share the signs of ``bits`` random hyperplanes in any of
    ``tables`` tables are compared by exact cosine in double precision; a pair at
    ``threshold`` or more is a link.  None below it is ever linked; a pair above
    it is missed with the probability noted at ``BITS``.

    Equal vectors are one node, counted by their number.  A bucket gives counts
    per node and a spanning forest, never its pairs; a pair found in several
    tables counts in the first.  A bucket of more than ``block_rows`` nodes is
    compared in blocks.  Vectors of different lengths never link.

    Vectors that are null, empty, zero, or hold null or non-finite parts link
    with nothing: no links, a component of their own.  Rows that repeat are
    returned as often, and count as vectors of their own.  Rows without vec_id
    take no part; their component is null and they are kept.  Other columns are
    ignored.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").alias("vector")
    ).withColumn("fit", usable("vector") & F.col("vec_id").isNotNull())
    kind = dict(rows.dtypes)["vector"]
    nodes = stored(
        rows.where("fit")
        .groupBy("vector")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .mapInArrow(
            _hashed(bits, tables, seed),
            f"vector {kind}, node long, copies long, codes array<int>",
        ),
        "vectors",
    )
    keyed = nodes.select(
        "node",
        "copies",
        "vector",
        "codes",
        F.size("vector").alias("dim"),
        F.posexplode("codes").alias("slot", "code"),
    )
    block = ["slot", "dim", "code", "low", "high"]
    found = stored(
        in_lanes(keyed, ["slot", "dim", "code"], ["node"], block_rows)
        .repartition(*block)
        .sortWithinPartitions(*block)
        .mapInArrow(_linked(threshold), "a long, b long, n long"),
        "near",
    )
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    named = (
        nodes.select("vector", "node", "copies")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
            F.lit(True).alias("fit"),
        )
    )
    joined = rows.join(named, ["vector", "fit"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
