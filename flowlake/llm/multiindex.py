"""Approximate nearest neighbours with an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.blocks import stored
from flowlake.llm.embeddings import to_matrix, usable

NEIGHBOURS = 10

# Centroids per half; a vector's cell is a pair of them.
CENTROIDS = 32

# Vectors the centroids are fitted on at most: those of the smallest hashes of
# vec_id.  All vectors are indexed.
SAMPLE_ROWS = 8192

# A query visits cells until they hold this share of all vectors.
VISITED = 0.55

# Vectors and queries compared in one block.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


@dataclass
class MultiIndex:
    """Centroids of either half of a vector, and the number of vectors per cell."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to their centroids."""
        cut = self.first.shape[1]
        return squared(vectors[:, :cut], self.first), squared(vectors[:, cut:], self.second)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = self.halves(vectors)
        return one.argmin(axis=1), two.argmin(axis=1)

    def visit(self, one: np.ndarray, two: np.ndarray, wanted: int) -> np.ndarray:
        """Cells, by rising sum of both distances, until they hold ``wanted``
        vectors: per first centroid, how many of its nearest second ones.

        A heap holds the next pair of each row of the sorted grid of pairs; a
        row's turn comes when the row before it has been entered.
        """
        a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        left, right, counts = one[a].tolist(), two[b].tolist(), self.counts[np.ix_(a, b)].tolist()
        depth = np.zeros(len(a), np.int64)
        heap, held = [(left[0] + right[0], 0, 0)], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            held += counts[i][j]
            depth[a[i]] = j + 1
            if j == 0 and i + 1 < len(left):
                heapq.heappush(heap, (left[i + 1] + right[0], i + 1, 0))
            if j + 1 < len(right):
                heapq.heappush(heap, (left[i] + right[j + 1], i, j + 1))
        return depth


def squared(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    return (
        (rows * rows).sum(axis=1)[:, None] + (others * others).sum(axis=1)[None, :] - 2 * rows @ others.T
    )


def centroids_of(rows: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """k-means from distinct rows, chosen in the order given."""
    distinct = rows[np.sort(np.unique(rows, axis=0, return_index=True)[1])]
    centres = distinct[:count].copy()
    for _ in range(rounds):
        nearest = squared(rows, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        for dim in range(rows.shape[1]):
            sums = np.bincount(nearest, rows[:, dim], len(centres))
            centres[:, dim] = np.where(sizes > 0, sums / np.maximum(sizes, 1), centres[:, dim])
    return centres


def _celled(index: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j = index.cells(to_matrix(batch.column("vector")))
                yield pa.record_batch(
                    [*batch.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())],
                    names=[*batch.schema.names, "first", "second"],
                )

    return run


def _visits(index: MultiIndex, wanted: int):
    """Per query and first centroid: the second centroids to visit with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = index.halves(to_matrix(batch.column("vector")))
            rows, firsts, seconds = [], [], []
            for row in range(batch.num_rows):
                order = np.argsort(two[row], kind="stable").astype(np.int32)
                depth = index.visit(one[row], two[row], wanted)
                for first in np.flatnonzero(depth).tolist():
                    rows.append(row)
                    firsts.append(first)
                    seconds.append(order[: depth[first]])
            at = pa.array(rows, pa.int64())
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(at),
                    batch.column("vector").take(at),
                    pa.array(firsts, pa.int32()),
                    pa.array(seconds, pa.list_(pa.int32())),
                ],
                names=["query_id", "query", "first", "seconds"],
            )

    return run


def _nearest(k: int, width: int):
    """Per query of a block, the ``k`` nearest visited vectors of the block."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_query, out_id, out_score = [], [], []
        if rows.num_rows and queries.num_rows:
            ids, second = rows.column("vec_id").to_numpy(), rows.column("second").to_numpy()
            vectors, asked = to_matrix(rows.column("vector")), to_matrix(queries.column("query"))
            asked_ids = queries.column("query_id").to_numpy()
            seconds = queries.column("seconds").combine_chunks()
            open_ = np.zeros((len(asked), width), bool)
            open_[np.repeat(np.arange(len(asked)), seconds.value_lengths().to_numpy()), seconds.flatten().to_numpy()] = True
            for at in range(0, len(asked), 256):
                near = squared(asked[at : at + 256], vectors)
                near[~open_[at : at + 256][:, second]] = np.inf
                near[asked_ids[at : at + 256, None] == ids[None, :]] = np.inf
                for row, line in enumerate(near, at):
                    # The product rounds: whatever may be among the k is measured.
                    bound = np.partition(line, k - 1)[k - 1] if len(line) > k else np.inf
                    slack = 1e-9 * (1 + np.abs(asked[row]).max() ** 2 * len(asked[row]))
                    chosen = np.flatnonzero((line <= bound + slack) & (line < np.inf))
                    gaps = vectors[chosen] - asked[row]
                    score = np.sqrt((gaps * gaps).sum(axis=1))
                    best = np.lexsort((ids[chosen], score))[:k]
                    out_query.append(np.full(len(best), asked_ids[row]))
                    out_id.append(ids[chosen][best])
                    out_score.append(score[best])
        none = np.zeros(0)
        columns = [np.concatenate(c or [none]) for c in (out_query, out_id, out_score)]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds)],
            names=["query_id", "vec_id", "score"],
        )

    return run


def nearest_vectors(
    embeddings: DataFrame,
    every: int = 100,
    k: int = NEIGHBOURS,
    centroids: int = CENTROIDS,
    visited: float = VISITED,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of (vec_id, embedding) whose
    vec_id is divisible by ``every``, the ``k`` nearest others by Euclidean distance.

    Both halves of the vectors are quantised on their own, so ``centroids`` each
    make their square in cells.  A query goes through pairs of centroids by rising
    sum of the two distances, with a heap, until the cells hold the share
    ``visited`` of all vectors, and measures every vector in them.  Scores are
    exact, in double precision; ties go to the smaller vec_id.  Recall grows with
    ``visited``; at 1 the search is exhaustive.

    Vectors are dealt out by their first centroid and, within it, over as many
    blocks as its size asks for, queries over blocks of their own; a block of
    either meets in a task of bounded size.

    Vectors that are null, empty, zero, or hold null or non-finite parts take no
    part, nor do rows without vec_id.  Vectors of each length are searched among
    their own, one length after the other.  Of rows that share a vec_id the
    smallest vector counts.  Fewer than ``k`` others give as many rows; equal
    vectors are neighbours like any other.  Other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = (
        embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"))
        .where(F.col("vec_id").isNotNull() & usable("vector"))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )
    rows = stored(rows, "vectors")
    # A vector alone in its length has no neighbour.
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().where("count > 1").orderBy("dim").collect()
    parts = [
        _nearest_of_length(
            rows.where(F.size("vector") == dim), dim, every, k, centroids, visited, sample_rows, block_rows, block_queries
        )
        for dim, _ in lengths
    ]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionAll, parts)


def _nearest_of_length(
    rows: DataFrame,
    dim: int,
    every: int,
    k: int,
    centroids: int,
    visited: float,
    sample_rows: int,
    block_rows: int,
    block_queries: int,
) -> DataFrame:
    """``nearest_vectors`` of the stored ``rows`` (vec_id, vector), each of ``dim`` parts."""
    kind = dict(rows.dtypes)["vector"]
    sample = to_matrix(
        rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").toArrow()["vector"]
    )
    cut = max(1, dim // 2)
    # Vectors of one component have no second half: one centroid of no width.
    one, two = centroids_of(sample[:, :cut], centroids), centroids_of(sample[:, cut:], centroids)
    index = MultiIndex(one, two, np.zeros((len(one), len(two)), np.int64))
    celled = stored(
        rows.mapInArrow(_celled(index), f"vec_id long, vector {kind}, first int, second int"), "cells"
    )
    for cell in celled.groupBy("first", "second").count().collect():  # at most centroids squared
        index.counts[cell.first, cell.second] = cell["count"]
    wanted = max(int(np.ceil(visited * index.counts.sum())), k + 1)  # itself counts
    queries = rows.where(F.col("vec_id") % every == 0)
    asked = stored(
        queries.mapInArrow(_visits(index, wanted), f"query_id long, query {kind}, first int, seconds array<int>"),
        "visits",
    )
    blocks = F.array(*[F.lit(max(1, -(-int(n) // block_rows))) for n in index.counts.sum(axis=1)])
    block_count = F.element_at(blocks, F.col("first") + 1)
    query_blocks = max(1, -(-queries.count() // block_queries))

    def deal(column: str, count) -> Column:
        return F.pmod(F.xxhash64(column, F.lit(3)), F.lit(count) if isinstance(count, int) else count).cast("int")

    def all_of(count) -> Column:
        return F.explode(F.sequence(F.lit(0), (F.lit(count) if isinstance(count, int) else count) - 1))

    key = ["first", "block", "turn"]
    found = (
        celled.withColumn("block", deal("vec_id", block_count))
        .withColumn("turn", all_of(query_blocks))
        .groupBy(*key)
        .cogroup(
            asked.withColumn("block", all_of(block_count))
            .withColumn("turn", deal("query_id", query_blocks))
            .groupBy(*key)
        )
        .applyInArrow(_nearest(k, len(two)), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
