"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns ``a``, ``b``, long) that
    is not itself the smallest node, ``root``, of its component.

    Alternates large and small stars until each component is a star around its
    smallest node, in a number of rounds logarithmic in the nodes.  A round is
    two aggregations and two joins on the node; a hub only ever meets one row of
    its minimum, so its links can be split over tasks.  Each round is a written
    table.  Links from a node to itself or to null are ignored; no links give
    no rows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct()
    edges, seen = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges, seen = stored(_round(edges), "links"), state


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.where("v > u").join(nearest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    ).distinct()
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.where("a <> b").union(lowest.select("a", F.col("m").alias("b"))).distinct()
