"""Additive totals per key.

Several marts are read off the same totals: a refresh writes those per source,
per destination and per port once.  Totals per pair are not shared, as there may
be nearly as many pairs as flows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def roll_up(flows: DataFrame, *keys: str) -> DataFrame:
    """Totals of staged flows per key.

    Sums stay integers: exact in any order of addition, whereas a double sum
    would depend on task order.  Map-side partial aggregation shrinks a hot key
    to one row per task before the shuffle.  Totals nobody reads are pruned.
    """
    return flows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("bytes").alias("bytes"),
        F.sum("packets").alias("packets"),
        F.min("received_at").alias("first_at"),
        F.max("received_at").alias("last_at"),
    )


def hour_totals(flows: DataFrame, address: str) -> DataFrame:
    """Totals per (hour, address); ``sized`` counts the rows that have a size."""
    return flows.groupBy("received_hour", address).agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("bytes").alias("bytes"),
        F.sum("packets").alias("packets"),
        F.count("bytes").alias("sized"),
        F.min("received_at").alias("first_at"),
        F.max("received_at").alias("last_at"),
    )


def fold(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals per key from totals per finer key."""
    return totals.groupBy(*keys).agg(
        F.sum("flows").alias("flows"),
        F.sum("bytes").alias("bytes"),
        F.sum("packets").alias("packets"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


def source_totals(flows: DataFrame) -> DataFrame:
    return roll_up(flows, "src_addr")


def destination_totals(flows: DataFrame) -> DataFrame:
    return roll_up(flows, "dst_addr")


def pair_totals(flows: DataFrame) -> DataFrame:
    """Per (source, destination)."""
    return roll_up(flows, "src_addr", "dst_addr")


def port_totals(flows: DataFrame) -> DataFrame:
    """Per (destination port, protocol): at most 65,536 x 256 rows."""
    return roll_up(flows, "dst_port", "proto")


def totals_by_hour(flows: DataFrame) -> DataFrame:
    """Totals per hour; ``sized`` counts the rows that have a size."""
    return flows.groupBy("received_hour").agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("bytes").alias("bytes"),
        F.count("bytes").alias("sized"),
        F.min("received_at").alias("first_at"),
        F.max("received_at").alias("last_at"),
    )


def fold_hours(totals: DataFrame) -> DataFrame:
    """``totals_by_hour`` from those of several parts."""
    return totals.groupBy("received_hour").agg(
        F.sum("flows").alias("flows"),
        F.sum("bytes").alias("bytes"),
        F.sum("sized").alias("sized"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )
