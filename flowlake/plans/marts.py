"""The marts: one function per dashboard table, staged flows in, table out.

Rows that compare equal on a mart's ranking are ordered by the remaining key
columns, so a cap keeps the same rows in every run.  Functions that work on
per-key totals also accept these ready-made, which is how a refresh shares them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.names import protocol_name, service_name
from flowlake.functions.sizes import gigabytes, megabytes
from flowlake.functions.times import bucket_end
from flowlake.operators.distinct import merged_count
from flowlake.operators.rollup import (
    destination_totals,
    hour_totals,
    pair_totals,
    roll_up,
    source_totals,
)
from flowlake.operators.topk import latest_rows, top_rows, top_sums

# Row caps.
TALKERS = 100
DESTINATIONS = 100
PORTS = 50
PAIRS = 500
LATEST = 50_000

# Ranking of each mart ("-" is descending), then its tie-breaks.  Files have no
# row order, so marts that have no cap come unsorted, and readers sort by this.
ORDER = {
    "top_talkers_by_bytes": ("-mb", "src_addr"),
    "top_destinations": ("-mb", "dst_addr"),
    "top_ports": ("-connections", "dst_port"),
    "protocol_breakdown": ("-flows", "proto"),
    "traffic_by_hour": ("hour",),
    "traffic_matrix": ("-mb", "src_addr", "dst_addr"),
    "recent_flows": (
        "-received_at",
        "src_addr",
        "dst_addr",
        "src_port",
        "dst_port",
        "proto",
        "bytes",
        "packets",
    ),
}


def order_of(mart: str) -> list[Column]:
    """Sort columns of a mart; nulls come last in either direction."""
    return [
        F.desc_nulls_last(name[1:]) if name.startswith("-") else F.asc_nulls_last(name)
        for name in ORDER[mart]
    ]


def overview_stats(
    flows: DataFrame, sources: DataFrame | None = None, destinations: DataFrame | None = None
) -> DataFrame:
    """One row of totals.

    One pass per address column; the two passes read different columns.  Two
    distinct counts in a single aggregate would triple every row instead.
    """
    sources = source_totals(flows) if sources is None else sources
    destinations = destination_totals(flows) if destinations is None else destinations
    return sources.agg(
        # The sum of no counts is null, their number 0.
        F.coalesce(F.sum("flows"), F.lit(0).cast("bigint")).alias("total_flows"),
        gigabytes(F.sum("bytes")).alias("total_gb"),
        F.count("src_addr").alias("unique_sources"),
        F.min("first_at").alias("start_time"),
        F.max("last_at").alias("end_time"),
    ).select(
        "total_flows",
        "total_gb",
        "unique_sources",
        destinations.agg(F.count("dst_addr")).scalar().alias("unique_destinations"),
        "start_time",
        "end_time",
    )


def merged_overview(hours: DataFrame, sources: DataFrame, destinations: DataFrame) -> DataFrame:
    """``overview_stats`` from totals per hour and bitmaps of addresses per hour, of
    which there may be several rows per hour."""
    return hours.agg(
        F.coalesce(F.sum("flows"), F.lit(0).cast("bigint")).alias("total_flows"),
        gigabytes(F.sum("bytes")).alias("total_gb"),
        F.min("first_at").alias("start_time"),
        F.max("last_at").alias("end_time"),
    ).select(
        "total_flows",
        "total_gb",
        merged_count(sources, "unique_sources").scalar().alias("unique_sources"),
        merged_count(destinations, "unique_destinations").scalar().alias("unique_destinations"),
        "start_time",
        "end_time",
    )


def _with_peers(flows: DataFrame, top: DataFrame, mart: str, peer: str, name: str) -> DataFrame:
    """Add to each top row the number of distinct ``peer`` values of its key.

    Distinct values are costly, so they are counted for the winners only, in a
    second scan of two columns, of flows or of totals per pair.  Spark knows the cap
    and broadcasts the winners while they are few; then rows stay in their task, are deduplicated there, and
    the rows of one hot key spread over the partitions by peer.
    """
    key = ORDER[mart][-1]
    winners = top.withColumnRenamed(key, "_key")
    return (
        flows.select(key, peer)
        .join(winners, F.col(key).eqNullSafe(F.col("_key")))
        .groupBy(*top.columns)
        .agg(F.countDistinct(peer).alias(name))
    )


def top_talkers_by_bytes(
    flows: DataFrame, sources: DataFrame | None = None, k: int = TALKERS
) -> DataFrame:
    order = order_of("top_talkers_by_bytes")
    totals = (source_totals(flows) if sources is None else sources).select(
        "src_addr", megabytes(F.col("bytes")).alias("mb"), "packets", "flows"
    )
    top = top_rows(totals, order, k)
    counted = _with_peers(flows, top, "top_talkers_by_bytes", "dst_addr", "unique_dsts")
    return counted.orderBy(*order).limit(k)


def top_destinations(
    flows: DataFrame, destinations: DataFrame | None = None, k: int = DESTINATIONS
) -> DataFrame:
    order = order_of("top_destinations")
    totals = (destination_totals(flows) if destinations is None else destinations).select(
        "dst_addr", megabytes(F.col("bytes")).alias("mb"), "flows"
    )
    top = top_rows(totals, order, k)
    counted = _with_peers(flows, top, "top_destinations", "src_addr", "unique_sources")
    return counted.orderBy(*order).limit(k)


def traffic_matrix(flows: DataFrame, k: int = PAIRS) -> DataFrame:
    pairs = pair_totals(flows).select(
        "src_addr", "dst_addr", megabytes(F.col("bytes")).alias("mb"), "flows"
    )
    return top_rows(pairs, order_of("traffic_matrix"), k)


def merged_matrix(pairs: list[DataFrame], k: int = PAIRS) -> DataFrame:
    """``traffic_matrix`` from totals per pair of several parts, see ``top_sums``."""
    kept = [part.select("src_addr", "dst_addr", "bytes", "flows") for part in pairs]
    order = [F.desc_nulls_last("bytes"), *order_of("traffic_matrix")[1:]]
    top = top_sums(kept, ["src_addr", "dst_addr"], "bytes", order, k)
    return top.select("src_addr", "dst_addr", megabytes(F.col("bytes")).alias("mb"), "flows")


def top_ports(flows: DataFrame, ports: DataFrame | None = None, k: int = PORTS) -> DataFrame:
    """Busiest destination ports; the service is looked up for the kept rows only."""
    return (
        (roll_up(flows, "dst_port") if ports is None else ports)
        .groupBy("dst_port")
        .agg(F.sum("flows").alias("connections"), megabytes(F.sum("bytes")).alias("mb"))
        .orderBy(*order_of("top_ports"))
        .limit(k)
        .select("dst_port", service_name(F.col("dst_port")).alias("service"), "connections", "mb")
    )


def protocol_breakdown(flows: DataFrame, ports: DataFrame | None = None) -> DataFrame:
    return (
        (roll_up(flows, "proto") if ports is None else ports)
        .groupBy("proto")
        .agg(F.sum("flows").alias("flows"), gigabytes(F.sum("bytes")).alias("gb"))
        .select("proto", protocol_name(F.col("proto")).alias("protocol_name"), "flows", "gb")
    )


def traffic_by_hour(
    flows: DataFrame, by_source: DataFrame | None = None, by_destination: DataFrame | None = None
) -> DataFrame:
    """Totals per hour, labelled by the end of the hour.

    From totals per (hour, address), of which there may be several rows: one pass
    per address column, and an hour with a third of all flows is spread over the
    partitions; what meets per hour afterwards is one row per task.
    """
    by_source = hour_totals(flows, "src_addr") if by_source is None else by_source
    by_destination = hour_totals(flows, "dst_addr") if by_destination is None else by_destination
    by_source = (
        by_source.groupBy("received_hour", "src_addr")
        .agg(*[F.sum(name).alias(name) for name in ("flows", "bytes", "sized")])
        .groupBy("received_hour")
        .agg(
            *[F.sum(name).alias(name) for name in ("flows", "bytes", "sized")],
            F.count("src_addr").alias("sources"),
        )
    )
    by_destination = (
        by_destination.select("received_hour", "dst_addr")
        .distinct()
        .groupBy("received_hour")
        .agg(F.count("dst_addr").alias("destinations"))
    )
    return _hours(by_source, by_destination)


def merged_hours(hours: DataFrame, sources: DataFrame, destinations: DataFrame) -> DataFrame:
    """``traffic_by_hour`` from totals per hour and bitmaps of addresses per hour, of
    which there may be several rows per hour."""
    totals = hours.groupBy("received_hour").agg(*[F.sum(name).alias(name) for name in ("flows", "bytes", "sized")])
    return _hours(
        totals,
        merged_count(sources, "sources", "received_hour"),
        merged_count(destinations, "destinations", "received_hour"),
    )


def _hours(*sides: DataFrame) -> DataFrame:
    # Each side has an hour once; null hours meet as well, unlike in a join.
    names = ("flows", "bytes", "sized", "sources", "destinations")
    return (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
        .groupBy("received_hour")
        .agg(*[F.max(name).alias(name) for name in names])
        .select(
            bucket_end(F.col("received_hour")).alias("hour"),
            gigabytes(F.col("bytes")).alias("total_gb"),
            F.col("flows").alias("flow_count"),
            # Exact integer sum over count; avg() would add doubles in task order.
            F.try_divide("bytes", "sized").alias("avg_bytes_per_flow"),
            # An hour may have no address on one side.
            F.coalesce("sources", F.lit(0)).alias("unique_sources"),
            F.coalesce("destinations", F.lit(0)).alias("unique_destinations"),
        )
    )


def recent_flows(flows: DataFrame, k: int = LATEST) -> DataFrame:
    columns = [name.lstrip("-") for name in ORDER["recent_flows"]]
    return latest_rows(flows, order_of("recent_flows"), k).select(*columns)


def merged_recent(latest: DataFrame, k: int = LATEST) -> DataFrame:
    """``recent_flows`` from those of several parts: no other flow can be among them."""
    return top_rows(latest, order_of("recent_flows"), k)
