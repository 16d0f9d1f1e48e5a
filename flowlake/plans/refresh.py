"""Refresh of the staging table, the shared totals and all marts.

Exports are staged once, in segments: a segment holds the exports that were new
at one refresh, and what the marts need of them, in a form that adds up: totals
per pair, hour and port, bitmaps of the addresses of each hour, its latest flows.
A refresh stages what is new, stages again the rest of segments that lost an
export, and leaves all others as they are, save that eight segments of a like size
become one by adding up their tables, so that their number stays small.  Marts are built from these tables of
all segments; the staged flows of old segments are not read again.

Addresses are numbered once, for the bitmaps; a version has the whole numbering.

Everything goes to folders of its own.  A version is published at the end by one
empty marker; readers follow the latest marker, so they see the old tables until
the new ones are complete, and keep them if a refresh fails.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators.distinct import (
    ADDRESSES,
    hour_bitmaps,
    merged_bitmaps,
    number_addresses,
    unnumbered,
)
from flowlake.operators.rollup import fold, fold_hours, pair_totals, port_totals, totals_by_hour
from flowlake.operators.staging import stage_flows
from flowlake.plans import marts, reports
from flowlake.sources.files import (
    delete_path,
    list_files,
    list_names,
    make_folder,
    read_decoded,
    write_table,
)

# Jobs submitted side by side; a small mart leaves most of a cluster idle.
SIDE_BY_SIDE = 4

# Tables of a segment from its staged flows and the numbered addresses.  Pairs with
# the most bytes come first in their files, see ``top_sums``.
TOTALS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "pair_totals": lambda flows, _: pair_totals(flows).sortWithinPartitions(F.desc_nulls_last("bytes")),
    "hour_totals": lambda flows, _: totals_by_hour(flows),
    "port_totals": lambda flows, _: port_totals(flows),
    "hour_sources": lambda flows, numbered: hour_bitmaps(flows, numbered, "src_addr"),
    "hour_destinations": lambda flows, numbered: hour_bitmaps(flows, numbered, "dst_addr"),
    "latest_flows": lambda flows, _: marts.recent_flows(flows),
}

# Tables of a segment from its totals per pair.
FOLDED = {"source_totals": "src_addr", "destination_totals": "dst_addr"}

# How the tables of segments become those of one segment of all their flows.
MERGED: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stg_flows": lambda rows: rows,
    "pair_totals": lambda rows: fold(rows, "src_addr", "dst_addr").sortWithinPartitions(F.desc_nulls_last("bytes")),
    "hour_totals": fold_hours,
    "port_totals": lambda rows: fold(rows, "dst_port", "proto"),
    "hour_sources": merged_bitmaps,
    "hour_destinations": merged_bitmaps,
    "latest_flows": marts.merged_recent,
    **{name: lambda rows, key=key: fold(rows, key) for name, key in FOLDED.items()},
}

# Segments of about one size that become one, and the most exports a merged one may
# hold: what is staged again when the oldest of them expires.
FAN_IN, MOST_EXPORTS = 8, 64

MANIFEST = "segment string, entry string, stamp long"


def build_marts(decoded: DataFrame, root: str) -> dict[str, DataFrame]:
    """Build and publish every table under ``root`` from the decoded flows alone.

    Addresses are numbered anew."""
    spark = decoded.sparkSession
    segment = _stage(decoded, root, spark.createDataFrame([], ADDRESSES))
    return _publish(spark, root, spark.createDataFrame([(segment, None, None)], MANIFEST), [segment], None)


def refresh_marts(spark: SparkSession, export_root: str, root: str) -> dict[str, DataFrame]:
    """Bring the tables under ``root`` up to the exports now under ``export_root``.

    Reads only exports that are new, or changed, or share a segment with one that
    is gone.  The driver sees one row per export.  Numbers of addresses that are gone
    are kept, as they cost a row each, until the tables are built anew.
    """
    stamp = F.bit_xor(F.xxhash64("path", "size_bytes", "modified_at"))
    listed = {
        (row.entry, row.stamp)
        for row in list_files(spark, export_root).groupBy("entry").agg(stamp.alias("stamp")).collect()
    }
    segments: dict[str, set] = {}
    for row in _manifest(spark, root).collect():
        segments.setdefault(row.segment, set()).add((row.entry, row.stamp))
    kept = {name: exports for name, exports in segments.items() if exports <= listed}
    waiting = listed.difference(*kept.values())
    numbered, added = _numbered(spark, root), []
    if waiting:
        decoded = read_decoded(spark, *sorted(entry for entry, _ in waiting))
        added = [_stage(decoded, root, spark.createDataFrame([], ADDRESSES) if numbered is None else numbered)]
        kept[added[0]] = waiting
    if not kept:
        raise ValueError(f"no exports under {export_root}")
    for names in _mergeable(kept):
        merged = _merge(spark, root, names)
        kept[merged] = set().union(*[kept.pop(name) for name in names])
    rows = [(name, entry, mark) for name, exports in kept.items() for entry, mark in sorted(exports)]
    return _publish(spark, root, spark.createDataFrame(rows, MANIFEST), added, numbered)


def _numbered(spark: SparkSession, root: str) -> DataFrame | None:
    """Numbered addresses of the latest version, if its segments use them."""
    found = versions(spark, root)
    if not found or _manifest(spark, root).isEmpty():
        return None
    return spark.read.schema(ADDRESSES).parquet(f"{root}/{found[-1]}/addresses")


def _stage(decoded: DataFrame, root: str, numbered: DataFrame) -> str:
    """Write a segment; its totals start from the written flows."""
    spark = decoded.sparkSession
    segment = f"segments/{uuid.uuid4().hex}"
    folder = f"{root}/{segment}"
    flows = write_table(stage_flows(decoded), f"{folder}/stg_flows")
    new = write_table(unnumbered(flows, numbered), f"{folder}/new_addresses")
    added = write_table(number_addresses(new, numbered), f"{folder}/addresses")
    delete_path(spark, f"{folder}/new_addresses")
    every = numbered.unionByName(added)
    totals = _side_by_side({name: (build(flows, every), f"{folder}/{name}") for name, build in TOTALS.items()})
    _side_by_side({name: (fold(totals["pair_totals"], key), f"{folder}/{name}") for name, key in FOLDED.items()})
    return segment


def _mergeable(segments: dict[str, set]) -> list[list[str]]:
    """Groups of ``FAN_IN`` segments to merge: of a like number of exports, by powers
    of ``FAN_IN``, and adjacent by name, so that they are of a like age.

    A merged segment holds ``MOST_EXPORTS`` at most, so n exports staged one by one
    end up in about n / ``MOST_EXPORTS`` segments and a few small ones, and every
    flow is rewritten as often as there are powers below that number.
    """
    sizes: dict[int, list[str]] = {}
    for name in sorted(segments, key=lambda name: min(segments[name])):
        sizes.setdefault(math.floor(math.log(len(segments[name]), FAN_IN) + 1e-9), []).append(name)
    groups = [names[at : at + FAN_IN] for names in sizes.values() for at in range(0, len(names), FAN_IN)]
    return [
        names for names in groups if len(names) == FAN_IN and sum(len(segments[name]) for name in names) <= MOST_EXPORTS
    ]


def _merge(spark: SparkSession, root: str, names: list[str]) -> str:
    """Write one segment with what ``names`` hold; nothing is computed from flows."""
    segment = f"segments/{uuid.uuid4().hex}"

    def merged(table: str) -> DataFrame:
        return MERGED[table](
            reduce(DataFrame.unionByName, [spark.read.parquet(f"{root}/{name}/{table}") for name in names])
        )

    _side_by_side({table: (merged(table), f"{root}/{segment}/{table}") for table in MERGED})
    return segment


def _side_by_side(tables: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return dict(zip(tables, pool.map(lambda table: write_table(*table), tables.values()), strict=True))


def _publish(
    spark: SparkSession, root: str, manifest: DataFrame, added: list[str], numbered: DataFrame | None
) -> dict[str, DataFrame]:
    before = versions(spark, root)
    version = f"v{int(before[-1][1:]) + 1 if before else 1:010d}"
    folder = f"{root}/{version}"
    delete_path(spark, folder)  # left over by a refresh that failed
    manifest = write_table(manifest.coalesce(1), f"{folder}/manifest")
    segments = sorted(row.segment for row in manifest.select("segment").distinct().collect())

    def parts(name: str) -> list[DataFrame]:
        return [spark.read.parquet(f"{root}/{segment}/{name}") for segment in segments]

    def all_of(name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, parts(name))

    numbers = [spark.read.schema(ADDRESSES).parquet(f"{root}/{segment}/addresses") for segment in added]
    numbers = [*([] if numbered is None else [numbered]), *numbers]
    flows, pairs, ports = all_of("stg_flows"), all_of("pair_totals"), all_of("port_totals")
    hours, sources, destinations = (all_of(f"hour_{name}") for name in ("totals", "sources", "destinations"))
    by_source, by_destination = (fold(all_of(name), key) for name, key in FOLDED.items())
    tables = {
        "addresses": reduce(DataFrame.unionByName, numbers),
        "traffic_matrix": marts.merged_matrix(parts("pair_totals")),
        "recent_flows": marts.merged_recent(all_of("latest_flows")),
        "top_talkers_by_bytes": marts.top_talkers_by_bytes(pairs, by_source),
        "top_destinations": marts.top_destinations(pairs, by_destination),
        "traffic_by_hour": marts.merged_hours(hours, sources, destinations),
        "overview_stats": marts.merged_overview(hours, sources, destinations),
        "top_ports": marts.top_ports(flows, ports),
        "protocol_breakdown": marts.protocol_breakdown(flows, ports),
    }
    stored = _side_by_side({name: (table, f"{folder}/{name}") for name, table in tables.items()})
    make_folder(spark, f"{root}/published/{version}")
    del stored["addresses"]
    return {"stg_flows": flows, **stored}


def versions(spark: SparkSession, root: str) -> list[str]:
    """Published versions, oldest first."""
    return sorted(list_names(spark, f"{root}/published/v*"))


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    found = versions(spark, root)
    if not found:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/{found[-1]}/manifest").where("entry IS NOT NULL")


def clear_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` latest versions, and segments only those used.

    Not part of a refresh: a reader may still be at work on an older version.
    """
    found = versions(spark, root)
    old, kept = found[: max(0, len(found) - keep)], found[max(0, len(found) - keep) :]
    used = set()
    for version in kept:
        rows = spark.read.schema(MANIFEST).parquet(f"{root}/{version}/manifest").select("segment").distinct()
        used |= {row.segment for row in rows.collect()}
    for version in old:
        delete_path(spark, f"{root}/published/{version}")
        delete_path(spark, f"{root}/{version}")
    unused = {f"segments/{name}" for name in list_names(spark, f"{root}/segments/*")} - used
    return [path for path in [*old, *sorted(unused)] if path in old or delete_path(spark, f"{root}/{path}")]


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart of the latest version, in its own row order."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing published under {root}")
    table = spark.read.parquet(f"{root}/{found[-1]}/{name}")
    return table.orderBy(*marts.order_of(name)) if name in marts.ORDER else table


def dashboard(
    spark: SparkSession, root: str, as_of: date | None = None
) -> dict[str, DataFrame]:
    """Everything the dashboard page shows, from stored marts."""
    names = [
        "overview_stats",
        "top_talkers_by_bytes",
        "top_destinations",
        "top_ports",
        "protocol_breakdown",
    ]
    tables = {name: read_mart(spark, root, name) for name in names}
    hours = read_mart(spark, root, "traffic_by_hour")
    return {
        **tables,
        "hourly_traffic": reports.hourly_traffic(hours, as_of),
        "top_convos": reports.top_conversations(read_mart(spark, root, "traffic_matrix")),
        "recent_flows": reports.latest_flows(read_mart(spark, root, "recent_flows")),
        "top_sources_chart": reports.source_chart(tables["top_talkers_by_bytes"]),
        "top_destinations_chart": reports.destination_chart(tables["top_destinations"]),
        "top_services_chart": reports.service_chart(tables["top_ports"]),
    }
