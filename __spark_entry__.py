"""Registered queries and, for each, independent SQL to check it against.

Flows are derived from ``lineitem`` (see ``flowlake.sources.samples``).  The SQL
below derives them again and writes addresses straight from the keys, so it
shares no decoding code with the Spark side.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.names import PROTOCOLS, SERVICES
from flowlake.functions.sizes import UNITS, readable_size
from flowlake.operators import distinct, flags
from flowlake.operators.decode import decode_flows, with_address_text
from flowlake.operators.rollup import fold, pair_totals, port_totals, totals_by_hour
from flowlake.operators.staging import stage_flows
from flowlake.plans import export, layout, marts, refresh, reports, retention
from flowlake.session import configure, scratch_path
from flowlake.sources.files import delete_path, read_exports, write_export, write_table
from flowlake.sources.samples import PORTS, PROTOS, sample_raw_flows
from flowlake.streaming.export import raw_stream, start_export
from flowlake.streaming.marts import start_marts

try:  # the optional part; errors inside it are not hidden
    from flowlake.llm import queries as llm_queries
except ImportError as missing:
    if missing.name not in ("flowlake", "flowlake.llm"):
        raise
    llm_queries = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("flowlake.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = None

AS_OF = date(2000, 1, 1)  # "today" of the reports that look back from a day
EPOCH_MICROS = 820_000_000_000_000  # keeps sums of moments small
EXPIRE_BEFORE = datetime(1998, 6, 1, 10, 30)
CUTOFF = "1998-01-15 00:00:00"  # orders have times at midnight, some of them this one


def _raw(spark: SparkSession, tables: str) -> DataFrame:
    return sample_raw_flows(configure(spark), tables)


def _decoded(spark: SparkSession, tables: str) -> DataFrame:
    return decode_flows(_raw(spark, tables))


def _flows(spark: SparkSession, tables: str) -> DataFrame:
    return stage_flows(_decoded(spark, tables))


def _on_flows(query: Callable[[DataFrame], DataFrame]):
    return lambda spark, tables: query(_flows(spark, tables))


def _on_raw(query: Callable[[DataFrame], DataFrame]):
    return lambda spark, tables: query(_raw(spark, tables))


def _remaining(raw: DataFrame) -> DataFrame:
    hexed = {name: F.hex(name) for name in ("sampler_address", "src_addr", "dst_addr")}
    return flags.remaining_flows(raw).withColumns(hexed)


def _marked(raw: DataFrame) -> DataFrame:
    by = flags.mark_flows(raw).groupBy("exported")
    return by.agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))


def _scan_count(spark: SparkSession, tables: str) -> DataFrame:
    return _decoded(spark, tables).agg(F.count(F.lit(1)).alias("rows"))


def _ipv6_forms(spark: SparkSession, tables: str) -> DataFrame:
    """Addresses hashed from order keys, with groups blanked in all patterns."""
    key = F.col("o_orderkey")
    digest = F.md5(key.cast("string"))
    pattern = key * 37 % 256
    groups = [
        F.when(F.shiftright(pattern, bit).bitwiseAND(1) == 1, F.lit("0000")).otherwise(
            F.substring(digest, 4 * bit + 1, 4)
        )
        for bit in range(8)
    ]
    digits = (
        F.when(key % 11 == 0, F.concat(F.lit("0" * 20 + "ffff"), F.substring(digest, 1, 8)))
        .when(key % 13 == 0, F.concat(F.lit("0" * 24), F.substring(digest, 1, 8)))
        .otherwise(F.concat(*groups))
    )
    orders = configure(spark).read.parquet(f"{tables}/orders.parquet")
    packed = orders.select("o_orderkey", F.unhex(digits).alias("address"))
    return with_address_text(packed, F.lit(34525), "address")


def _traffic_sizes(flows: DataFrame) -> DataFrame:
    """Volume of each conversation pair and of each source, as text."""
    pairs = pair_totals(flows)
    sources = pairs.groupBy("src_addr").agg(F.sum("bytes").alias("bytes"))
    return pairs.select(
        "src_addr", "dst_addr", readable_size(F.col("bytes")).alias("size")
    ).unionByName(
        sources.select(
            "src_addr", F.lit("(all)").alias("dst_addr"), readable_size(F.col("bytes")).alias("size")
        )
    )


def _export_stream(spark: SparkSession, tables: str) -> DataFrame:
    """Stream the raw files through the exporter, twice; then read the exports.

    The second run finds nothing new, so no row may show up twice.
    """
    target, checkpoint, landing = (
        scratch_path(spark, name) for name in ("exports", "checkpoint", "raw")
    )
    _raw(spark, tables).write.parquet(landing)
    for _ in range(2):
        start_export(raw_stream(spark, landing, max_files=4), target, checkpoint, once=True).awaitTermination()
    return read_exports(spark, target)


def _mart_refresh(spark: SparkSession, tables: str) -> DataFrame:
    """Export in two batches, refresh after each; every stored column in figures.

    The second refresh stages the second batch only, so what it publishes shows
    that old and new totals add up."""
    exports, root = scratch_path(spark, "exports"), scratch_path(spark, "marts")
    decoded = _decoded(spark, tables)
    first = F.col("time_received_ns") % 3 == 0
    for number, batch in enumerate((decoded.where(first), decoded.where(~first))):
        write_export(batch, exports, f"ipfix_decoded_{number}.parquet")
        stored = refresh.refresh_marts(spark, exports, root)
    figures = [_figures(name, table) for name, table in stored.items()]
    return reduce(DataFrame.unionByName, figures)


def _stream_marts(spark: SparkSession, tables: str) -> DataFrame:
    """Stream the raw files through the marts in three batches, the last repeated as
    after a crash before it was committed; every stored column in figures."""
    landing, target, root, checkpoint = (
        scratch_path(spark, name) for name in ("raw", "exports", "marts", "checkpoint")
    )
    lots = F.xxhash64("time_received_ns", "src_port")
    raw = _raw(spark, tables)
    for lot in range(3):
        part = raw.where(F.pmod(lots, F.lit(3)) == lot)
        part.coalesce(1).write.mode("append").parquet(landing)
    for last in (False, True):
        query = start_marts(raw_stream(spark, landing, max_files=1), target, root, checkpoint, once=True)
        query.awaitTermination()
        if not last:
            for name in ("commits/2", "commits/.2.crc"):
                delete_path(spark, f"{checkpoint}/{name}")
    names = ["overview_stats", *marts.ORDER]
    figures = [_figures(name, refresh.read_mart(spark, root, name)) for name in names]
    return reduce(DataFrame.unionByName, figures)


def _expired_flows(spark: SparkSession, tables: str) -> DataFrame:
    """Exports of which some lie wholly before a moment, some after and some on both
    sides; what expiry by event time leaves."""
    target, decoded = scratch_path(spark, "exports"), _decoded(spark, tables)
    mixed = F.col("bytes") % 16 == 0
    narrow = decoded.where(~mixed).repartitionByRange(8, "time_received_ns")
    write_export(narrow, target, "ipfix_decoded_narrow.parquet")
    write_export(decoded.where(mixed), target, "ipfix_decoded_mixed.parquet")
    retention.expire_flows(spark, target, EXPIRE_BEFORE, dry_run=False)
    return read_exports(spark, target)


def _mixed_writers(spark: SparkSession, tables: str) -> DataFrame:
    """Exports of two writers under one glob: one has unsigned counters and plain
    binary text."""
    target = scratch_path(spark, "mixed")
    decoded = _decoded(spark, tables)
    odd = F.col("bytes") % 2 == 1
    foreign = {name: F.col(name).cast("decimal(20,0)") for name in ("bytes", "packets", "time_received_ns")}
    foreign |= {name: F.col(name).cast("binary") for name in ("src_addr", "dst_addr")}
    write_export(decoded.where(odd).withColumns(foreign), target, "ipfix_foreign_0.parquet")
    write_export(decoded.where(~odd), target, "ipfix_decoded_0.parquet")
    return read_exports(spark, target)


def _export_batches(spark: SparkSession, tables: str) -> DataFrame:
    """Raw files that arrive in two lots, exported in two batches and a third run
    that finds nothing new."""
    raw, target, landing = _raw(spark, tables), scratch_path(spark, "exports"), scratch_path(spark, "raw")
    late = F.col("bytes") % 5 == 0
    for lot in (raw.where(~late), raw.where(late), None):
        if lot is not None:
            lot.write.mode("append").parquet(landing)
        export.run_export(spark, landing, target, scratch_path(spark, "rest"), dry_run=False)
    return read_exports(spark, target)


def _segments(flows: DataFrame) -> list[DataFrame]:
    """Flows as four refreshes might have found them, the last far larger."""
    part = F.xxhash64("received_at", "src_port") % 16
    return [flows.where(part == 0), flows.where(part == 1), flows.where(part == 2), flows.where((part < 0) | (part > 2))]


def _merged_matrix(spark: SparkSession, tables: str) -> DataFrame:
    """Totals per pair of each segment, written, then merged without adding all up."""
    build = refresh.TOTALS["pair_totals"]
    parts = [write_table(build(part, part), scratch_path(spark, "pairs")) for part in _segments(_flows(spark, tables))]
    return marts.merged_matrix(parts)


def _merged_recent(spark: SparkSession, tables: str) -> DataFrame:
    """Latest flows of each segment, written, then merged."""
    parts = [
        write_table(marts.recent_flows(part), scratch_path(spark, "latest")) for part in _segments(_flows(spark, tables))
    ]
    return marts.merged_recent(reduce(DataFrame.unionByName, parts))


def _from_bitmaps(spark: SparkSession, tables: str, mart: Callable[..., DataFrame]) -> DataFrame:
    """A mart from totals and bitmaps per hour; each segment numbers what is new in it."""
    numbered = configure(spark).createDataFrame([], distinct.ADDRESSES)
    hours, sides = [], {"src_addr": [], "dst_addr": []}
    for part in _segments(_flows(spark, tables)):
        new = write_table(distinct.unnumbered(part, numbered), scratch_path(spark, "new"))
        added = write_table(distinct.number_addresses(new, numbered), scratch_path(spark, "numbers"))
        numbered = numbered.unionByName(added)
        hours.append(totals_by_hour(part))
        for side, found in sides.items():
            found.append(write_table(distinct.hour_bitmaps(part, numbered, side), scratch_path(spark, "bits")))
    return mart(*[reduce(DataFrame.unionByName, rows) for rows in (hours, *sides.values())])


def _merged_talkers(spark: SparkSession, tables: str) -> DataFrame:
    """Sources and their peers from totals per pair alone."""
    parts = [
        write_table(pair_totals(part), scratch_path(spark, "pairs")) for part in _segments(_flows(spark, tables))
    ]
    pairs = reduce(DataFrame.unionByName, parts)
    return marts.top_talkers_by_bytes(pairs, fold(pairs, "src_addr"))


def _figures(mart: str, table: DataFrame) -> DataFrame:
    """Per column: rows, non-null values, and a sum of numbers, lengths or times."""
    figures = []
    for name, kind in table.dtypes:
        total = F.sum(F.length(name) if kind == "string" else name)
        if kind == "timestamp":  # summed as integers, exact in any order; the sum may pass a long
            moments = (F.unix_micros(name) - EPOCH_MICROS).cast("decimal(20,0)")
            total = F.sum(moments).cast("double") / 1000000.0
        total = F.coalesce(F.round(total.cast("double"), 3), F.lit(0.0))
        figures.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(name).alias("filled"),
                total.alias("total"),
            )
        )
    row = table.agg(F.count(F.lit(1)).alias("rows"), F.array(*figures).alias("figures"))
    return row.select(F.lit(mart).alias("mart"), "rows", F.inline("figures"))


def _compacted_days(spark: SparkSession, tables: str) -> DataFrame:
    """Lay the exports out by day, then report on the days kept by event time."""
    path = scratch_path(spark, "days")
    # Two runs that meet within the days, as if later exports were compacted later.
    layout.compact(_decoded(spark, tables), path, last=date(1998, 6, 1))
    layout.compact(_decoded(spark, tables), path, first=date(1998, 6, 1))
    kept = retention.keep_recent(stage_flows(layout.read_days(spark, path)), days=7, as_of=AS_OF)
    return layout.day_report(kept)


def _clustered_days(spark: SparkSession, tables: str) -> DataFrame:
    """Cluster the exports by time and addresses, then report on one source."""
    path = scratch_path(spark, "clustered")
    layout.compact(_decoded(spark, tables), path, by_address=True)
    flows = stage_flows(layout.read_days(spark, path))
    return layout.day_report(flows.where(F.col("src_addr") == flows.agg(F.min("src_addr")).scalar()))


def _listing(spark: SparkSession, tables: str) -> DataFrame:
    """A listing of files made of orders: dates as ages, prices as sizes; eight
    files to an entry, a table per priority, a partition per month."""
    orders = configure(spark).read.parquet(f"{tables}/orders.parquet")
    entry = F.concat(F.lit("/exports/ipfix_"), F.floor(F.col("o_orderkey") / 8), F.lit(".parquet"))
    day = F.date_format("o_orderdate", "yyyyMM'01'")
    return orders.select(
        F.concat(F.lit("/t"), F.col("o_custkey") % 5, F.lit("/day="), day, F.lit("/"), "o_orderkey").alias("path"),
        entry.alias("entry"),
        F.col("o_orderdate").cast("timestamp").alias("modified_at"),
        F.floor("o_totalprice").cast("bigint").alias("size_bytes"),
        F.col("o_custkey").alias("rows"),
    )


def _on_listing(query: Callable[[DataFrame], DataFrame]):
    return lambda spark, tables: query(_listing(spark, tables))


def _cutoff():
    return F.lit(CUTOFF).cast("timestamp")


def _lineitem_files(spark: SparkSession, tables: str) -> DataFrame:
    """The report over real files, less what depends on how they were written."""
    files = layout.file_rows(configure(spark), f"{tables}/lineitem.parquet")
    return layout.file_report(files, layout.entry_of_path()).select("partition", "rows")


def entry(spark: SparkSession) -> DataFrame:
    """Top talkers over the smallest test tables."""
    return marts.top_talkers_by_bytes(_flows(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _flow_queries()
    if llm_queries:
        found |= llm_queries.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _flow_sql()
    if llm_queries:
        found |= llm_queries.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _flow_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stg_flows": _flows,
        "overview_stats": _on_flows(marts.overview_stats),
        "top_talkers_by_bytes": _on_flows(marts.top_talkers_by_bytes),
        "top_destinations": _on_flows(marts.top_destinations),
        "top_ports": _on_flows(marts.top_ports),
        "protocol_breakdown": _on_flows(marts.protocol_breakdown),
        "traffic_by_hour": _on_flows(marts.traffic_by_hour),
        "traffic_matrix": _on_flows(marts.traffic_matrix),
        "recent_flows": _on_flows(marts.recent_flows),
        "hourly_traffic": _on_flows(lambda flows: reports.hourly_traffic_of(flows, AS_OF)),
        "top_convos": _on_flows(
            lambda flows: reports.top_conversations(marts.traffic_matrix(flows))
        ),
        "recent_flows_100": _on_flows(
            lambda flows: marts.recent_flows(flows, k=reports.LATEST_SHOWN)
        ),
        "top_sources_chart": _on_flows(
            lambda flows: reports.source_chart(marts.top_talkers_by_bytes(flows))
        ),
        "top_destinations_chart": _on_flows(
            lambda flows: reports.destination_chart(marts.top_destinations(flows))
        ),
        "top_services_chart": _on_flows(lambda flows: reports.service_chart(marts.top_ports(flows))),
        "decode_flows": _decoded,
        "decode_exported": _on_raw(flags.export_flows),
        "ipv6_forms": _ipv6_forms,
        "export_census": _on_raw(flags.export_census),
        "export_status": _on_raw(flags.export_status),
        "export_marked": _on_raw(_marked),
        "export_remaining": _on_raw(_remaining),
        "export_stream": _export_stream,
        "export_batches": _export_batches,
        "mixed_writers": _mixed_writers,
        "stream_marts": _stream_marts,
        "expired_flows": _expired_flows,
        "scan_count": _scan_count,
        "pair_totals": _on_flows(pair_totals),
        "port_totals": _on_flows(port_totals),
        "traffic_sizes": _on_flows(_traffic_sizes),
        "day_report": _on_flows(layout.day_report),
        "compacted_days": _compacted_days,
        "clustered_days": _clustered_days,
        "mart_refresh": _mart_refresh,
        "traffic_matrix_merged": _merged_matrix,
        "recent_flows_merged": _merged_recent,
        "top_talkers_merged": _merged_talkers,
        "traffic_by_hour_merged": lambda spark, tables: _from_bitmaps(spark, tables, marts.merged_hours),
        "overview_stats_merged": lambda spark, tables: _from_bitmaps(spark, tables, marts.merged_overview),
        "expired_files": _on_listing(lambda files: retention.expired_exports(files, _cutoff())),
        "retention_report": _on_listing(lambda files: retention.retention_report(files, _cutoff())),
        "file_report": _on_listing(lambda files: layout.file_report(files, layout.day_of_path())),
        "newest_files": _on_listing(layout.newest_files),
        "table_sizes": _on_listing(
            lambda files: layout.table_sizes(files, F.regexp_extract("path", "^/([^/]+)", 1))
        ),
        "lineitem_files": _lineitem_files,
    }


# --- SQL side ---------------------------------------------------------------


def _sql_names(names: dict[int, str]) -> str:
    return "MAP {" + ", ".join(f"{key}: '{name}'" for key, name in names.items()) + "}"


_RAW = f"""
raw AS (
    SELECT
        (l_orderkey % 10 = 0)::INT AS exported,
        l_linenumber::BIGINT AS line, l_suppkey AS supplier, l_partkey AS part,
        epoch_us(l_shipdate) * 1000
            + (l_orderkey % 86400) * 1000000000 + l_linenumber * 1700 AS time_received_ns,
        CASE l_linenumber WHEN 3 THEN 34525 WHEN 7 THEN 2054 ELSE 2048 END AS etype,
        {PROTOS}[(l_orderkey % {len(PROTOS)})::INT + 1]::INT AS proto,
        (l_orderkey % 1000 + 49152)::INT AS src_port,
        {PORTS}[(l_partkey % {len(PORTS)})::INT + 1]::INT AS dst_port,
        floor(l_extendedprice)::BIGINT AS bytes,
        l_quantity::BIGINT AS packets
    FROM lineitem
)"""

# Addresses as text straight from the keys.
_SHOWN = """
shown AS (
    SELECT *,
        CASE etype
            WHEN 2048 THEN concat('10.0.', supplier // 256, '.', supplier % 256)
            WHEN 34525 THEN '2001:db8::' || CASE supplier WHEN 0 THEN '' ELSE lower(to_hex(supplier)) END
            ELSE 'unknown' END AS src_addr,
        CASE etype
            WHEN 2048 THEN concat('10.1.', part // 256, '.', part % 256)
            WHEN 34525 THEN '2001:db8:1::' || CASE part WHEN 0 THEN '' ELSE lower(to_hex(part)) END
            ELSE 'unknown' END AS dst_addr
    FROM raw
)"""

_STAGED = """
staged AS (
    SELECT
        make_timestamp(round_even(time_received_ns / 1e9 * 1e6, 0)::BIGINT) AS received_at,
        date_trunc('hour', received_at) AS received_hour,
        date_trunc('day', received_at)::TIMESTAMP AS received_date,
        bytes, bytes / 1024.0::DOUBLE / 1024.0::DOUBLE / 1024.0::DOUBLE AS gb, packets,
        src_addr, dst_addr, src_port, dst_port, proto
    FROM shown
)"""


def _with(body: str, *parts: str) -> str:
    return f"WITH {', '.join(parts)} {body}"


def _staged(body: str) -> str:
    return _with(body, _RAW, _SHOWN, _STAGED)


def _mac(value: str) -> str:
    digits = f"lpad(to_hex({value}), 12, '0')"
    return f"regexp_replace({digits}, '(..)(..)(..)(..)(..)(..)', '\\1:\\2:\\3:\\4:\\5:\\6')"


def _decoded_sql(where: str = "") -> str:
    return _with(
        f"""
        SELECT
            CASE line WHEN 1 THEN NULL ELSE {_mac('supplier + 187649984430080')} END AS src_mac,
            CASE line WHEN 2 THEN NULL ELSE {_mac('part + 5497558138880')} END AS dst_mac,
            (line + 16)::INT AS tcp_flags,
            time_received_ns,
            time_received_ns - line * 1000000000 AS time_flow_start_ns,
            time_received_ns - 1000000 AS time_flow_end_ns,
            '192.168.0.1' AS sampler_address,
            src_addr, dst_addr,
            line::BIGINT AS in_if, (line + 1)::BIGINT AS out_if, 0::BIGINT AS ingress_vrf_id,
            (line + 100)::INT AS dot1q_vlan, (line + 200)::INT AS post_dot1q_vlan,
            0::INT AS dot1q_cvlan, 0::INT AS post_dot1q_cvlan,
            etype, proto, src_port, dst_port, bytes, packets,
            (line * 10)::BIGINT AS custom_integer_1, 0::BIGINT AS custom_integer_2
        FROM shown {where}""",
        _RAW,
        _SHOWN,
    )


_OVERVIEW = """
SELECT
    count(*) AS total_flows, sum(gb) AS total_gb,
    count(DISTINCT src_addr) AS unique_sources, count(DISTINCT dst_addr) AS unique_destinations,
    min(received_at) AS start_time, max(received_at) AS end_time
FROM staged"""

_TALKERS = """
SELECT
    src_addr, sum(bytes) / 1048576 AS mb, sum(packets)::BIGINT AS packets, count(*) AS flows,
    count(DISTINCT dst_addr) AS unique_dsts
FROM staged GROUP BY src_addr ORDER BY mb DESC, src_addr LIMIT {k}"""

_DESTINATIONS = """
SELECT
    dst_addr, sum(bytes) / 1048576 AS mb, count(*) AS flows,
    count(DISTINCT src_addr) AS unique_sources
FROM staged GROUP BY dst_addr ORDER BY mb DESC, dst_addr LIMIT {k}"""

_PORTS = f"""
SELECT
    dst_port, coalesce(({_sql_names(SERVICES)})[dst_port], dst_port::VARCHAR) AS service,
    count(*) AS connections, sum(bytes) / 1048576 AS mb
FROM staged GROUP BY dst_port ORDER BY connections DESC, dst_port LIMIT {{k}}"""

_PROTOCOLS = f"""
SELECT
    proto, coalesce(({_sql_names(PROTOCOLS)})[proto], concat('PROTO-', proto)) AS protocol_name,
    count(*) AS flows, sum(gb) AS gb
FROM staged GROUP BY proto"""

_HOURS = """
SELECT
    received_hour + INTERVAL 1 HOUR AS hour, sum(gb) AS total_gb, count(*) AS flow_count,
    avg(bytes) AS avg_bytes_per_flow,
    count(DISTINCT src_addr) AS unique_sources, count(DISTINCT dst_addr) AS unique_destinations
FROM staged GROUP BY received_hour"""

_MATRIX = """
SELECT src_addr, dst_addr, sum(bytes) / 1048576 AS mb, count(*) AS flows
FROM staged GROUP BY src_addr, dst_addr ORDER BY mb DESC, src_addr, dst_addr LIMIT {k}"""

_LATEST = """
SELECT received_at, src_addr, dst_addr, src_port, dst_port, proto, bytes, packets
FROM staged
ORDER BY received_at DESC, src_addr, dst_addr, src_port, dst_port, proto, bytes, packets
LIMIT {k}"""


def _totals(*keys: str) -> str:
    key = ", ".join(keys)
    return f"""
    SELECT {key}, count(*) AS flows, sum(bytes)::BIGINT AS bytes, sum(packets)::BIGINT AS packets,
        min(received_at) AS first_at, max(received_at) AS last_at
    FROM staged GROUP BY {key}"""


def _size_text(value: str) -> str:
    arms = [
        f"WHEN {value} < {1024 ** (power + 1)} THEN "
        f"printf('%.2f {unit}', round({value} / {1024**power}, 2))"
        for power, unit in enumerate(UNITS[:-1])
    ]
    return "CASE " + " ".join(arms) + " END"


def _days(where: str = "") -> str:
    return f"""
    SELECT strftime(received_at, '%Y%m%d') AS partition, count(*) AS rows,
        {_size_text("sum(bytes)")} AS traffic,
        min(received_at) AS oldest_row, max(received_at) AS newest_row
    FROM staged {where} GROUP BY 1"""


_SIZES = f"""
SELECT src_addr, coalesce(dst_addr, '(all)') AS dst_addr, {_size_text("sum(bytes)")} AS size
FROM staged GROUP BY GROUPING SETS ((src_addr, dst_addr), (src_addr))"""

_REMAINING = _with(
    """
    SELECT
        exported,
        CASE line WHEN 1 THEN 0 ELSE supplier + 187649984430080 END AS src_mac,
        CASE line WHEN 2 THEN 0 ELSE part + 5497558138880 END AS dst_mac,
        (line + 16)::INT AS tcp_flags,
        time_received_ns,
        time_received_ns - line * 1000000000 AS time_flow_start_ns,
        time_received_ns - 1000000 AS time_flow_end_ns,
        rpad('C0A80001', 32, '0') AS sampler_address,
        CASE line
            WHEN 3 THEN rpad('20010DB8', 24, '0') || lpad(to_hex(supplier), 8, '0')
            ELSE rpad('0A00' || lpad(to_hex(supplier), 4, '0'), 32, '0') END AS src_addr,
        CASE line
            WHEN 3 THEN rpad('20010DB80001', 24, '0') || lpad(to_hex(part), 8, '0')
            ELSE rpad('0A01' || lpad(to_hex(part), 4, '0'), 32, '0') END AS dst_addr,
        line::BIGINT AS in_if, (line + 1)::BIGINT AS out_if, 0::BIGINT AS ingress_vrf_id,
        (line + 100)::INT AS dot1q_vlan, (line + 200)::INT AS post_dot1q_vlan,
        0::INT AS dot1q_cvlan, 0::INT AS post_dot1q_cvlan,
        etype, proto, src_port, dst_port, bytes, packets,
        (line * 10)::BIGINT AS custom_integer_1, 0::BIGINT AS custom_integer_2
    FROM raw WHERE exported = 0""",
    _RAW,
)


def _zero_groups(count: int) -> str:
    return "(^|:)0" + ":0" * (count - 1) + "(:|$)"


_IPV6_SHORT = " ".join(
    f"WHEN regexp_matches(plain, '{_zero_groups(n)}') "
    f"THEN regexp_replace(plain, '{_zero_groups(n)}', '::')"
    for n in range(8, 1, -1)
)

_IPV6 = f"""
WITH digits AS (
    SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS digest,
        CASE
            WHEN o_orderkey % 11 = 0 THEN repeat('0', 20) || 'ffff' || digest[1:8]
            WHEN o_orderkey % 13 = 0 THEN repeat('0', 24) || digest[1:8]
            ELSE array_to_string(list_transform(range(8), lambda i:
                CASE WHEN (o_orderkey * 37 % 256) // (1 << i) % 2 = 1 THEN '0000'
                ELSE digest[4 * i + 1 : 4 * i + 4] END), '') END AS digits
    FROM orders
),
texts AS (
    SELECT o_orderkey, digits,
        array_to_string(list_transform(range(8), lambda i:
            regexp_replace(digits[4 * i + 1 : 4 * i + 4], '^0{{1,3}}', '')), ':') AS plain,
        array_to_string(list_transform(range(4), lambda i:
            ('0x' || digits[25 + 2 * i : 26 + 2 * i])::INT), '.') AS dotted
    FROM digits
)
SELECT o_orderkey,
    CASE
        WHEN starts_with(digits, repeat('0', 20) || 'ffff') THEN '::ffff:' || dotted
        WHEN starts_with(digits, repeat('0', 24)) AND digits[25:28] <> '0000' THEN '::' || dotted
        {_IPV6_SHORT}
        ELSE plain END AS address
FROM texts"""

# A mart's columns: T text, M moment, N number.
_MARTS = {
    "stg_flows": ("SELECT * FROM staged", "received_at:M received_hour:M received_date:M bytes:N gb:N packets:N src_addr:T dst_addr:T src_port:N dst_port:N proto:N"),
    "overview_stats": (_OVERVIEW, "total_flows:N total_gb:N unique_sources:N unique_destinations:N start_time:M end_time:M"),
    "top_talkers_by_bytes": (_TALKERS.format(k=100), "src_addr:T mb:N packets:N flows:N unique_dsts:N"),
    "top_destinations": (_DESTINATIONS.format(k=100), "dst_addr:T mb:N flows:N unique_sources:N"),
    "traffic_matrix": (_MATRIX.format(k=500), "src_addr:T dst_addr:T mb:N flows:N"),
    "top_ports": (_PORTS.replace("{k}", "50"), "dst_port:N service:T connections:N mb:N"),
    "protocol_breakdown": (_PROTOCOLS, "proto:N protocol_name:T flows:N gb:N"),
    "traffic_by_hour": (_HOURS, "hour:M total_gb:N flow_count:N avg_bytes_per_flow:N unique_sources:N unique_destinations:N"),
    "recent_flows": (_LATEST.format(k=50000), "received_at:M src_addr:T dst_addr:T src_port:N dst_port:N proto:N bytes:N packets:N"),
}
_SUMMED = {
    "T": "sum(length({}))",
    "M": f"sum(epoch_us({{}}) - {EPOCH_MICROS})::DOUBLE / 1000000",
    "N": "sum({})",
}


def _mart_figures() -> str:
    parts = []
    for mart, (query, columns) in _MARTS.items():
        for column in columns.split():
            name, kind = column.split(":")
            value = _SUMMED[kind].format(name)
            parts.append(
                f"SELECT '{mart}' AS mart, count(*) AS rows, '{name}' AS \"column\", count({name}) AS filled, "
                f"coalesce(round(({value})::DOUBLE, 3), 0) AS total FROM ({query})"
            )
    return " UNION ALL ".join(parts)


_LISTING = """
listing AS (
    SELECT
        concat('/t', o_custkey % 5, '/day=', strftime(o_orderdate, '%Y%m01'), '/', o_orderkey) AS path,
        concat('/exports/ipfix_', o_orderkey // 8, '.parquet') AS entry,
        o_orderdate::TIMESTAMP AS modified_at,
        floor(o_totalprice)::BIGINT AS size_bytes, o_custkey AS rows
    FROM orders
),
ages AS (
    SELECT entry, max(modified_at) AS modified_at, sum(size_bytes)::BIGINT AS size_bytes, count(*) AS files
    FROM listing GROUP BY entry
)"""


def _listed(body: str) -> str:
    return _with(body, _LISTING)


def _parts(key: str, order: str) -> str:
    return f"""
    SELECT {key}, {_size_text("sum(size_bytes)")} AS size, sum(rows)::BIGINT AS rows, count(*) AS parts,
    {order} FROM listing GROUP BY 1"""


def _flow_sql() -> dict[str, str]:
    return {
        "stg_flows": _staged("SELECT * FROM staged"),
        "overview_stats": _staged(_OVERVIEW),
        "top_talkers_by_bytes": _staged(_TALKERS.format(k=100)),
        "top_destinations": _staged(_DESTINATIONS.format(k=100)),
        "top_ports": _staged(_PORTS.replace("{k}", "50")),
        "protocol_breakdown": _staged(_PROTOCOLS),
        "traffic_by_hour": _staged(_HOURS),
        "traffic_matrix": _staged(_MATRIX.format(k=500)),
        "recent_flows": _staged(_LATEST.format(k=50000)),
        "hourly_traffic": _staged(
            f"SELECT * FROM ({_HOURS}) WHERE hour >= DATE '{AS_OF}' - INTERVAL 7 DAY"
        ),
        "top_convos": _staged(_MATRIX.format(k=20)),
        "recent_flows_100": _staged(_LATEST.format(k=100)),
        "top_sources_chart": _staged(f"SELECT src_addr, mb FROM ({_TALKERS.format(k=20)})"),
        "top_destinations_chart": _staged(
            f"SELECT dst_addr, mb FROM ({_DESTINATIONS.format(k=20)})"
        ),
        "top_services_chart": _staged(f"SELECT service, mb FROM ({_PORTS.replace('{k}', '20')})"),
        "decode_flows": _decoded_sql(),
        "decode_exported": _decoded_sql("WHERE exported = 1"),
        "ipv6_forms": _IPV6,
        "export_census": _with(
            """SELECT count(*) FILTER (exported = 0) AS unexported_rows,
                count(*) FILTER (exported = 1) AS exported_rows, count(*) AS total_rows FROM raw""",
            _RAW,
        ),
        "export_status": _with(
            """SELECT concat('Rows to export: ', count(*)) AS status FROM raw WHERE exported = 0
            UNION ALL SELECT concat('Rows marked: ', count(*)) FROM raw WHERE exported IN (0, 1)""",
            _RAW,
        ),
        "export_marked": _with(
            "SELECT 1 AS exported, count(*) AS rows, sum(bytes)::BIGINT AS bytes FROM raw", _RAW
        ),
        "export_remaining": _REMAINING,
        "export_stream": _decoded_sql(),
        "export_batches": _decoded_sql(),
        "mixed_writers": _decoded_sql(),
        "stream_marts": _staged(f"SELECT * FROM ({_mart_figures()}) WHERE mart <> 'stg_flows'"),
        "expired_flows": _decoded_sql(
            "WHERE make_timestamp(round_even(time_received_ns / 1e9 * 1e6, 0)::BIGINT)"
            f" >= TIMESTAMP '{EXPIRE_BEFORE}'"
        ),
        "scan_count": "SELECT count(*) AS rows FROM lineitem",
        "pair_totals": _staged(_totals("src_addr", "dst_addr")),
        "port_totals": _staged(_totals("dst_port", "proto")),
        "traffic_sizes": _staged(_SIZES),
        "day_report": _staged(_days()),
        "compacted_days": _staged(_days(f"WHERE received_at >= DATE '{AS_OF}' - INTERVAL 7 DAY")),
        "clustered_days": _staged(_days("WHERE src_addr = (SELECT min(src_addr) FROM staged)")),
        "mart_refresh": _staged(_mart_figures()),
        "traffic_matrix_merged": _staged(_MATRIX.format(k=500)),
        "recent_flows_merged": _staged(_LATEST.format(k=50000)),
        "top_talkers_merged": _staged(_TALKERS.format(k=100)),
        "traffic_by_hour_merged": _staged(_HOURS),
        "overview_stats_merged": _staged(_OVERVIEW),
        "expired_files": _listed(f"SELECT * FROM ages WHERE modified_at < TIMESTAMP '{CUTOFF}'"),
        "retention_report": _listed(
            f"""SELECT count(*) AS files_checked,
                count(*) FILTER (modified_at < TIMESTAMP '{CUTOFF}') AS files_deleted,
                coalesce(sum(size_bytes) FILTER (modified_at < TIMESTAMP '{CUTOFF}'), 0)::BIGINT AS bytes_freed,
                5 AS retention_days FROM ages"""
        ),
        "file_report": _listed(
            _parts(
                "path.split('/')[3][5:] AS partition",
                "min(modified_at) AS oldest_part, max(modified_at) AS newest_part",
            )
        ),
        "newest_files": _listed(
            f"""SELECT path, rows, {_size_text("size_bytes")} AS size, modified_at
            FROM listing ORDER BY modified_at DESC, path LIMIT 20"""
        ),
        "table_sizes": _listed(
            _parts('path.split(\'/\')[2] AS "table"', "sum(size_bytes)::BIGINT AS size_bytes")
        ),
        "lineitem_files": "SELECT 'lineitem.parquet' AS partition, count(*) AS rows FROM lineitem",
    }
