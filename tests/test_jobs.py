"""Export, retention, layout and refresh jobs on scratch folders."""

import os
import re
import time
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowlake.operators import flags
from flowlake.operators.decode import decode_flows
from flowlake.operators.staging import stage_flows
from flowlake.plans import export, layout, marts, refresh, reports, retention
from flowlake.plans.analytics import run_analytics
from flowlake.schema import DECODED, RAW, STAGED
from flowlake.sources import files as io
from flowlake.sources.files import write_table
from flowlake.sources.samples import sample_raw_flows
from flowlake.sources import footers
from flowlake.streaming.export import raw_stream, start_export
from flowlake.streaming.marts import start_marts

TABLES = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 10, 12, 0, 0)


@pytest.fixture(scope="module")
def raw(spark):
    return sample_raw_flows(spark, TABLES).limit(2000).cache()


def sums(df):
    row = df.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum(F.xxhash64(*df.columns) % 1000003)).first()
    return tuple(row)


# --- sources -----------------------------------------------------------------


def foreign_file(path, counter):
    """A file whose writer used unsigned types and left text unannotated."""
    table = pa.table(
        {
            "src_mac": pa.array([None], pa.string()),
            "dst_mac": pa.array(["00:00:00:00:00:01"]),
            "tcp_flags": pa.array([2], pa.uint16()),
            "time_received_ns": pa.array([1_700_000_000_000_000_500], pa.uint64()),
            "time_flow_start_ns": pa.array([1], pa.uint64()),
            "time_flow_end_ns": pa.array([2], pa.uint64()),
            "sampler_address": pa.array([b"192.168.0.1"], pa.binary()),
            "src_addr": pa.array([b"10.0.0.1"], pa.binary()),
            "dst_addr": pa.array([b"unknown"], pa.binary()),
            **{
                name: pa.array([7], pa.uint32())
                for name in DECODED.names[9:20]
            },
            "bytes": pa.array([counter], pa.uint64()),
            "packets": pa.array([3], pa.uint64()),
            "custom_integer_1": pa.array([0], pa.uint64()),
            "custom_integer_2": pa.array([0], pa.uint64()),
        }
    )
    pq.write_table(table, path)


def test_foreign_types_are_cast(spark, tmp_path):
    foreign_file(tmp_path / "ipfix_decoded_20240101_000000.parquet", 1500)
    flows = io.read_exports(spark, str(tmp_path))
    assert flows.schema.simpleString() == DECODED.simpleString()
    row = stage_flows(flows).first()
    assert (row.src_addr, row.dst_addr, row.bytes) == ("10.0.0.1", "unknown", 1500)
    assert stage_flows(flows).schema.simpleString() == STAGED.simpleString()


def test_counter_beyond_long_raises(spark, tmp_path):
    foreign_file(tmp_path / "ipfix_decoded_20240101_000000.parquet", 2**63)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW"):
        io.read_exports(spark, str(tmp_path)).collect()


def test_foreign_and_own_exports_by_separate_globs(spark, raw, tmp_path):
    foreign_file(tmp_path / "ipfix_foreign_1.parquet", 1)
    io.write_export(decode_flows(raw), str(tmp_path), "ipfix_decoded_20240101_000000.parquet")
    both = io.read_decoded(
        spark, f"{tmp_path}/ipfix_foreign_*.parquet", f"{tmp_path}/ipfix_decoded_*.parquet"
    )
    assert export.exported_rows(both) == 2001


def test_staging_reads_eight_of_24_columns(spark, raw, tmp_path, capsys):
    io.write_export(decode_flows(raw), str(tmp_path), "ipfix_decoded_20240101_000000.parquet")
    stage_flows(io.read_exports(spark, str(tmp_path))).explain("formatted")
    schema = capsys.readouterr().out.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(part.split(":")[0] for part in schema.split(",")) == sorted(
        "time_received_ns bytes packets src_addr dst_addr src_port dst_port proto".split()
    )


# --- export ------------------------------------------------------------------


def test_flags(spark):
    rows = [(flag, *[None] * 24) for flag in (0, 0, 1, None)]
    raw = spark.createDataFrame(rows, RAW)
    assert tuple(flags.export_census(raw).first()) == (2, 1, 4)
    assert [r.exported for r in flags.mark_flows(raw).collect()] == [1, 1, 1, None]
    assert flags.export_flows(raw).count() == 1
    assert [r.exported for r in flags.remaining_flows(raw).collect()] == [0, 0, None]
    assert [r.status for r in flags.export_status(raw).collect()] == [
        "Rows to export: 2",
        "Rows marked: 3",
    ]


def test_batch_export_round_trip(spark, raw, tmp_path):
    source, root = str(tmp_path / "raw"), str(tmp_path / "exports")
    raw.write.parquet(source)
    census = export.run_export(spark, source, root, str(tmp_path / "rest"))
    assert census == {"dry_run": True, **flags.export_census(raw).first().asDict()}
    assert not (tmp_path / "exports").exists()

    run = dict(raw_path=source, export_root=root, dry_run=False)
    first = export.run_export(spark, remainder_path=str(tmp_path / "rest"), mark=False, **run)
    assert re.search(r"/ipfix_decoded_\d{8}_\d{6}_[0-9a-f]+\.parquet$", first["path"])
    marked = raw.where("exported = 1")
    assert first["rows_exported"] == marked.count()
    assert sums(io.read_exports(spark, root)) == sums(decode_flows(marked))
    assert io.read_raw(spark, str(tmp_path / "rest")).count() == 2000 - marked.count()
    assert any(".zstd." in f.name for f in Path(first["path"]).iterdir())
    # Marking first exports everything that is left.
    run |= {"raw_path": str(tmp_path / "rest")}
    export.run_export(spark, remainder_path=str(tmp_path / "rest3"), **run)
    assert sums(io.read_exports(spark, root)) == sums(decode_flows(raw))
    assert io.read_raw(spark, str(tmp_path / "rest3")).count() == 0


@pytest.mark.parametrize("complete", [True, False])
def test_batch_export_after_a_crash(spark, raw, tmp_path, monkeypatch, complete):
    """A run that ends within the export or before the remainder, and one more."""
    source, root, rest = (str(tmp_path / name) for name in ("raw", "exports", "rest"))
    raw.write.parquet(source)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(export, "remaining_flows", crash)
        with pytest.raises(RuntimeError):
            export.run_export(spark, source, root, rest, dry_run=False)
    if not complete:
        (folder,) = (tmp_path / "exports").iterdir()
        (folder / "_SUCCESS").unlink()
        next(folder.glob("part-*")).unlink()
    for _ in range(2):
        report = export.run_export(spark, source, root, rest, dry_run=False)
        assert report["rows_exported"] == 2000 and len(list((tmp_path / "exports").iterdir())) == 1
        assert sums(io.read_exports(spark, root)) == sums(decode_flows(raw))
        assert io.read_raw(spark, rest).count() == 0


def test_files_that_arrive_during_an_export(spark, raw, tmp_path, monkeypatch):
    """One file between the listing and the scan, one between a crash and the next run."""
    source, root, rest = (str(tmp_path / name) for name in ("raw", "exports", "rest"))
    part = F.xxhash64("time_received_ns", "src_port") % 3
    lots = [raw.where(part == 0), raw.where(part > 0), raw.where(part < 0)]
    lots[0].coalesce(1).write.mode("append").parquet(source)
    plain = export.read_raw_files

    def late(*args):
        lots[1].coalesce(1).write.mode("append").parquet(source)
        return plain(*args)

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(export, "read_raw_files", late)
        patch.setattr(export, "remaining_flows", crash)
        with pytest.raises(RuntimeError):
            export.run_export(spark, source, root, rest, dry_run=False)
    lots[2].coalesce(1).write.mode("append").parquet(source)
    first = export.run_export(spark, source, root, rest, dry_run=False)
    assert first["rows_exported"] == lots[0].count()
    assert spark.read.parquet(first["replaces"]).count() == 1
    assert export.late_files(spark, source, root).count() == 2
    second = export.run_export(spark, source, root, rest, dry_run=False)
    assert second["rows_exported"] == raw.count() - first["rows_exported"]
    assert export.run_export(spark, source, root, rest, dry_run=False) == second
    assert sums(io.read_exports(spark, root)) == sums(decode_flows(raw))
    assert export.late_files(spark, source, root).count() == 0


def test_exports_of_many_writers_are_few_scans(spark, raw, tmp_path):
    root = str(tmp_path / "exports")
    for n in range(6):
        part = decode_flows(raw.where(F.pmod(F.xxhash64("time_received_ns", "src_port"), F.lit(6)) == n))
        if n % 2:
            part = part.withColumns({"bytes": F.col("bytes").cast("decimal(20,0)"), "src_addr": F.col("src_addr").cast("binary")})
        io.write_export(part, root, f"ipfix_decoded_{n}.parquet")
    found = io.read_exports(spark, root)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert sums(found) == sums(decode_flows(raw))
    few = io.read_decoded(spark, *[f"{root}/ipfix_decoded_{n}.parquet" for n in (0, 2, 4)])
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_nothing_has_landed_yet(spark, raw, tmp_path):
    source, root = f"{tmp_path}/raw", f"{tmp_path}/exports"
    report = export.run_export(spark, source, root, f"{tmp_path}/rest", dry_run=False)
    assert report == {"dry_run": False, "path": None, "rows_exported": 0}
    assert export.run_export(spark, source, root, f"{tmp_path}/rest")["total_rows"] == 0
    query = start_export(raw_stream(spark, source), root, f"{tmp_path}/checkpoint", once=True)
    query.awaitTermination()
    assert not list(tmp_path.glob("exports/*"))
    raw.coalesce(1).write.mode("append").parquet(source)
    start_export(raw_stream(spark, source), root, f"{tmp_path}/checkpoint", once=True).awaitTermination()
    assert sums(io.read_exports(spark, root)) == sums(decode_flows(raw))


def run_stream(spark, root, purge="off", **options):
    stream = raw_stream(spark, f"{root}/raw", purge=purge, **options)
    query = start_export(stream, f"{root}/exports", f"{root}/checkpoint", once=True)
    query.awaitTermination()
    return io.read_exports(spark, f"{root}/exports")


def test_stream_exports_each_row_once(spark, raw, tmp_path):
    half = raw.randomSplit([0.5, 0.5], seed=3)
    half[0].repartition(4).write.parquet(f"{tmp_path}/raw")
    expected = sums(decode_flows(half[0]))
    assert sums(run_stream(spark, tmp_path, max_files=2)) == expected
    assert sums(run_stream(spark, tmp_path)) == expected
    half[1].coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    assert sums(run_stream(spark, tmp_path)) == sums(decode_flows(raw))
    assert len(list((tmp_path / "exports").glob("ipfix_decoded_*.parquet"))) == 3


def test_stream_repeats_an_uncommitted_batch_in_place(spark, raw, tmp_path):
    raw.repartition(4).write.parquet(f"{tmp_path}/raw")
    run_stream(spark, tmp_path, max_files=2)
    # As after a crash between writing the last batch and committing it.
    for commit in (tmp_path / "checkpoint" / "commits").glob("*1"):
        commit.unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(".*1.crc"):
        crc.unlink()
    assert sums(run_stream(spark, tmp_path)) == sums(decode_flows(raw))


def test_stream_with_a_new_checkpoint_keeps_earlier_exports(spark, raw, tmp_path):
    raw.coalesce(1).write.parquet(f"{tmp_path}/raw")
    run_stream(spark, tmp_path)
    query = start_export(
        raw_stream(spark, f"{tmp_path}/raw"), f"{tmp_path}/exports", f"{tmp_path}/other", once=True
    )
    query.awaitTermination()
    assert len(list((tmp_path / "exports").glob("ipfix_*"))) == 2


def test_stream_purges_processed_files(spark, raw, tmp_path):
    """Spark removes the files of a batch when it plans a later one."""

    def left():
        return {p.name for p in (tmp_path / "raw").glob("*.parquet")}

    raw.repartition(2).write.parquet(f"{tmp_path}/raw")
    first = left()
    run_stream(spark, tmp_path, purge="delete")
    assert left() == first
    raw.limit(10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    second = left() - first
    exported = run_stream(spark, tmp_path, purge="delete")
    assert exported.count() == 2010
    for _ in range(50):  # the removal runs beside the query
        if left() == second:
            break
        time.sleep(0.2)
    assert left() == second


# --- retention ---------------------------------------------------------------


@pytest.fixture
def exports(tmp_path):
    """A plain file and two export folders, 3, 5 and 6 days old; one stranger."""
    for name, days, seconds in (
        ("ipfix_a.parquet", 3, 0),
        ("ipfix_b.parquet/part-0.parquet", 5, 0),
        ("ipfix_c.parquet/part-0.parquet", 6, 0),
        ("ipfix_c.parquet/part-1.parquet", 5, 1),
        ("other.parquet", 9, 0),
    ):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x" * 100)
        age = (NOW - timedelta(days=days, seconds=seconds)).replace(tzinfo=timezone.utc)
        os.utime(path, (age.timestamp(), age.timestamp()))
    return tmp_path


def test_listing_and_expiry(spark, exports):
    files = io.list_files(spark, str(exports))
    assert files.count() == 4
    expired = retention.expired_exports(files, retention.age_limit(5, NOW)).collect()
    # Exactly five days old is not yet expired.
    assert [(Path(r.entry).name, r.files, r.size_bytes) for r in expired] == [("ipfix_c.parquet", 2, 200)]
    assert retention.expired_exports(files, retention.age_limit(6, NOW)).count() == 0
    report = retention.expire_exports(spark, files, 5, NOW)
    assert report == {
        "dry_run": True,
        "files_checked": 3,
        "files_deleted": 1,
        "bytes_freed": 200,
        "retention_days": 5,
    }
    assert (exports / "ipfix_c.parquet").exists()
    assert retention.expire_exports(spark, files, 5, NOW, dry_run=False) == {**report, "dry_run": False}
    assert sorted(p.name for p in exports.iterdir()) == [
        "ipfix_a.parquet",
        "ipfix_b.parquet",
        "other.parquet",
    ]


def test_nothing_to_expire(spark, tmp_path):
    files = io.list_files(spark, str(tmp_path))
    report = retention.expire_exports(spark, files, 5, NOW, dry_run=False)
    assert report["files_checked"] == report["files_deleted"] == report["bytes_freed"] == 0
    assert retention.expire_exports(spark, files, 5, NOW) == {**report, "dry_run": True}


def test_files_already_gone_are_not_counted(spark, exports):
    files = io.list_files(spark, str(exports)).cache()
    files.count()
    for part in (exports / "ipfix_c.parquet").iterdir():
        part.unlink()
    (exports / "ipfix_c.parquet").rmdir()
    report = retention.expire_exports(spark, files, 5, NOW, dry_run=False)
    assert (report["files_checked"], report["files_deleted"], report["bytes_freed"]) == (3, 0, 0)


def test_listing_reads_no_contents(spark, exports):
    plan = io.list_files(spark, str(exports))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("ReadSchema") :]


# --- layout ------------------------------------------------------------------


def day_flows(spark, hours=96, hot=900):
    """Flows over four days; one instant holds most of them."""
    start = int(datetime(2024, 5, 1, tzinfo=timezone.utc).timestamp()) * 10**9
    instants = [start + h * 3600 * 10**9 for h in range(hours)] + [start + 30 * 3600 * 10**9] * hot
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(instants)], "ns long, i long")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in DECODED]
    given = {"time_received_ns": F.col("ns"), "bytes": F.col("i"), "src_addr": F.lit("a")}
    return frame.select(*[given.get(f.name, c).alias(f.name) for f, c in zip(DECODED, columns, strict=True)])


def test_compaction_by_day(spark, tmp_path):
    flows = day_flows(spark)
    path = f"{tmp_path}/days"
    layout.compact(flows, path, rows_per_file=100)
    table = layout.read_days(spark, path)
    assert sums(table.drop("day")) == sums(flows)
    assert sorted(p.name for p in Path(path).glob("day=*")) == [f"day=2024050{d}" for d in (1, 2, 3, 4)]
    # The hot instant is spread over several files.
    assert len(list(Path(path).glob("day=20240502/*.parquet"))) > 3

    kept = retention.keep_recent(stage_flows(table), 2, date(2024, 5, 4))
    assert kept.agg(F.min("received_at")).first()[0] == datetime(2024, 5, 2)
    scan = kept._jdf.queryExecution().executedPlan().toString()
    assert "day#" in scan[scan.index("PartitionFilters") :].split("]")[0]
    report = layout.day_report(kept).collect()
    assert [r.partition for r in report] == ["20240502", "20240503", "20240504"]
    assert [r.rows for r in report] == [924, 24, 24]

    listed = io.list_files(spark, path, prefix="day=")
    days = retention.drop_days(spark, listed, date(2024, 5, 3))
    assert days == ["20240501", "20240502"] and len(list(Path(path).glob("day=*"))) == 4
    assert retention.drop_days(spark, listed, date(2024, 5, 3), dry_run=False) == days
    assert sorted(p.name for p in Path(path).glob("day=*")) == ["day=20240503", "day=20240504"]


def test_compaction_of_one_day_leaves_the_others(spark, tmp_path):
    path = f"{tmp_path}/days"
    flows = write_table(day_flows(spark).repartition(8), f"{tmp_path}/exports")
    layout.compact(flows, path)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    more = flows.unionByName(day_flows(spark, hours=50, hot=0))
    layout.compact(more, path, date(2024, 5, 3), date(2024, 5, 3))
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {"day=20240503"} and all(after[p] == before[p] for p in before.keys() & after.keys())
    counts = {r.day: r["count"] for r in layout.read_days(spark, path).groupBy("day").count().collect()}
    assert counts == {"20240501": 24, "20240502": 924, "20240503": 26, "20240504": 24}
    plan = flows.where(F.col("time_received_ns") >= layout._nanos(date(2024, 5, 3)))._jdf.queryExecution()
    assert "GreaterThanOrEqual(time_received_ns" in plan.executedPlan().toString()


def test_latest_rows_of_a_table_by_day(spark, tmp_path):
    layout.compact(day_flows(spark), f"{tmp_path}/days", rows_per_file=250)
    flows = stage_flows(layout.read_days(spark, f"{tmp_path}/days"))
    for k in (10, 200, 2000):
        plain = flows.select(*[n.lstrip("-") for n in marts.ORDER["recent_flows"]])
        plain = plain.orderBy(*marts.order_of("recent_flows")).limit(k)
        assert marts.recent_flows(flows, k).collect() == plain.collect()
    plan = reports.hourly_traffic_of(flows, date(2024, 5, 10))._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "day#" in filters and "20240502" in filters


def test_file_report(spark, tmp_path):
    for day, rows, parts in (("20240501", 30, 3), ("20240502", 10, 1)):
        spark.range(rows).repartition(parts).write.parquet(f"{tmp_path}/t/day={day}")
    files = layout.file_rows(spark, f"{tmp_path}/t")
    report = layout.file_report(files, layout.day_of_path()).collect()
    assert [(r.partition, r.rows, r.parts) for r in report] == [("20240501", 30, 3), ("20240502", 10, 1)]
    size = sum(p.stat().st_size for p in Path(tmp_path).glob("t/day=20240502/*.parquet"))
    assert report[1].size == (f"{size:.2f} B" if size < 1024 else f"{size / 1024:.2f} KiB")
    assert report[0].oldest_part <= report[0].newest_part
    assert layout.newest_files(files, 2).count() == 2
    sizes = layout.table_sizes(files, F.regexp_extract("path", r"/(t)/", 1)).first()
    assert (sizes.table, sizes.rows, sizes.parts) == ("t", 40, 4)


# --- refresh -----------------------------------------------------------------


def contents(spark, root):
    names = [*marts.ORDER, "overview_stats"]
    return {name: [tuple(r) for r in refresh.read_mart(spark, root, name).collect()] for name in names}


def write_exports(raw, root, *numbers):
    for n in numbers:
        part = raw.where(F.xxhash64("time_received_ns", "src_port") % 3 == n)
        io.write_export(decode_flows(part).coalesce(1), root, f"ipfix_decoded_{n}.parquet", "overwrite")


def test_refresh_reads_only_what_is_new(spark, raw, tmp_path):
    exports, root = f"{tmp_path}/exports", f"{tmp_path}/marts"
    write_exports(raw, exports, 0, -1)
    refresh.refresh_marts(spark, exports, root)
    first = set((tmp_path / "marts" / "segments").iterdir())
    write_exports(raw, exports, 1, -2, 2)
    refresh.refresh_marts(spark, exports, root)
    (added,) = set((tmp_path / "marts" / "segments").iterdir()) - first
    new = raw.where(F.xxhash64("time_received_ns", "src_port") % 3 > 0).count()
    new += raw.where(F.xxhash64("time_received_ns", "src_port") % 3 == -2).count()
    assert spark.read.parquet(f"{added}/stg_flows").count() == new
    refresh.build_marts(io.read_exports(spark, exports), f"{tmp_path}/full")
    assert contents(spark, root) == contents(spark, f"{tmp_path}/full")
    assert contents(spark, root)["overview_stats"][0][0] == 2000
    # Without anything new, no segment is written.
    refresh.refresh_marts(spark, exports, root)
    assert len(list((tmp_path / "marts" / "segments").iterdir())) == 2
    # An export that is gone takes the rest of its segment along, once more.
    io.delete_path(spark, f"{exports}/ipfix_decoded_0.parquet")
    refresh.refresh_marts(spark, exports, root)
    refresh.build_marts(io.read_exports(spark, exports), f"{tmp_path}/less")
    assert contents(spark, root) == contents(spark, f"{tmp_path}/less")
    assert len(refresh.versions(spark, root)) == 4
    refresh.clear_versions(spark, root)
    assert len(refresh.versions(spark, root)) == 2
    assert len(list((tmp_path / "marts" / "segments").iterdir())) == 3
    assert contents(spark, root) == contents(spark, f"{tmp_path}/less")


def test_refresh_leaves_old_flows_alone(spark, raw, tmp_path):
    """With the staged flows of the first segment gone, the second refresh still
    gives the whole marts."""
    exports, root = f"{tmp_path}/exports", f"{tmp_path}/marts"
    write_exports(raw, exports, 0, 2)
    refresh.refresh_marts(spark, exports, root)
    (old,) = (tmp_path / "marts" / "segments").iterdir()
    flows = spark.read.parquet(f"{old}/stg_flows")
    assert flows.count() > 0
    spark.createDataFrame([], flows.schema).write.mode("overwrite").parquet(f"{old}/stg_flows")
    write_exports(raw, exports, 1, -1, -2)
    refresh.refresh_marts(spark, exports, root)
    refresh.build_marts(io.read_exports(spark, exports), f"{tmp_path}/full")
    assert contents(spark, root) == contents(spark, f"{tmp_path}/full")
    # Numbers are dense, and an address has one.
    numbers = refresh._numbered(spark, root)
    found = numbers.agg(F.max("id"), F.countDistinct("id"), F.countDistinct("address"), F.count(F.lit(1))).first()
    assert len(set(found)) == 1


def test_failed_refresh_changes_and_deletes_nothing(spark, raw, exports, tmp_path, monkeypatch):
    source, root = f"{tmp_path}/own", f"{tmp_path}/marts"
    write_exports(raw, source, 0)
    refresh.refresh_marts(spark, source, root)
    before = contents(spark, root)
    write_exports(raw, source, 1)
    later = datetime.now() + timedelta(days=400)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh.marts, "top_ports", crash)
        with pytest.raises(RuntimeError):
            run_analytics(spark, source, root, 5, later, dry_run=False)
    assert contents(spark, root) == before
    assert io.read_exports(spark, source).count() > 0
    report = run_analytics(spark, source, root, 5, later, dry_run=False)
    assert report["files_deleted"] == 2 and contents(spark, root) != before
    assert not list((tmp_path / "own").glob("ipfix_*"))
    with pytest.raises(FileNotFoundError):
        refresh.read_mart(spark, f"{tmp_path}/none", "top_ports")


def test_dashboard(spark, raw, tmp_path):
    root = f"{tmp_path}/marts"
    stored = refresh.build_marts(decode_flows(raw), root)
    assert stored["stg_flows"].count() == 2000
    page = refresh.dashboard(spark, root, date(2000, 1, 1))
    assert page["overview_stats"].first().total_flows == 2000
    assert page["top_convos"].count() == 20 and page["recent_flows"].count() == 100
    talkers = [r.mb for r in page["top_talkers_by_bytes"].collect()]
    assert talkers == sorted(talkers, reverse=True)
    assert page["hourly_traffic"].first().hour >= datetime(1999, 12, 25)
    assert page["top_sources_chart"].columns == ["src_addr", "mb"]


def test_segments_merge_and_stay_few(spark, raw, tmp_path, monkeypatch):
    """Exports that come one by one end up in few segments, with the same marts."""
    monkeypatch.setattr(refresh, "FAN_IN", 2)
    monkeypatch.setattr(refresh, "MOST_EXPORTS", 2)
    exports, root = f"{tmp_path}/exports", f"{tmp_path}/marts"
    for number in (0, 1, 2):
        write_exports(raw, exports, number)
        refresh.refresh_marts(spark, exports, root)
    manifest = refresh._manifest(spark, root)
    counts = sorted(row["count"] for row in manifest.groupBy("segment").count().collect())
    assert counts == [1, 2]
    refresh.build_marts(io.read_exports(spark, exports), f"{tmp_path}/full")
    assert contents(spark, root) == contents(spark, f"{tmp_path}/full")
    # The rest of a merged segment is staged again when one of its exports expires.
    io.delete_path(spark, f"{exports}/ipfix_decoded_0.parquet")
    refresh.refresh_marts(spark, exports, root)
    refresh.build_marts(io.read_exports(spark, exports), f"{tmp_path}/less")
    assert contents(spark, root) == contents(spark, f"{tmp_path}/less")


def test_groups_of_segments():
    def segments(*sizes):
        numbers = iter(range(10_000))
        return {f"s{at:04d}": {(next(numbers), 0) for _ in range(size)} for at, size in enumerate(sizes)}

    assert refresh._mergeable(segments(*[1] * 7)) == []
    assert [len(names) for names in refresh._mergeable(segments(*[1] * 17))] == [8, 8]
    assert [len(names) for names in refresh._mergeable(segments(*[8] * 8, 1, 1))] == [8]
    assert refresh._mergeable(segments(*[64] * 20)) == []
    assert refresh._mergeable(segments(*[20] * 8)) == []


# --- streaming marts ---------------------------------------------------------


def run_marts(spark, root, max_files=None):
    stream = raw_stream(spark, f"{root}/raw", max_files=max_files)
    start_marts(stream, f"{root}/exports", f"{root}/marts", f"{root}/checkpoint", once=True).awaitTermination()


def test_streaming_marts_with_a_repeated_batch(spark, raw, tmp_path):
    raw.repartition(2).write.parquet(f"{tmp_path}/raw")
    run_marts(spark, tmp_path, max_files=1)
    refresh.build_marts(decode_flows(raw), f"{tmp_path}/full")
    expected = contents(spark, f"{tmp_path}/full")
    assert contents(spark, f"{tmp_path}/marts") == expected
    # As after a crash between publishing the last batch and committing it.
    for commit in [*(tmp_path / "checkpoint" / "commits").glob("*1"), *(tmp_path / "checkpoint" / "commits").glob(".*1.crc")]:
        commit.unlink()
    segments = set((tmp_path / "marts" / "segments").iterdir())
    run_marts(spark, tmp_path, max_files=1)
    assert contents(spark, f"{tmp_path}/marts") == expected
    assert set((tmp_path / "marts" / "segments").iterdir()) == segments  # staged once


# --- footers and expiry by event time ----------------------------------------


def span_file(path, times):
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = {f.name: pa.array([None] * len(times), pa.string()) for f in DECODED}
    columns |= {
        f.name: pa.array([7] * len(times), pa.int64()) for f in DECODED if f.dataType.typeName() in ("long", "integer")
    }
    columns["time_received_ns"] = pa.array(times, pa.int64())
    pq.write_table(pa.table(columns), path, row_group_size=2)


MOMENT = datetime(2024, 5, 10)
AT = int(MOMENT.replace(tzinfo=timezone.utc).timestamp()) * 10**9


def span_exports(root):
    """An old file, a new one, one of both, one without times, an empty one."""
    span_file(root / "ipfix_old.parquet", [AT - 10**9, AT - 5000, AT - 2000])
    span_file(root / "ipfix_new.parquet" / "part 1+.parquet", [AT + 5000, AT + 10**9])
    span_file(root / "ipfix_new.parquet" / "part-2.parquet", [AT - 10**12, AT - 10**13])
    span_file(root / "ipfix_both.parquet", [AT - 10**9, AT - 501, AT - 499, AT, AT + 1, None])
    span_file(root / "ipfix_none.parquet", [None, None])
    span_file(root / "ipfix_nulls.parquet", [None, AT - 10**9])
    span_file(root / "ipfix_empty.parquet", [])


@pytest.mark.parametrize("readable", [True, False])
def test_spans_from_footers_or_a_scan(spark, tmp_path, monkeypatch, readable):
    span_exports(tmp_path)
    for module in (retention, layout):
        monkeypatch.setattr(module, "footers_readable", lambda path: readable)
    spans = {r.path.rsplit("/", 1)[1]: (r.action, r.rows) for r in retention.flow_spans(spark, str(tmp_path), MOMENT).collect()}
    assert spans == {
        "ipfix_old.parquet": ("drop", 3),
        "part 1+.parquet": ("keep", 2),
        "part-2.parquet": ("drop", 2),
        "ipfix_both.parquet": ("rewrite", 6),
        "ipfix_none.parquet": ("keep", 2),
        "ipfix_nulls.parquet": ("rewrite", 2),
        "ipfix_empty.parquet": ("keep", 0),
    }
    rows = layout.file_rows(spark, f"{tmp_path}/ipfix_*.parquet").collect()
    assert {r.path.rsplit("/", 1)[1]: r.rows for r in rows} == {name: n for name, (_, n) in spans.items()}


def test_footers_of_other_kinds(spark, tmp_path):
    pq.write_table(pa.table({"t": pa.array([1, 2**64 - 1], pa.uint64())}), tmp_path / "wide.parquet")
    pq.write_table(pa.table({"t": ["a", "b"]}), tmp_path / "text.parquet")
    pq.write_table(pa.table({"t": [3, 4]}), tmp_path / "silent.parquet", write_statistics=False)
    pq.write_table(pa.table({"u": [3, 4]}), tmp_path / "other.parquet")
    pq.write_table(pa.table({"t": [-3, None, 4]}), tmp_path / "plain.parquet")
    found = footers.file_footers(footers.list_parquet(spark, str(tmp_path)), "t").collect()
    spans = {r.path.rsplit("/", 1)[1].removesuffix(".parquet"): tuple(r)[1:] for r in found}
    unknown = (2, None, None, None)
    assert spans == {name: unknown for name in ("wide", "text", "silent", "other")} | {"plain": (3, -3, 4, 1)}


def test_expiry_by_event_time(spark, tmp_path):
    root = tmp_path / "exports"
    span_exports(root)
    before = {path.name for path in root.rglob("*.parquet")}
    assert retention.expire_flows(spark, str(root), MOMENT) == {"dry_run": True, "drop": 2, "rewrite": 2, "keep": 3}
    assert {path.name for path in root.rglob("*.parquet")} == before
    report = retention.expire_flows(spark, str(root), MOMENT, dry_run=False)
    assert (report["drop"], report["rewrite"]) == (2, 2)
    times = [r[0] for r in io.read_exports(spark, str(root)).select("time_received_ns").collect()]
    near = 10**7  # double seconds decide what lies within a microsecond
    assert sorted(t - AT for t in times if t is not None and abs(t - AT) > near) == [10**9]
    assert times.count(None) == 4
    left = {path.name for path in root.iterdir()}
    assert left >= {"ipfix_new.parquet", "ipfix_none.parquet", "ipfix_empty.parquet"}
    assert not left & {"ipfix_old.parquet", "ipfix_both.parquet", "ipfix_nulls.parquet"}
    # The new export straddles nothing any more, so nothing is left to do.
    again = retention.expire_flows(spark, str(root), MOMENT, dry_run=False)
    assert (again["drop"], again["path"] is None or again["rewrite"] == 1) == (0, True)
    assert sorted(map(str, times)) == sorted(str(r[0]) for r in io.read_exports(spark, str(root)).select("time_received_ns").collect())


@pytest.mark.parametrize("step", ["move_path", "delete_path"])
def test_expiry_after_a_crash(spark, tmp_path, monkeypatch, step):
    root = tmp_path / "exports"
    span_exports(root)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr(retention, step, crash)
        retention.expire_flows(spark, str(root), MOMENT, dry_run=False)
    retention.expire_flows(spark, str(root), MOMENT, dry_run=False)
    other = tmp_path / "other"
    span_exports(other)
    retention.expire_flows(spark, str(other), MOMENT, dry_run=False)
    assert sums(io.read_exports(spark, str(root))) == sums(io.read_exports(spark, str(other)))
