"""Retention: by file age for exports, by event time for tables."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.times import days_before, flow_time, run_stamp
from flowlake.plans.layout import since
from flowlake.sources.files import (
    EXPORT_GLOB,
    EXPORT_NAME,
    delete_path,
    is_complete,
    list_files,
    make_folder,
    move_path,
    paths_by_schema,
    qualified,
    read_decoded,
    write_export,
)
from flowlake.sources.footers import file_footers, footers_readable, scanned_footers

RETENTION_DAYS = 5  # fixed value: default age limit of exports


def age_limit(retention_days: int = RETENTION_DAYS, now: datetime | None = None) -> Column:
    """Exports last modified strictly before this are expired."""
    moment = F.current_timestamp() if now is None else F.lit(now)
    return moment - F.make_dt_interval(days=F.lit(retention_days))


def export_ages(files: DataFrame) -> DataFrame:
    """One row per export: a plain file, or the folder one run wrote.

    A folder counts as one export and is as old as its newest file, so an
    export is kept or removed whole.
    """
    return files.groupBy("entry").agg(
        F.max("modified_at").alias("modified_at"),
        F.sum("size_bytes").alias("size_bytes"),
        F.count(F.lit(1)).alias("files"),
    )


def expired_exports(files: DataFrame, cutoff: Column) -> DataFrame:
    return export_ages(files).where(F.col("modified_at") < cutoff)


def retention_report(
    files: DataFrame, cutoff: Column, retention_days: int = RETENTION_DAYS
) -> DataFrame:
    """What a clean-up would do: one pass over the listing, nothing deleted."""
    old = F.col("modified_at") < cutoff
    return export_ages(files).agg(
        F.count(F.lit(1)).alias("files_checked"),
        F.count_if(old).alias("files_deleted"),
        F.coalesce(F.sum(F.when(old, F.col("size_bytes"))), F.lit(0)).alias("bytes_freed"),
        F.lit(retention_days).alias("retention_days"),
    )


def expire_exports(
    spark: SparkSession,
    files: DataFrame,
    retention_days: int = RETENTION_DAYS,
    now: datetime | None = None,
    dry_run: bool = True,
) -> dict:
    """Delete expired exports and report; by default only report.

    Expired exports come to the driver one by one, not those that stay nor their
    data files.  Only exports that were really removed count as deleted and freed.
    """
    cutoff = age_limit(retention_days, now)
    if dry_run:
        return {"dry_run": True, **retention_report(files, cutoff, retention_days).first().asDict()}
    checked = export_ages(files).count()
    old = expired_exports(files, cutoff).select("entry", "size_bytes").toLocalIterator()
    freed = [row.size_bytes for row in old if delete_path(spark, row.entry)]
    return {
        "dry_run": False,
        "files_checked": checked,
        "files_deleted": len(freed),
        "bytes_freed": sum(freed),
        "retention_days": retention_days,
    }


def keep_recent(flows: DataFrame, days: int, as_of: date | None = None) -> DataFrame:
    """Staged flows received since midnight ``days`` before ``as_of``.

    On a table laid out by day only the kept partitions are read.
    """
    day = F.current_date() if as_of is None else F.lit(as_of)
    return since(flows, days_before(day, days))


def expired_days(files: DataFrame, before: date) -> DataFrame:
    """Day partitions of a compacted table that lie wholly before ``before``."""
    folder = F.regexp_extract("path", r"^.*/day=\d{8}(?=/)", 0)
    day = F.regexp_extract("path", r"/day=(\d{8})/", 1)
    return (
        files.select(folder.alias("partition_path"), day.alias("day"), "size_bytes")
        .where((F.col("day") != "") & (F.col("day") < before.strftime("%Y%m%d")))
        .groupBy("day", "partition_path")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"))
        .orderBy("day")
    )


def drop_days(
    spark: SparkSession, files: DataFrame, before: date, dry_run: bool = True
) -> list[str]:
    """Drop whole day partitions (one row per day on the driver); returns the days."""
    rows = expired_days(files, before).select("day", "partition_path").collect()
    if dry_run:
        return [row["day"] for row in rows]
    return [row["day"] for row in rows if delete_path(spark, row["partition_path"])]


# Times are rounded to microseconds; a file nearer to the moment than this is read.
ROUNDING_NS = 1000

SPAN = "time_received_ns"


def flow_spans(spark: SparkSession, export_root: str, before: datetime) -> DataFrame:
    """What expiry by event time does to each export file: drop, rewrite or keep.

    Decided by the lowest and highest receive time in its footer.  A file is dropped
    if all its flows are older than ``before`` and kept if none is; a flow without a
    time is no older than anything.  A file whose footer does not tell is rewritten.
    """
    files = list_files(spark, export_root)
    if footers_readable(qualified(spark, export_root)) or files.isEmpty():
        spans = file_footers(files, SPAN)
    else:
        kinds = paths_by_schema(spark, f"{export_root}/{EXPORT_GLOB}")
        scans = [scanned_footers(spark.read.parquet(*paths), files, SPAN) for paths in kinds]
        # A file is read by one of the scans, and has no rows in the others.
        spans = reduce(DataFrame.unionByName, scans).groupBy("path").agg(
            F.sum("rows").alias("rows"), F.min("lowest").alias("lowest"),
            F.max("highest").alias("highest"), F.sum("nulls").alias("nulls"),
        )
    moment = F.lit(_epoch_nanos(before))
    known = F.col("nulls").isNotNull()
    old = known & (F.col("nulls") == 0) & (F.col("highest") < moment - ROUNDING_NS)
    new = known & F.coalesce(F.col("lowest") >= moment + ROUNDING_NS, F.lit(True))
    action = F.when(old, "drop").when(new, "keep").otherwise("rewrite")
    return files.join(spans.select("path", "rows", action.alias("action")), "path")


def expire_flows(
    spark: SparkSession, export_root: str, before: datetime, dry_run: bool = True
) -> dict:
    """Remove flows received before ``before`` (UTC) from exports of any layout.

    Files wholly older go, files wholly newer are left alone, and only those that
    straddle the moment are read: their younger flows become one new export.  The
    driver holds the paths of files that go or straddle, never those that stay.

    The new export is written beside the root, then the list of what it replaces;
    only then anything under the root changes.  A run after a crash first finishes
    the list it finds.  Between its move and the end of the deletions, a reader can
    see flows of straddling files twice; rows are never missing.
    """
    work = f"{export_root.rstrip('/')}-expiry"
    if not dry_run and is_complete(spark, f"{work}/plan"):
        _apply_expiry(spark, export_root, work)
    spans = flow_spans(spark, export_root, before)
    if dry_run:
        counts = {row.action: row["count"] for row in spans.groupBy("action").count().collect()}
        return {"dry_run": True, **{name: counts.get(name, 0) for name in ("drop", "rewrite", "keep")}}
    # An entry all of whose files go is removed whole, with what else lies in it.
    whole = spans.groupBy("entry").agg(F.count_if(F.col("action") == "keep").alias("kept"))
    gone = spans.where("action <> 'keep'").join(whole, "entry")
    stamp = run_stamp(F.lit(before).cast("timestamp"))
    rows = gone.select("path", "action", F.when(F.col("kept") == 0, F.col("entry")).otherwise(F.col("path")).alias("target"), stamp.alias("stamp")).collect()
    report = {"dry_run": False, "drop": 0, "rewrite": 0, "path": None}
    if not rows:
        return report
    straddling = sorted(row.path for row in rows if row.action == "rewrite")
    name = EXPORT_NAME.format(f"{rows[0].stamp}_{uuid.uuid4().hex}")
    if straddling:
        received = flow_time(F.col(SPAN))
        expired = F.coalesce(received < F.timestamp_micros(F.lit(_epoch_nanos(before) // 1000)), F.lit(False))
        write_export(read_decoded(spark, *straddling).where(~expired), work, name, mode="overwrite")
        report |= {"rewrite": len(straddling), "path": f"{export_root}/{name}"}
    plan = [(target, name) for target in sorted({row.target for row in rows})]
    spark.createDataFrame(plan, "target string, name string").coalesce(1).write.mode("overwrite").parquet(f"{work}/plan")
    _apply_expiry(spark, export_root, work)
    return report | {"drop": len(rows) - len(straddling)}


def _apply_expiry(spark: SparkSession, export_root: str, work: str) -> None:
    """Every step may be repeated; the list goes last."""
    make_folder(spark, export_root)
    rows = spark.read.schema("target string, name string").parquet(f"{work}/plan").collect()
    move_path(spark, f"{work}/{rows[0].name}", f"{export_root}/{rows[0].name}")
    for row in rows:
        delete_path(spark, row.target)
    delete_path(spark, f"{work}/plan")


def _epoch_nanos(moment: datetime) -> int:
    """Nanoseconds since the epoch; a moment without a zone is in UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    whole = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (whole.days * 86_400_000_000 + whole.seconds * 1_000_000 + whole.microseconds) * 1000
