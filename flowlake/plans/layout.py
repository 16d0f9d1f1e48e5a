"""Storage layout: size reports, compaction, partitions by day."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.sizes import readable_size
from flowlake.functions.times import flow_time, partition_key
from flowlake.operators.clustering import with_place
from flowlake.operators.topk import top_rows
from flowlake.schema import DECODED
from flowlake.sources.files import qualified
from flowlake.sources.footers import file_footers, footers_readable, list_parquet, scanned_footers

# Rows of a compacted file, some 100 MB.  One task sorts them, at some 300 bytes each.
FILE_ROWS = 2_000_000


def file_rows(spark: SparkSession, glob: str) -> DataFrame:
    """Row count, size and age per file, from listing and footers; no flow is read."""
    files = list_parquet(spark, glob)
    if footers_readable(qualified(spark, glob)):
        found = file_footers(files)
    else:
        found = scanned_footers(spark.read.parquet(glob), files)
    return files.join(found.select("path", "rows"), "path")


def file_report(files: DataFrame, partition: Column) -> DataFrame:
    """Size, rows, files and age per partition; ``partition`` is derived from ``path``."""
    return (
        files.groupBy(partition.alias("partition"))
        .agg(
            readable_size(F.sum("size_bytes")).alias("size"),
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("parts"),
            F.min("modified_at").alias("oldest_part"),
            F.max("modified_at").alias("newest_part"),
        )
        .orderBy(F.asc_nulls_last("partition"))
    )


def day_of_path() -> Column:
    """Partition of a file of a compacted table."""
    return F.regexp_extract("path", r"/day=([^/]+)/", 1)


def entry_of_path() -> Column:
    """Export a file belongs to: the topmost ``*.parquet`` part of its path."""
    return F.regexp_extract("path", r"([^/]+\.parquet)", 1)


def day_report(flows: DataFrame) -> DataFrame:
    """Rows and volume per day partition, counted from the flows themselves."""
    return (
        flows.groupBy(partition_key(F.col("received_at")).alias("partition"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            readable_size(F.sum("bytes")).alias("traffic"),
            F.min("received_at").alias("oldest_row"),
            F.max("received_at").alias("newest_row"),
        )
        .orderBy(F.asc_nulls_last("partition"))
    )


def compact(
    decoded: DataFrame,
    path: str,
    first: date | None = None,
    last: date | None = None,
    rows_per_file: int = FILE_ROWS,
    by_address: bool = False,
) -> None:
    """Rewrite exports as few clustered files under ``day=``.

    Only flows of the days ``first`` to ``last`` are read (the bounds reach the
    scan) and only their partitions of ``path`` are written; a repeated run
    replaces them.  ``path`` must not be where ``decoded`` is read from.

    Range partitioning by receive time gives each file a narrow time span, so
    later time filters skip files by their footers, and splits a heavy day over
    several files.  The row id as last key splits even equal timestamps.

    ``by_address`` clusters by time, source and destination at once instead (see
    ``operators.clustering``): filters on any of them then skip files, each fewer
    than if it were the only one.  That takes a pass over the three columns more.
    """
    if first is not None:
        decoded = decoded.where(F.col("time_received_ns") >= _nanos(first) - 1000)
    if last is not None:
        decoded = decoded.where(F.col("time_received_ns") < _nanos(last + timedelta(days=1)) + 1000)
    row_id, day = "_row_id", F.col("day")
    flows = decoded.withColumn("day", partition_key(flow_time(F.col("time_received_ns"))))
    # Times are rounded to microseconds: the day decides what lies on its border.
    if first is not None:
        flows = flows.where(day >= first.strftime("%Y%m%d"))
    if last is not None:
        flows = flows.where(day <= last.strftime("%Y%m%d"))
    place = "_place"
    if by_address:
        flows, rows = with_place(flows, place, "time_received_ns", "src_addr", "dst_addr")
        ranges, order = [day, F.col(place)], [day, F.col(place), F.col("time_received_ns")]
    else:
        rows, ranges, order = flows.count(), [F.col("time_received_ns")], [day, F.col("time_received_ns")]
    (
        flows.withColumn(row_id, F.monotonically_increasing_id())
        .repartitionByRange(max(1, math.ceil(rows / rows_per_file)), *ranges, F.col(row_id))
        .sortWithinPartitions(*order)
        .drop(row_id, place)
        .write.partitionBy("day")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .parquet(path)
    )


def _nanos(day: date) -> int:
    return (day - date(1970, 1, 1)).days * 86_400_000_000_000


def newest_files(files: DataFrame, k: int = 20) -> DataFrame:
    """Rows and size per file, newest first."""
    shown = files.select("path", "rows", readable_size(F.col("size_bytes")).alias("size"), "modified_at")
    return top_rows(shown, [F.desc_nulls_last("modified_at"), F.asc_nulls_last("path")], k)


def table_sizes(files: DataFrame, table: Column) -> DataFrame:
    """Size, rows and files per table, largest first; ``table`` is derived from ``path``."""
    return (
        files.groupBy(table.alias("table"))
        .agg(
            F.sum("size_bytes").alias("size_bytes"),
            readable_size(F.sum("size_bytes")).alias("size"),
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("parts"),
        )
        .orderBy(F.desc_nulls_last("size_bytes"), F.asc_nulls_last("table"))
    )


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """A compacted table, with ``day`` as text.

    Staging keeps ``day``, and time filters use it to skip whole partitions.
    """
    kept = spark.read.parquet(path)
    decoded = [kept[f.name].cast(f.dataType).alias(f.name) for f in DECODED]
    return kept.select(*decoded, kept["day"].cast("string").alias("day"))


def since(flows: DataFrame, moment: Column) -> DataFrame:
    """Staged flows received at or after ``moment``."""
    recent = flows.where(F.col("received_at") >= moment)
    if "day" in flows.columns:
        recent = recent.where(F.col("day") >= partition_key(moment))
    return recent
