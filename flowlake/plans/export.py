"""Batch export of raw flows, the counterpart of the streaming export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.times import run_stamp
from flowlake.operators.decode import decode_flows
from flowlake.operators.flags import export_census, mark_flows, remaining_flows
from flowlake.sources.files import (
    EXPORT_NAME,
    is_complete,
    list_files,
    list_names,
    make_folder,
    read_decoded,
    read_raw,
    read_raw_files,
    write_export,
)

BATCH = "path string, size_bytes long, modified_at timestamp, mark boolean"
DONE = ".done"


def batch_name(files: DataFrame, mark: bool) -> str:
    """Name of the export of a batch of raw files: when the newest one was
    written, and a digest of them all.  The same batch has the same name always."""
    digest = F.bit_xor(F.xxhash64("path", "size_bytes", "modified_at", F.lit(mark)))
    row = files.agg(run_stamp(F.max("modified_at")).alias("stamp"), F.hex(digest).alias("digest")).first()
    return EXPORT_NAME.format(f"{row.stamp}_{row.digest.lower()}")


def _list_root(export_root: str) -> str:
    return f"{export_root.rstrip('/')}-batches"


def _lists(spark: SparkSession, export_root: str) -> dict[str, bool]:
    """Names of the batches whose file list is complete, and whether each is done."""
    root = _list_root(export_root)
    names = set(list_names(spark, f"{root}/*"))
    return {
        name: f"{name}{DONE}" in names
        for name in sorted(names)
        if not name.endswith(DONE) and is_complete(spark, f"{root}/{name}")
    }


def listed_files(spark: SparkSession, export_root: str) -> DataFrame:
    """Raw files (path, size_bytes, modified_at, mark) of all batches so far."""
    root, names = _list_root(export_root), _lists(spark, export_root)
    if not names:
        return spark.createDataFrame([], BATCH)
    return spark.read.schema(BATCH).parquet(*[f"{root}/{name}" for name in names])


def late_files(spark: SparkSession, raw_path: str, export_root: str) -> DataFrame:
    """Raw files under ``raw_path`` that no batch has taken yet."""
    file = ["path", "size_bytes", "modified_at"]
    return list_files(spark, raw_path, prefix="").join(listed_files(spark, export_root), file, "left_anti")


def _next_batch(spark: SparkSession, raw_path: str, export_root: str, mark: bool) -> str | None:
    """Name of the batch to work on: the one left unfinished, or one of all files not
    in any, whose list is written first; else the last one, or none."""
    names = _lists(spark, export_root)
    unfinished = [name for name, done in names.items() if not done]
    if unfinished:
        return unfinished[0]
    # Held by the driver, so that the list and the name are of one look at the folder.
    rows = late_files(spark, raw_path, export_root).select("path", "size_bytes", "modified_at").collect()
    if rows:
        files = spark.createDataFrame([(*row, mark) for row in rows], BATCH)
        name = batch_name(files, mark)
        files.coalesce(1).write.mode("overwrite").parquet(f"{_list_root(export_root)}/{name}")
        return name
    if list_files(spark, raw_path, prefix="").isEmpty():
        return None
    return max(names, default=None)


def run_export(
    spark: SparkSession,
    raw_path: str,
    export_root: str,
    remainder_path: str,
    mark: bool = True,
    dry_run: bool = True,
) -> dict:
    """Mark, export, purge.  A dry run, the default, only counts.

    A batch is a list of files, written down before anything is exported, next to
    ``export_root``; export and remainder read exactly these files.  Files that
    arrive at any time after go to the next batch, and files of a batch to no other,
    so every row is exported once.  A run after a crash first finishes the batch it
    finds, under its name; a run that finds nothing new reports the last batch.

    The raw files are never rewritten in place: after the export is complete, the
    unmarked rest of the batch goes to ``remainder_path``, and ``replaces`` names the
    list of the files it stands for.  The caller switches over to it, or deletes
    these files; what came later (``late_files``) stays where it is.  ``mark=False``
    exports only rows that are flagged already.
    """
    if dry_run:
        return {"dry_run": True, **export_census(read_raw(spark, raw_path)).first().asDict()}
    name = _next_batch(spark, raw_path, export_root, mark)
    if name is None:
        remaining_flows(read_raw(spark, raw_path)).write.mode("overwrite").option("compression", "zstd").parquet(remainder_path)
        return {"dry_run": False, "path": None, "rows_exported": 0}
    replaces = f"{_list_root(export_root)}/{name}"
    files = spark.read.schema(BATCH).parquet(replaces).collect()
    path = f"{export_root}/{name}"
    if not _lists(spark, export_root)[name]:
        raw = read_raw_files(spark, sorted(row.path for row in files))
        batch = mark_flows(raw) if files[0].mark else raw
        if not is_complete(spark, path):
            write_export(decode_flows(batch.where("exported = 1")), export_root, name, mode="overwrite")
        remaining_flows(batch).write.mode("overwrite").option("compression", "zstd").parquet(remainder_path)
        make_folder(spark, f"{replaces}{DONE}")
    rows = read_decoded(spark, path).count()  # from the footers
    return {"dry_run": False, "path": path, "rows_exported": rows, "replaces": replaces}


def exported_rows(exports: DataFrame) -> int:
    """Row-count probe of the retained exports; answered from file footers."""
    return exports.count()
