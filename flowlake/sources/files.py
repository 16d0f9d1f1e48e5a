"""Parquet sources and sinks, and file listings."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.schema import DECODED, RAW, conform

# How export files are named and found.
EXPORT_PREFIX = "ipfix_"
EXPORT_GLOB = "ipfix_*.parquet"
EXPORT_NAME = "ipfix_decoded_{}.parquet"

# Footers read side by side by the driver, one per export.
FOOTERS_AT_ONCE = 16

LISTING = "path string, entry string, modified_at timestamp, size_bytes long"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw flows under ``path``; none while no file has arrived."""
    return conform(spark.read.schema(raw_schema(spark, path)).parquet(path), RAW)


def read_raw_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw flows of exactly these files."""
    return conform(spark.read.parquet(*paths), RAW)


def raw_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the raw files under ``path``, ``RAW`` while there are none."""
    if list_files(spark, path, prefix="").isEmpty():
        make_folder(spark, path)
        return RAW
    return spark.read.parquet(path).schema


def read_decoded(spark: SparkSession, *globs: str) -> DataFrame:
    """Exported flows.  A glob matches plain files and Spark-written folders.

    Files of different writers may lie under one glob: the footer of one file of
    each match says how it stores its columns, and all that store them alike are
    one scan, whose columns are then cast.  The files of one folder are of one writer.
    """
    kinds = paths_by_schema(spark, *globs)
    if len(kinds) < 2:  # Spark also says so where nothing matches
        return conform(spark.read.parquet(*globs), DECODED)
    parts = [conform(spark.read.parquet(*paths), DECODED) for paths in kinds]
    return reduce(DataFrame.unionByName, parts)


def paths_by_schema(spark: SparkSession, *globs: str) -> list[list[str]]:
    """Paths that match, grouped by how their columns are stored."""
    statuses = [status for glob in globs for status in _matches(spark, glob)]
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        kinds = list(pool.map(lambda status: _stored_schema(spark, status), statuses))
    found: dict[str, list[str]] = {}
    for status, kind in zip(statuses, kinds, strict=True):
        if kind is not None:
            found.setdefault(kind, []).append(status.getPath().toString())
    return [paths for _, paths in sorted(found.items())]


def _matches(spark: SparkSession, glob: str) -> list:
    system, target = _file_system(spark, glob)
    return list(system.globStatus(target) or [])


def _stored_schema(spark: SparkSession, status) -> str | None:
    """Schema in the footer of a file, or of the first file of a folder."""
    path = status.getPath()
    if status.isDirectory():
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        path = None
        while path is None and files.hasNext():
            found = files.next().getPath()
            path = found if found.getName().endswith(".parquet") else None
        if path is None:
            return None
    parquet = spark._jvm.org.apache.parquet.hadoop
    file = parquet.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = parquet.ParquetFileReader.open(file)
    try:
        return reader.getFileMetaData().getSchema().toString()
    finally:
        reader.close()


def read_exports(spark: SparkSession, root: str) -> DataFrame:
    """All exported flows retained under ``root``."""
    return read_decoded(spark, f"{root}/{EXPORT_GLOB}")


def write_export(decoded: DataFrame, root: str, name: str, mode: str = "errorifexists") -> str:
    """Write one export run as zstd parquet; the tasks write side by side."""
    path = f"{root}/{name}"
    decoded.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as read back.

    ``df`` must not read from ``path``.  Later steps start from the files, so a
    lost executor costs a re-read and not the whole lineage.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` and the qualified path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(target)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system."""
    return _file_system(spark, path)[1].toString()


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder within a file system; False if ``source`` is not there."""
    system, origin = _file_system(spark, source)
    return system.exists(origin) and system.rename(origin, _file_system(spark, target)[1])


def list_names(spark: SparkSession, glob: str) -> list[str]:
    """Names of the files and folders that match."""
    system, target = _file_system(spark, glob)
    return [status.getPath().getName() for status in system.globStatus(target) or []]


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.mkdirs(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a Spark job wrote ``path`` to its end."""
    system, target = _file_system(spark, f"{path}/_SUCCESS")
    return system.exists(target)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if it was not there."""
    system, target = _file_system(spark, path)
    return system.delete(target, True)


def list_files(spark: SparkSession, root: str, prefix: str = EXPORT_PREFIX) -> DataFrame:
    """Parquet files below those entries of ``root`` whose name starts with ``prefix``.

    ``entry`` is the path right under ``root``: the file itself, or the folder
    of one export run.  Only the listing is read, never the contents.  Nothing
    found gives no rows.
    """
    system, folder = _file_system(spark, root)
    top = folder.toString().rstrip("/")
    if not system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{top}/{prefix}*")):
        return spark.createDataFrame([], LISTING)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{root.rstrip('/')}/{prefix}*")
    )
    return listed.select(
        "path",
        F.regexp_extract("path", rf"^\Q{top}\E/[^/]+", 0).alias("entry"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("size_bytes"),
    )
