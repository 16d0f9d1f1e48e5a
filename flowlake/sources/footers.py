"""What parquet footers say of files: rows, and lowest and highest of a column.

Tasks read the footers of the files listed to them; no flow becomes a row.
Footers are opened with Arrow's file systems.  A store that only Spark can open
(``footers_readable``) is scanned instead, for one column at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Footers a task reads side by side: each is a wait for the store.
AT_ONCE = 16

LONG_MAX = 2**63 - 1

FOUND = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("lowest", T.LongType()),
        T.StructField("highest", T.LongType()),
        T.StructField("nulls", T.LongType()),
    ]
)
ARROW = pa.schema([("path", pa.string()), *[(name, pa.int64()) for name in FOUND.names[1:]]])


def list_parquet(spark: SparkSession, *globs: str) -> DataFrame:
    """Parquet files below ``globs``: path, size_bytes, modified_at; from the listing alone."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(globs))
    )
    return listed.select(
        "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")
    )


def footers_readable(path: str) -> bool:
    """Whether Arrow can open the store ``path`` lies in."""
    try:
        _store(path)
    except (OSError, ValueError, NotImplementedError, ImportError):
        return False
    return True


def file_footers(files: DataFrame, column: str | None = None) -> DataFrame:
    """Rows of each listed ``path``, and what ``column`` holds there.

    ``lowest`` and ``highest`` are of an integer column; both are null if all its
    values are, or if the footer does not tell or has a value beyond a long, and then
    ``nulls`` is null too.  A null ``nulls`` thus means: unknown.  An empty file has
    no rows and no nulls.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for batch in batches:
                found = list(pool.map(lambda path: _footer(path, column), batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_pylist(found, ARROW)

    return files.select("path").mapInArrow(read, FOUND)


def scanned_footers(table: DataFrame, files: DataFrame, column: str | None = None) -> DataFrame:
    """The same of ``files`` from a scan of ``table``, which reads them, for stores
    Arrow cannot open: of no column but ``column``."""
    value = F.lit(None).cast("long") if column is None else F.col(column).cast("long")
    # The metadata column has paths percent-encoded.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    found = table.groupBy(_plain(path).alias("plain")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        (F.count(F.lit(1)) - F.count(value)).alias("nulls"),
    )
    listed = files.select("path", _plain(F.col("path")).alias("plain"))
    numbers = [F.coalesce(name, F.lit(0)).alias(name) if name in ("rows", "nulls") else name for name in FOUND.names[1:]]
    return listed.join(found, "plain", "left").select("path", *numbers)  # an empty file has no row


def _plain(path: Column) -> Column:
    """One spelling of ``file:/a`` and ``file:///a``."""
    return F.regexp_replace(path, "^([a-z0-9]+:)/+", "$1/")


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):  # spelled by the listing as it is, not encoded
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def _footer(path: str, column: str | None) -> dict:
    store, name = _store(path)
    with store.open_input_file(name) as file:
        footer = pq.read_metadata(file)
    return {"path": path, "rows": footer.num_rows, **_span(footer, column)}


def _span(footer: pq.FileMetaData, column: str | None) -> dict:
    unknown = {"lowest": None, "highest": None, "nulls": None}
    names = [footer.schema.column(i).path for i in range(footer.num_columns)]
    if column not in names:
        return unknown
    place, bounds, nulls = names.index(column), [], 0
    for number in range(footer.num_row_groups):
        group = footer.row_group(number)
        if group.num_rows == 0:
            continue
        told = group.column(place).statistics
        if told is None or not told.has_null_count:
            return unknown
        nulls += told.null_count
        if told.null_count == group.num_rows:
            continue
        if not told.has_min_max or not isinstance(told.min, int | Decimal):
            return unknown
        bounds += [int(told.min), int(told.max)]
    if any(abs(bound) > LONG_MAX for bound in bounds):
        return unknown
    return {"lowest": min(bounds, default=None), "highest": max(bounds, default=None), "nulls": nulls}
