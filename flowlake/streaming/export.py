"""Incremental export: every raw file is decoded and written exactly once.

The checkpoint takes over the role of the ``exported`` flag.  Each micro-batch
goes to a folder named after the query and the batch; a batch repeated after a
failure overwrites its own folder, so a crash at any point leaves neither a gap
nor a duplicate.  Plain folders, unlike the manifest of the built-in file sink,
may later be deleted by the retention job and are found by the export glob.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowlake.operators.decode import decode_flows
from flowlake.schema import RAW, conform
from flowlake.sources.files import EXPORT_NAME, raw_schema, write_export

INTERVAL = "5 minutes"  # fixed value: time between export runs


def raw_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    purge: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """Raw files as they arrive under ``path``.

    ``schema`` defaults to that of the files present, which covers writers with
    unsigned types; before any has arrived it is that of raw flows.  ``purge``
    removes files of completed batches: ``delete``, or ``archive`` to move them to
    the folder ``archive``.  Spark does so when it plans a later batch, so the
    files of the last batch stay until more arrive.
    """
    reader = (
        spark.readStream.schema(schema or raw_schema(spark, path))
        .option("pathGlobFilter", "*.parquet")
        .option("cleanSource", purge)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.parquet(path)


def batch_name(query_id: str, batch_id: int) -> str:
    """The same for a repeated batch, different for a query with a new checkpoint."""
    return EXPORT_NAME.format(f"{query_id}_{batch_id:08d}")


def start_export(
    raw: DataFrame,
    export_root: str,
    checkpoint: str,
    once: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Start exporting a raw stream.

    ``once`` works off what is there, in batches of at most ``max_files`` files,
    and ends: the form for an external schedule.  Otherwise the query stays up
    and runs a batch per ``interval``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        context = batch.sparkSession.sparkContext
        name = batch_name(context.getLocalProperty("sql.streaming.queryId"), batch_id)
        write_export(decode_flows(conform(batch, RAW)), export_root, name, mode="overwrite")

    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
