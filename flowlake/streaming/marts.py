"""Streaming marts: every micro-batch is exported, staged as a segment and published.

The export of a batch is named after the query and the batch, and a refresh finds
out by the files themselves what is new.  So a batch repeated after a crash, at any
point, changes nothing that was done: an export that is complete is left as it is, an
incomplete one is written again, and flows are in the published marts exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowlake.operators.decode import decode_flows
from flowlake.plans.refresh import refresh_marts
from flowlake.schema import RAW, conform
from flowlake.sources.files import is_complete, write_export
from flowlake.streaming.export import INTERVAL, batch_name


def start_marts(
    raw: DataFrame,
    export_root: str,
    mart_root: str,
    checkpoint: str,
    once: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Start a stream that keeps the marts under ``mart_root`` up to date.

    What a batch costs follows its flows and the tables of totals, not the flows
    before it.  Exports that expire are
    noticed by the next batch.  Old versions stay until ``clear_versions``.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_name(spark.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        if not is_complete(spark, f"{export_root}/{name}"):
            write_export(decode_flows(conform(batch, RAW)), export_root, name, mode="overwrite")
        refresh_marts(spark, export_root, mart_root)

    writer = raw.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
