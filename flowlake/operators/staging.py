"""Typed staging table read by every mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.sizes import gigabytes
from flowlake.functions.times import day_of, flow_time, hour_of
from flowlake.schema import STAGED


def stage_flows(decoded: DataFrame) -> DataFrame:
    """Eleven staging columns from eight export columns: a pure projection.

    The ``day`` of a table partitioned by day is kept for pruning.
    """
    names = STAGED.names + [name for name in decoded.columns if name == "day"]
    return (
        decoded.withColumn("received_at", flow_time(F.col("time_received_ns")))
        .withColumns(
            {
                "received_hour": hour_of(F.col("received_at")),
                "received_date": day_of(F.col("received_at")),
                "gb": gigabytes(F.col("bytes")),
            }
        )
        .select(*names)
    )
