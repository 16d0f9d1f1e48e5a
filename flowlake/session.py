"""Session settings the queries rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Spark prunes ahead of a ranked filter only for ranks up to a threshold (1000 by
# default); the largest there is, so no cap can outgrow it.
RANKED_LIMIT = 2**31 - 1

# HotSpot interprets methods beyond this many bytes of bytecode.  Above the limit
# Spark generates code per operator, which it splits into small methods: the
# 24-column decode ran 2.7 times faster that way than as one interpreted method.
METHOD_BYTES = 8_000

_local_scratch: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options results or plans depend on; safe to repeat."""
    # Hour and day buckets follow the session zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The default, INT96, has no footer statistics: time filters would skip nothing.
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    ranked, method = (
        "spark.sql.optimizer.windowGroupLimitThreshold",
        "spark.sql.codegen.hugeMethodLimit",
    )
    spark.conf.set(ranked, str(RANKED_LIMIT))
    spark.conf.set(method, str(min(int(spark.conf.get(method)), METHOD_BYTES)))
    return spark


def build_session(
    app: str, master: str | None = None, options: dict[str, str] | None = None
) -> SparkSession:
    """Create a session.  Cluster sizing is left to ``spark-submit``.

    Adaptive execution merges small shuffle partitions, so on a cluster
    ``spark.sql.shuffle.partitions`` should be set for the largest shuffle.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.session.timeZone": "UTC",
        **(options or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder ``spark.checkpoint.dir`` names.

    Only a local session may go without that setting: executors elsewhere could
    not see a folder of this machine.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _local_scratch
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
