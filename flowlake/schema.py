"""Column names and types of the flow tables, and casting onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_BYTES, _DOUBLE, _TIME = T.BinaryType(), T.DoubleType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Export layout: addresses already text.
DECODED = _struct(
    src_mac=_TEXT,
    dst_mac=_TEXT,
    tcp_flags=_INT,
    time_received_ns=_LONG,
    time_flow_start_ns=_LONG,
    time_flow_end_ns=_LONG,
    sampler_address=_TEXT,
    src_addr=_TEXT,
    dst_addr=_TEXT,
    in_if=_LONG,
    out_if=_LONG,
    ingress_vrf_id=_LONG,
    dot1q_vlan=_INT,
    post_dot1q_vlan=_INT,
    dot1q_cvlan=_INT,
    post_dot1q_cvlan=_INT,
    etype=_INT,
    proto=_INT,
    src_port=_INT,
    dst_port=_INT,
    bytes=_LONG,
    packets=_LONG,
    custom_integer_1=_LONG,
    custom_integer_2=_LONG,
)

# Collector layout: the same columns with packed addresses, plus the flag that
# says whether a row has been handed to the export.
_PACKED = {
    "src_mac": _LONG,
    "dst_mac": _LONG,
    "sampler_address": _BYTES,
    "src_addr": _BYTES,
    "dst_addr": _BYTES,
}
RAW = T.StructType(
    [T.StructField("exported", _INT)]
    + [T.StructField(f.name, _PACKED.get(f.name, f.dataType)) for f in DECODED]
)

STAGED = _struct(
    received_at=_TIME,
    received_hour=_TIME,
    received_date=_TIME,
    bytes=_LONG,
    gb=_DOUBLE,
    packets=_LONG,
    src_addr=_TEXT,
    dst_addr=_TEXT,
    src_port=_INT,
    dst_port=_INT,
    proto=_INT,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``.

    Files are read with their own types first because other writers store
    unsigned 64-bit counters (Spark: ``decimal(20,0)``) and unannotated text
    (Spark: ``binary``).  Columns that already fit are left untouched, so
    filters on them still reach the parquet reader.
    """
    found = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.col(f.name)
            if found.get(f.name) == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
