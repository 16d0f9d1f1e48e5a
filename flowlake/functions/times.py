"""Flow clocks: nanosecond epochs, buckets and text stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flow_time(nanos: Column) -> Column:
    """Timestamp of an epoch in nanoseconds.

    Defined through double seconds, rounded half to even to microseconds;
    truncating or rounding halves up differs by 1 us on many rows.
    """
    seconds = nanos.cast("double") / F.lit(1e9)
    return F.timestamp_micros(F.rint(seconds * F.lit(1e6)).cast("bigint"))


def hour_of(moment: Column) -> Column:
    return F.date_trunc("hour", moment)


def day_of(moment: Column) -> Column:
    """Midnight of the day, still a timestamp."""
    return F.date_trunc("day", moment)


def bucket_end(hour: Column) -> Column:
    """Hour buckets are labelled by the moment they close."""
    return hour + F.expr("INTERVAL 1 HOUR")


def days_before(day: Column, days: int) -> Column:
    """Midnight ``days`` before ``day``, as a timestamp to compare with."""
    return F.date_sub(day, days).cast("timestamp")


def partition_key(moment: Column) -> Column:
    """``yyyyMMdd`` text naming a day partition."""
    return F.date_format(moment, "yyyyMMdd")


def run_stamp(moment: Column) -> Column:
    """``yyyyMMdd_HHmmss`` text naming an export run."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")
