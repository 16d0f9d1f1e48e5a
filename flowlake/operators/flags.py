"""The ``exported`` flag of raw rows: mark, select, keep, count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.operators.decode import decode_flows


def mark_flows(raw: DataFrame) -> DataFrame:
    """Flag every waiting row.  Rows that arrive in later files keep their 0:
    a batch read fixes its file list when the frame is created."""
    waiting = F.col("exported") == 0
    return raw.withColumn("exported", F.when(waiting, F.lit(1)).otherwise(F.col("exported")))


def export_flows(raw: DataFrame) -> DataFrame:
    """Decoded form of the marked rows, leftovers of earlier runs included."""
    return decode_flows(raw.where("exported = 1"))


def remaining_flows(raw: DataFrame) -> DataFrame:
    """What is left after the marked rows are deleted (a null flag never matches)."""
    return raw.where("exported IS DISTINCT FROM 1")


def export_census(raw: DataFrame) -> DataFrame:
    """Waiting, marked and all rows in one pass over one column."""
    return raw.agg(
        F.count_if(F.col("exported") == 0).alias("unexported_rows"),
        F.count_if(F.col("exported") == 1).alias("exported_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def export_status(raw: DataFrame) -> DataFrame:
    """The two progress lines of a run: rows found waiting, rows then marked."""
    counts = export_census(raw)
    found = F.concat(F.lit("Rows to export: "), F.col("unexported_rows").cast("string"))
    marked = F.concat(
        F.lit("Rows marked: "),
        (F.col("unexported_rows") + F.col("exported_rows")).cast("string"),
    )
    return counts.select(F.explode(F.array(found, marked)).alias("status"))
