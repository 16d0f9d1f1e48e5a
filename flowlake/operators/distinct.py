"""Exact distinct counts that add up.

Every address has a number, dense from 1, given once.  A set of addresses is then
a set of bitmaps, one per run of 32,768 numbers, and the union of sets found at
different times is a bitwise or: neither flows nor addresses are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Groups numbered side by side; as many counts are added up in one task.
LANES = 1024

ADDRESSES = "address string, id long"


def addresses_of(flows: DataFrame) -> DataFrame:
    """Each source or destination once."""
    sides = F.explode(F.array_distinct(F.array("src_addr", "dst_addr")))
    return flows.select(sides.alias("address")).where("address IS NOT NULL").distinct()


def unnumbered(flows: DataFrame, numbered: DataFrame) -> DataFrame:
    """Addresses of ``flows`` that are not among ``numbered``."""
    return addresses_of(flows).join(numbered, "address", "left_anti")


def number_addresses(new: DataFrame, numbered: DataFrame) -> DataFrame:
    """``new`` addresses with the numbers after those of ``numbered``, without gaps.

    They are dealt over lanes by hash and counted per lane; a number is the count
    of all lanes before plus the place in the lane.  ``new`` is read twice.
    """
    dealt = new.withColumn("lane", F.pmod(F.xxhash64("address"), F.lit(LANES)))
    before = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("lane")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    last = numbered.agg(F.coalesce(F.max("id"), F.lit(0).cast("long"))).scalar()
    place = F.row_number().over(Window.partitionBy("lane").orderBy("address"))
    return (
        dealt.withColumn("place", place)
        .join(F.broadcast(offsets), "lane")  # at most LANES rows
        .select("address", (last + F.col("offset") + F.col("place")).alias("id"))
    )


def hour_bitmaps(flows: DataFrame, numbered: DataFrame, address: str) -> DataFrame:
    """(received_hour, bucket, bits): the distinct values of ``address`` per hour.

    Flows of an hour and address are one row before they meet the numbers, so a hot
    address is no hot key."""
    pairs = flows.select("received_hour", F.col(address).alias("address")).where("address IS NOT NULL").distinct()
    return (
        pairs.join(numbered, "address")
        .groupBy("received_hour", F.bitmap_bucket_number("id").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    )


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """``hour_bitmaps`` from those of several parts."""
    return bitmaps.groupBy("received_hour", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def merged_count(bitmaps: DataFrame, name: str, *keys: str) -> DataFrame:
    """Distinct values per ``keys`` over all ``bitmaps``: or, then count bits."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))
