"""Figures of stored tables, where their sums pass a long."""

from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_moments_whose_sum_passes_a_long(spark):
    rows = 100_000
    micros = 1_004_832_000_000_001  # 2001-11-04 and a microsecond
    times = spark.range(rows).select(F.timestamp_micros(F.lit(micros)).alias("at"))
    (found,) = entry._figures("t", times.unionAll(spark.sql("SELECT CAST(NULL AS TIMESTAMP)"))).collect()
    total = rows * (micros - entry.EPOCH_MICROS)
    assert total > 2**63
    assert (found.rows, found.column, found.filled) == (rows + 1, "at", rows)
    assert found.total == round(float(total) / 1000000, 3)
