"""What placing a row along the curve works out."""

from pyspark.sql import functions as F

from flowlake.operators.clustering import slot_of


def test_a_value_is_worked_out_once_for_all_steps(spark):
    bounds = [i / 1000 for i in range(1000)]
    rows = spark.range(0, 500, 1, 1)
    drawn = [r.v for r in rows.select(F.rand(5).alias("v")).collect()]
    slots = [r.s for r in rows.select(slot_of(F.rand(5), bounds).alias("s")).collect()]
    assert slots == [sum(b <= v for b in bounds) for v in drawn]
