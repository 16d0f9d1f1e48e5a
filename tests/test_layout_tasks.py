"""Work of one task when exports are laid out."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from flowlake.plans import layout
from flowlake.schema import DECODED


def test_a_task_sorts_a_bounded_number_of_rows(spark, tmp_path):
    times = {"time_received_ns": F.col("id") * 20_000_000}
    flows = spark.range(4_000_000).select(
        *[times.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DECODED]
    )
    layout.compact(flows, str(tmp_path / "days"))
    rows = [pq.ParquetFile(file).metadata.num_rows for file in (tmp_path / "days").rglob("*.parquet")]
    assert sum(rows) == 4_000_000 and max(rows) < 3_000_000
