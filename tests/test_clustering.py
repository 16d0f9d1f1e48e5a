"""Clustering by time and addresses, against Python."""

import random
from datetime import datetime, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowlake.operators.clustering import SLOT_BITS, address_order, interleaved, slot_bounds, slot_of
from flowlake.operators.staging import stage_flows
from flowlake.plans import layout
from flowlake.schema import DECODED

START = int(datetime(2024, 5, 1, tzinfo=timezone.utc).timestamp()) * 10**9


def test_addresses_keep_the_order_of_their_text(spark):
    draw = random.Random(1)
    v4 = [".".join(str(draw.choice([0, 1, 10, 100, 255, draw.randrange(256)])) for _ in range(4)) for _ in range(400)]
    v6 = [":".join(f"{draw.choice([0, 1, draw.randrange(65536)]):x}" for _ in range(8)) for _ in range(200)]
    texts = [*v4, *v6, "::", "::1", "::ffff:1.2.3.4", "1.1.1.1", "1.1.1.11", "255.255.255.255", "unknown"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", address_order(F.col("t")).alias("n"))
    found = sorted((r.t.encode(), r.n) for r in rows.collect())
    numbers = [n for _, n in found]
    assert numbers == sorted(numbers)
    assert len({n for t, n in found if b"." in t and len(t) < 16}) == len({t for t, _ in found if b"." in t and len(t) < 16})
    odd = spark.createDataFrame([(None,), ("",), ("é",)], "t string").select(address_order(F.col("t")).alias("n"))
    assert [r.n for r in odd.collect()] == [-1, 18**15, 18**15]


def test_slots_and_interleaving(spark):
    bounds = [1, 3, 3, 3, 8, 20, 21]
    values = spark.range(-2, 25).select("id", slot_of(F.col("id"), bounds).alias("slot"), slot_of(F.col("id"), []).alias("none"))
    assert all(r.slot == sum(b <= r.id for b in bounds) and r.none == 0 for r in values.collect())
    draw = random.Random(2)
    triples = [tuple(draw.randrange(1 << SLOT_BITS) for _ in range(3)) for _ in range(200)] + [(0, 0, 0), (1023,) * 3]
    rows = spark.createDataFrame(triples, "a int, b int, c int").select("*", interleaved(*map(F.col, "abc")).alias("z"))
    for r in rows.collect():
        want = "".join(c + b + a for a, b, c in zip(*[f"{v:010b}" for v in (r.a, r.b, r.c)], strict=True))
        assert r.z == int(want, 2)
    n, (found,) = slot_bounds(spark.range(10_000), F.col("id"))
    assert n == 10_000 and all(abs(b - 10_000 * (i + 1) / 1024) <= 20 for i, b in enumerate(found))
    assert slot_bounds(spark.range(0), F.col("id")) == (0, [[]])


@pytest.fixture(scope="module")
def flows(spark):
    """A day of flows; one source has a third of them, some have no address."""
    draw = random.Random(3)
    rows = []
    for i in range(24_000):
        source = "10.0.0.1" if i % 3 == 0 else f"10.{draw.randrange(20)}.0.{draw.randrange(20)}"
        target = None if i % 500 == 0 else f"192.0.{draw.randrange(30)}.{draw.randrange(30)}"
        rows.append((START + draw.randrange(86_400 * 10**9), source, target, i))
    frame = spark.createDataFrame(rows, "t long, s string, d string, i long")
    given = {"time_received_ns": "t", "src_addr": "s", "dst_addr": "d", "bytes": "i"}
    columns = [F.col(given[f.name]) if f.name in given else F.lit(None).cast(f.dataType) for f in DECODED]
    return frame.select(*[c.alias(f.name) for f, c in zip(DECODED, columns, strict=True)]).cache()


def touched(path, column, value):
    """Share of the files whose footers cannot rule ``value`` out."""
    files = [pq.ParquetFile(p) for p in Path(path).rglob("*.parquet")]
    place = files[0].schema_arrow.names.index(column)
    spans = [f.metadata.row_group(0).column(place).statistics for f in files]
    return sum(s.has_min_max and s.min <= value <= s.max for s in spans) / len(files)


def test_a_filter_on_one_address_reads_few_files(spark, flows, tmp_path):
    layout.compact(flows, f"{tmp_path}/plain", rows_per_file=100)
    layout.compact(flows, f"{tmp_path}/by_address", rows_per_file=100, by_address=True)
    table = layout.read_days(spark, f"{tmp_path}/by_address")
    assert table.drop("day").exceptAll(flows).isEmpty() and flows.exceptAll(table.drop("day")).isEmpty()
    for column, value in (("src_addr", "10.7.0.7"), ("src_addr", "10.15.0.3"), ("dst_addr", "192.0.20.4")):
        assert touched(f"{tmp_path}/plain", column, value) > 0.9
        assert touched(f"{tmp_path}/by_address", column, value) < 0.35
    noon = START + 43_200 * 10**9
    assert touched(f"{tmp_path}/by_address", "time_received_ns", noon) < 0.35
    # The hot source is spread over as many files as it fills.
    sizes = [pq.ParquetFile(p).metadata.num_rows for p in Path(f"{tmp_path}/by_address").rglob("*.parquet")]
    assert len(sizes) > 200 and max(sizes) < 300
    # The filter reaches the scan.
    plan = stage_flows(table).where("src_addr = '10.7.0.7'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(src_addr,10.7.0.7)" in plan


def test_days_without_flows_or_times(spark, flows, tmp_path):
    odd = flows.limit(3).withColumn("time_received_ns", F.lit(None).cast("long")).withColumn("src_addr", F.lit(None).cast("string"))
    layout.compact(odd, f"{tmp_path}/odd", by_address=True)
    assert layout.read_days(spark, f"{tmp_path}/odd").where("src_addr IS NULL").count() == 3
    layout.compact(flows.limit(0), f"{tmp_path}/none", by_address=True)
