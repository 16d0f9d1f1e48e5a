"""Marts on hand-made flows: nulls, no rows, ties, one hot key, and plan shapes."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowlake.operators.rollup import destination_totals, port_totals, source_totals
from flowlake.operators import distinct
from flowlake.operators.rollup import pair_totals, totals_by_hour
from flowlake.operators.topk import top_rows, top_sums
from flowlake.plans import marts, reports
from flowlake.schema import STAGED
from flowlake.sources.files import write_table

START = datetime(2024, 5, 1, 10, 0, 0)


def flow(at=START, size=1024, src="a", dst="b", port=443, proto=6, packets=1, src_port=50000):
    hour = at and at.replace(minute=0, second=0, microsecond=0)
    day = at and at.replace(hour=0, minute=0, second=0, microsecond=0)
    gb = None if size is None else size / 2**30
    return (at, hour, day, size, gb, packets, src, dst, src_port, port, proto)


def staged(spark, rows):
    return spark.createDataFrame(rows, STAGED)


def random_flows(count, seed=1):
    """A third of all flows has one source, one second and one destination port."""
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        if draw.random() < 1 / 3:
            rows.append(flow(START, draw.randrange(10**6), "hot", f"d{draw.randrange(50)}", 53, 17))
        else:
            at = START + timedelta(microseconds=draw.randrange(3 * 3600 * 10**6) - 90 * 60 * 10**6)
            rows.append(
                flow(
                    at,
                    draw.randrange(10**6),
                    draw.choice(["s1", "s2", "s3", None]),
                    draw.choice(["d1", "d2", None]),
                    draw.choice([22, 443, 50000, None]),
                    draw.choice([6, 99, None]),
                )
            )
    return rows


def in_order(build, *args):
    return build(*args).orderBy(*marts.order_of(build.__name__)).collect()


def test_no_flows(spark):
    empty = staged(spark, [])
    zero = (0, None, 0, 0, None, None)
    assert tuple(marts.overview_stats(empty).first()) == zero
    for build in (
        marts.top_talkers_by_bytes,
        marts.top_destinations,
        marts.top_ports,
        marts.protocol_breakdown,
        marts.traffic_by_hour,
        marts.traffic_matrix,
        marts.recent_flows,
    ):
        assert build(empty).collect() == []


def test_nulls(spark):
    flows = staged(
        spark,
        [
            flow(None, None, None, None, None, None, None, None),
            flow(src="a", dst=None),
            flow(src="a", dst="b"),
        ],
    )
    assert tuple(marts.overview_stats(flows).first()) == (3, 2048 / 2**30, 1, 1, START, START)
    talkers = [tuple(r) for r in marts.top_talkers_by_bytes(flows).collect()]
    assert talkers == [("a", 2048 / 2**20, 2, 2, 1), (None, None, None, 1, 0)]
    ports = [tuple(r) for r in marts.top_ports(flows).collect()]
    assert ports == [(443, "HTTPS", 2, 2048 / 2**20), (None, None, 1, None)]
    protocols = [tuple(r) for r in in_order(marts.protocol_breakdown, flows)]
    assert protocols == [(6, "TCP", 2, 2048 / 2**30), (None, "PROTO-", 1, None)]
    hours = [tuple(r) for r in in_order(marts.traffic_by_hour, flows)]
    assert hours == [
        (START + timedelta(hours=1), 2048 / 2**30, 2, 1024.0, 1, 1),
        (None, None, 1, None, 0, 0),
    ]
    assert marts.recent_flows(flows, k=3).collect()[-1]["received_at"] is None


def test_ties_are_broken_by_key(spark):
    rows = [flow(src=f"s{i:03}", dst=f"d{i:03}", port=i) for i in range(200)]
    random.Random(2).shuffle(rows)
    flows = staged(spark, rows)
    assert [r.src_addr for r in marts.top_talkers_by_bytes(flows).collect()] == [
        f"s{i:03}" for i in range(100)
    ]
    assert [r.dst_port for r in marts.top_ports(flows).collect()] == list(range(50))
    assert [r.dst_addr for r in marts.traffic_matrix(flows, k=20).collect()] == [
        f"d{i:03}" for i in range(20)
    ]


def test_marts_by_brute_force_with_a_hot_key(spark):
    rows = random_flows(5000)
    flows = staged(spark, rows)
    sizes, packets, counts, peers = Counter(), Counter(), Counter(), defaultdict(set)
    for row in rows:
        src = row[6]
        sizes[src] += row[3]
        packets[src] += row[5]
        counts[src] += 1
        if row[7] is not None:
            peers[src].add(row[7])
    expected = {
        src: (sizes[src] / 2**20, packets[src], counts[src], len(peers[src])) for src in sizes
    }
    got = {r[0]: tuple(r)[1:] for r in marts.top_talkers_by_bytes(flows).collect()}
    assert got == expected


def test_shared_totals_give_the_same_marts(spark):
    flows = staged(spark, random_flows(4000)).cache()
    sources, destinations = source_totals(flows), destination_totals(flows)
    ports = port_totals(flows)
    for build, totals in (
        (marts.overview_stats, (sources, destinations)),
        (marts.top_talkers_by_bytes, (sources,)),
        (marts.top_destinations, (destinations,)),
        (marts.top_ports, (ports,)),
        (marts.protocol_breakdown, (ports,)),
    ):
        assert sorted(build(flows, *totals).collect(), key=str) == sorted(build(flows).collect(), key=str)


def latest(rows, k):
    names = STAGED.names
    shown = [n.lstrip("-") for n in marts.ORDER["recent_flows"]]
    picked = [tuple(row[names.index(n)] for n in shown) for row in rows]

    def key(row):
        at, *rest = row
        newest = (at is None, -(at.timestamp() if at else 0))
        # A null only ever meets values by its flag, so types do not mix.
        return newest, [(v is None, v if v is not None else 0) for v in rest]

    return sorted(picked, key=key)[:k]


@pytest.mark.parametrize("k", [1, 100, 1700, 2500, 9000])
def test_latest_rows_by_brute_force(spark, k):
    rows = random_flows(4000, seed=4) + [flow(None, 5)] * 3
    flows = staged(spark, rows).repartition(16)
    got = [tuple(r) for r in marts.recent_flows(flows, k).collect()]
    assert got == latest(rows, k)


def test_top_rows_merges_in_rounds(spark):
    # More tasks than groups in either round, and a third of the rows equal.
    frame = spark.range(3000, numPartitions=40).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v")
    )
    got = [r.v for r in top_rows(frame, [F.desc("v")], 500, rounds=(5, 2)).collect()]
    assert got == sorted((7 if i % 3 == 0 else i for i in range(3000)), reverse=True)[:500]


def test_reports(spark):
    hours = spark.createDataFrame(
        [(datetime(2024, 5, d, h),) for d in range(1, 20) for h in (0, 12)], "hour timestamp"
    )
    kept = reports.hourly_traffic(hours, date(2024, 5, 15)).collect()
    assert kept[0].hour == datetime(2024, 5, 8) and kept[-1].hour == datetime(2024, 5, 19, 12)
    assert reports.hourly_traffic(hours).count() == 0
    ports = staged(spark, [flow(port=p, size=p) for p in (22, 80) for _ in range(p)])
    chart = reports.service_chart(marts.top_ports(ports)).collect()
    assert [r.service for r in chart] == ["HTTP", "SSH"] and chart[0].asDict().keys() == {"service", "mb"}


# --- plans -------------------------------------------------------------------


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "flows")
    return write_table(staged(spark, random_flows(3000)), path)


def test_marts_read_only_their_columns(stored):
    assert "ReadSchema: struct<bytes:bigint,dst_port:int>" in plan_of(marts.top_ports(stored))
    assert "ReadSchema: struct<bytes:bigint,proto:int>" in plan_of(marts.protocol_breakdown(stored))
    assert "ReadSchema: struct<bytes:bigint,src_addr:string,dst_addr:string>" in plan_of(
        marts.traffic_matrix(stored)
    )


def test_marts_combine_before_the_shuffle_and_merge_in_rounds(stored):
    for build, shuffles in (
        (marts.top_talkers_by_bytes, 5),
        (marts.top_destinations, 5),
        (marts.traffic_matrix, 3),
        (marts.top_ports, 1),
    ):
        plan = plan_of(build(stored))
        assert "partial_" in plan and "TakeOrderedAndProject" in plan
        assert plan.count("Exchange hashpartitioning") == shuffles
        assert "rangepartitioning" not in plan
        if build is not marts.top_ports:
            # Each round prunes before its shuffle, so none receives k rows per task.
            assert plan.count("WindowGroupLimit") == 4
            assert "hashpartitioning(_lane" in plan


def test_no_python_and_only_small_sides_are_broadcast(stored):
    for name in marts.ORDER:
        plan = plan_of(getattr(marts, name)(stored))
        for word in ("Cartesian", "NestedLoop", "SortMergeJoin", "Python", "Pandas", "Expand"):
            assert word not in plan
        if name in ("top_talkers_by_bytes", "top_destinations"):
            # The broadcast side is the capped list, the other side the flows.
            below = plan[plan.index("BroadcastExchange") :]
            assert below.index("TakeOrderedAndProject(limit=100") < below.index("FileScan")
        else:
            assert "Broadcast" not in plan
    for build in (marts.top_talkers_by_bytes, marts.top_destinations):
        # Millions of winners are not sent around; the small flow table here is.
        plan = plan_of(build(stored, k=5_000_000))
        below = plan[plan.index("BroadcastExchange") :]
        assert "TakeOrderedAndProject" not in below[: below.index("FileScan")]


@pytest.mark.parametrize("k", [100, 100_000])
def test_latest_rows_push_their_time_filter_and_prune_before_each_shuffle(stored, k):
    plan = plan_of(marts.recent_flows(stored, k))
    assert "GreaterThanOrEqual(received_hour,ScalarSubquery" in plan
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Partial") >= 2


def test_seven_days_reach_the_scan(stored):
    plan = plan_of(reports.hourly_traffic_of(stored, date(2024, 5, 15)))
    assert plan.count("GreaterThanOrEqual(received_hour,2024-05-07 23:00:00.0)") == 2


# --- merged parts ------------------------------------------------------------


def test_top_sums_like_adding_up(spark):
    """Keys spread over parts, ties at the cut, null keys and values, empty parts."""
    draw = random.Random(7)
    names = [None, *[f"k{i}" for i in range(40)]]
    tables = [
        {name: draw.choice([None, 0, 1, 5, 5, draw.randrange(1000)]) for name in names if draw.random() < 0.6}
        for _ in range(4)
    ] + [{}, {"hot": 10**15, "k1": 5}]
    parts = [
        spark.createDataFrame([(a, "x", v, 1) for a, v in t.items()], "a string, b string, v long, n long") for t in tables
    ]
    want = defaultdict(lambda: [None, 0])
    for t in tables:
        for name, value in t.items():
            if value is not None:
                want[name][0] = (want[name][0] or 0) + value
            want[name][1] += 1
    rank = lambda row: (row[1] is None, -(row[1] or 0), row[0] is None, row[0] or "")
    rows = sorted(((name, v, n) for name, (v, n) in want.items()), key=rank)
    order = [F.desc_nulls_last("v"), F.asc_nulls_last("a")]
    for k in (1, 7, 20, 39, 500):
        got = top_sums(parts, ["a", "b"], "v", order, k)
        assert [(r.a, r.v, r.n) for r in got.collect()] == rows[:k]


def test_marts_from_parts(spark):
    flows = [random_flows(700, seed) for seed in (1, 2, 3)] + [[flow(None, None, "new", None), flow(size=None, src=None)]]
    whole = staged(spark, [row for part in flows for row in part])
    parts = [staged(spark, rows) for rows in flows]
    numbered = spark.createDataFrame([], distinct.ADDRESSES)
    hours, sides = [], {"src_addr": [], "dst_addr": []}
    for part in parts:
        added = distinct.number_addresses(distinct.unnumbered(part, numbered), numbered)
        added = spark.createDataFrame(added.collect(), distinct.ADDRESSES)
        numbered = numbered.unionByName(added)
        hours.append(totals_by_hour(part))
        for side, found in sides.items():
            found.append(distinct.hour_bitmaps(part, numbered, side))

    def all_of(tables):
        found = tables[0]
        for table in tables[1:]:
            found = found.unionByName(table)
        return found

    merged = [all_of(hours), *[all_of(found) for found in sides.values()]]
    found = lambda df: sorted(map(str, df.collect()))
    assert found(marts.merged_hours(*merged)) == found(marts.traffic_by_hour(whole))
    assert found(marts.merged_overview(*merged)) == found(marts.overview_stats(whole))
    empty = [df.limit(0) for df in merged]
    assert found(marts.merged_overview(*empty)) == found(marts.overview_stats(whole.limit(0)))
    pairs = [pair_totals(part) for part in parts]
    assert found(marts.merged_matrix(pairs, 30)) == found(marts.traffic_matrix(whole, 30))
    latest = all_of([marts.recent_flows(part, 40) for part in parts])
    assert found(marts.merged_recent(latest, 40)) == found(marts.recent_flows(whole, 40))
    ids = sorted(r.id for r in numbered.collect())
    assert ids == list(range(1, len(ids) + 1))
