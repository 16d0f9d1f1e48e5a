"""Time the export, staging and mart jobs; prints one JSON line.

Follows the order of a production run: raw flows are decoded and exported,
exports are staged, marts read the staging table, and a refresh builds all
tables at once.  ``queries`` holds the fastest of the warm runs, ``cold`` the
first run of each job in this session (start-up of the session not counted).
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from datetime import date

from flowlake.operators.decode import decode_flows
from flowlake.operators.flags import export_census
from flowlake.operators.staging import stage_flows
from flowlake.plans import layout, marts, refresh, reports
from flowlake.session import build_session, scratch_path
from flowlake.sources.files import read_exports, read_raw, write_export, write_table
from flowlake.sources.samples import sample_raw_flows

WARM_RUNS = 3


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "bench")
    sample_raw_flows(spark, tables).repartition(int(cpus)).write.parquet(f"{root}/raw")
    raw = read_raw(spark, f"{root}/raw")
    runs = iter(range(10_000))

    def export() -> None:
        write_export(decode_flows(raw), f"{root}/exports-{next(runs)}", "ipfix_decoded_0.parquet")

    write_export(decode_flows(raw), f"{root}/exports", "ipfix_decoded_0.parquet")
    decoded = read_exports(spark, f"{root}/exports")
    flows = write_table(stage_flows(decoded), f"{root}/flows")

    grown, marts_root = f"{root}/grown", f"{root}/marts-of-grown"
    write_export(decoded, grown, "ipfix_decoded_0.parquet")
    refresh.refresh_marts(spark, grown, marts_root)

    def second() -> None:
        """One more export of a twentieth of the flows, and a refresh."""
        number = next(runs)
        write_export(decoded.where(f"pmod(time_received_ns, 20) = {number % 20}"), grown, f"ipfix_decoded_{number}.parquet")
        refresh.refresh_marts(spark, grown, marts_root)

    jobs: dict[str, Callable[[], object]] = {
        "decode_flows": export,
        "export_census": lambda: export_census(raw).collect(),
        "stg_flows": lambda: write_table(stage_flows(decoded), f"{root}/stg-{next(runs)}"),
        "overview_stats": lambda: marts.overview_stats(flows).collect(),
        "top_talkers_by_bytes": lambda: marts.top_talkers_by_bytes(flows).collect(),
        "top_destinations": lambda: marts.top_destinations(flows).collect(),
        "top_ports": lambda: marts.top_ports(flows).collect(),
        "protocol_breakdown": lambda: marts.protocol_breakdown(flows).collect(),
        "traffic_by_hour": lambda: _drain(marts.traffic_by_hour(flows)),
        "traffic_matrix": lambda: marts.traffic_matrix(flows).collect(),
        "recent_flows": lambda: _drain(marts.recent_flows(flows)),
        "hourly_traffic": lambda: _drain(
            reports.hourly_traffic_of(flows, date(2000, 1, 1))
        ),
        "day_report": lambda: _drain(layout.day_report(flows)),
        "mart_refresh": lambda: refresh.build_marts(decoded, f"{root}/marts-{next(runs)}"),
        "second_refresh": lambda: second(),
    }
    cold, warm = {}, {}
    for name, job in jobs.items():
        times = []
        for _ in range(1 + WARM_RUNS):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total warm time of all jobs",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(tables.rstrip("/")).removeprefix("sf"),
                "flows": flows.count(),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


def _drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


if __name__ == "__main__":
    main()
