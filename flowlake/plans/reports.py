"""What the dashboard page shows, read from marts (stored or just computed)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.times import days_before, partition_key
from flowlake.plans.marts import order_of, traffic_by_hour

# Rows shown.
CHART_BARS = 20
CONVERSATIONS = 20
LATEST_SHOWN = 100
DAYS_SHOWN = 7


def hourly_traffic(
    hours: DataFrame, as_of: date | Column | None = None, days: int = DAYS_SHOWN
) -> DataFrame:
    """Hours from midnight ``days`` before ``as_of`` (default: today)."""
    return hours.where(F.col("hour") >= _first_moment(as_of, days)).orderBy(
        *order_of("traffic_by_hour")
    )


def _first_moment(as_of: date | Column | None, days: int) -> Column:
    if as_of is None:
        day = F.current_date()
    else:
        day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return days_before(day, days)


def hourly_traffic_of(
    flows: DataFrame, as_of: date | Column | None = None, days: int = DAYS_SHOWN
) -> DataFrame:
    """``hourly_traffic`` straight from staged flows.

    An hour is labelled by its end, so the first one shown began an hour before
    midnight.  That bound reaches the scan, and on a table by day skips days.
    """
    start = _first_moment(as_of, days) - F.expr("INTERVAL 1 HOUR")
    recent = flows.where(F.col("received_hour") >= start)
    if "day" in flows.columns:
        recent = recent.where(F.col("day") >= partition_key(start))
    return hourly_traffic(traffic_by_hour(recent), as_of, days)


def top_conversations(matrix: DataFrame, k: int = CONVERSATIONS) -> DataFrame:
    return matrix.orderBy(*order_of("traffic_matrix")).limit(k)


def latest_flows(recent: DataFrame, k: int = LATEST_SHOWN) -> DataFrame:
    return recent.orderBy(*order_of("recent_flows")).limit(k)


def _bars(mart: DataFrame, name: str, label: str, k: int) -> DataFrame:
    return mart.orderBy(*order_of(name)).limit(k).select(label, "mb")


def source_chart(talkers: DataFrame, k: int = CHART_BARS) -> DataFrame:
    return _bars(talkers, "top_talkers_by_bytes", "src_addr", k)


def destination_chart(destinations: DataFrame, k: int = CHART_BARS) -> DataFrame:
    return _bars(destinations, "top_destinations", "dst_addr", k)


def service_chart(ports: DataFrame, k: int = CHART_BARS) -> DataFrame:
    """Megabytes of the services with most connections (not with most bytes)."""
    return _bars(ports, "top_ports", "service", k)
