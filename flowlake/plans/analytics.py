"""The periodic analytics job: refresh the marts, then expire old exports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from flowlake.plans.refresh import refresh_marts
from flowlake.plans.retention import RETENTION_DAYS, expire_exports
from flowlake.sources.files import list_files


def run_analytics(
    spark: SparkSession,
    export_root: str,
    mart_root: str,
    retention_days: int = RETENTION_DAYS,
    now: datetime | None = None,
    dry_run: bool = True,
) -> dict:
    """Refresh, and only after that has been published, expire.

    A refresh that fails raises, so nothing is deleted.  The marts drop what
    expired at the next refresh.  ``dry_run`` concerns the deletion only.
    """
    tables = refresh_marts(spark, export_root, mart_root)
    report = expire_exports(spark, list_files(spark, export_root), retention_days, now, dry_run)
    return {"tables": sorted(tables), **report}
