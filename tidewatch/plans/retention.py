"""Freeing the storage of expired live rows."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from tidewatch.operators.retention import RETENTION_HOURS
from tidewatch.sources import files
from tidewatch.streaming import folding

PARTITION_PREFIX = "event_date="


def expire_days(
    spark: SparkSession,
    table: str,
    hours: int = RETENTION_HOURS,
    as_of: datetime | None = None,
) -> list[str]:
    """Delete the day folders of a live table that lie wholly before the cutoff.

    Rows of the cutoff's own day stay stored; readers leave expired ones out with
    ``operators.retention.keep_recent``. No data file is rewritten, so a running query loses
    nothing it may still return. ``as_of`` carries a zone; days are UTC days, as the writers'
    session zone makes them. Returns the deleted days.
    """
    now = as_of.astimezone(timezone.utc) if as_of else datetime.now(timezone.utc)
    cutoff = now - timedelta(hours=hours)
    days = [name.removeprefix(PARTITION_PREFIX) for name in files.names(spark, table)
            if name.startswith(PARTITION_PREFIX)]
    expired = [day for day in days if date.fromisoformat(day) < cutoff.date()]
    for day in expired:
        files.delete(spark, f"{table.rstrip('/')}/{PARTITION_PREFIX}{day}")
    return expired


def expire_levels(
    spark: SparkSession,
    table: str,
    hours: int = RETENTION_HOURS,
    as_of: datetime | None = None,
) -> list[str]:
    """``expire_days`` for a live table and the levels its batches were folded into."""
    levels = [folding.level_path(table, level) for level in range(folding.LEVELS)]
    return sorted({day for path in levels for day in expire_days(spark, path, hours, as_of)})
