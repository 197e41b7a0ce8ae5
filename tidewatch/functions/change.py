"""Expressions over the live tables: classification of a change and of a traffic window."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class bounds (exclusive) and labels of the live monitor.
MAJOR_ABOVE = 1000
MODERATE_ABOVE = 100
IMPACT_RANGE = (5, 500)
WINDOW_SECONDS = 10
BYTES_PER_MB = 1024 * 1024


def severity(bytes_changed: Column) -> Column:
    size = F.abs(bytes_changed)
    return (
        F.when(size > MAJOR_ABOVE, "Major").when(size > MODERATE_ABOVE, "Moderate").otherwise("Minor")
    )


def change_type(length_diff: Column) -> Column:
    """Aggregate feed: no change counts as an addition, an unknown one as a deletion."""
    return F.when(length_diff >= 0, "Addition").otherwise("Deletion")


def direction(length_diff: Column) -> Column:
    """Scatter feed: no change counts as a deletion."""
    return F.when(length_diff > 0, "Addition").otherwise("Deletion")


def impact(bytes_changed: Column) -> Column:
    """Absolute size clipped to the plotting range; null stays null."""
    low, high = IMPACT_RANGE
    clipped = F.greatest(F.lit(low), F.least(F.lit(high), F.abs(bytes_changed)))
    return F.when(bytes_changed.isNotNull(), clipped)


def title_namespace(title: Column) -> Column:
    return F.split_part(title, F.lit(":"), F.lit(1))


def server_language(server_name: Column) -> Column:
    """First host label, the whole name when it has no dot."""
    return F.split_part(server_name, F.lit("."), F.lit(1))


def events_per_second(event_count: Column, window_seconds: int = WINDOW_SECONDS) -> Column:
    return event_count.cast("double") / F.lit(window_seconds)


def avg_bytes_per_event(total_bytes: Column, event_count: Column) -> Column:
    return F.when(
        event_count > 0, total_bytes.cast("double") / event_count
    ).otherwise(F.lit(0.0))


def megabytes(total_bytes: Column) -> Column:
    return total_bytes.cast("double") / F.lit(BYTES_PER_MB)
