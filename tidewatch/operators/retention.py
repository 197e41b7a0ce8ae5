"""Retention of the live tables, as a filter."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import clock

# Fixed value: how long live rows are kept.
RETENTION_HOURS = 24


def keep_recent(
    df: DataFrame, time: str, hours: int = RETENTION_HOURS, as_of: clock.AsOf = None
) -> DataFrame:
    return df.filter(F.col(time) >= clock.hours_before(as_of, hours))
