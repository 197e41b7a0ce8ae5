"""Time expressions. Every time-relative operator takes ``as_of`` instead of reading a clock."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

AsOf = Column | datetime | None


def moment(as_of: AsOf) -> Column:
    """``as_of`` as a timestamp column; None means the query's start time."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def minutes_before(as_of: AsOf, minutes: int) -> Column:
    return moment(as_of) - F.make_interval(mins=F.lit(minutes))


def hours_before(as_of: AsOf, hours: int) -> Column:
    return moment(as_of) - F.make_interval(hours=F.lit(hours))


def days_before(as_of: AsOf, days: int) -> Column:
    """Exactly ``days`` times 24 hours, whatever the session zone."""
    return hours_before(as_of, 24 * days)


def timestamp_of(df: DataFrame, column: str) -> Column:
    """``column`` as a timestamp, whether it holds one or epoch seconds."""
    if isinstance(df.schema[column].dataType, TimestampType):
        return F.col(column)
    return F.timestamp_seconds(F.col(column))


def hour_of(timestamp: Column) -> Column:
    return F.date_trunc("hour", timestamp)


def minute_of(timestamp: Column) -> Column:
    return F.date_trunc("minute", timestamp)
