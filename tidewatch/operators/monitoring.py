"""Monitors over the live and historical tables."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import clock

# Windows of the monitors.
AVG_CHANGE_MINUTES = 60
SILENCE_MINUTES = 5


def keyword_monitor(changes: DataFrame, keywords: list[str]) -> DataFrame:
    """Changes whose title or user contains a keyword, whatever the case."""
    if not keywords:
        return changes.limit(0)
    text = [F.lower("title"), F.lower("user")]
    hits = [field.contains(word.lower()) for word in keywords for field in text]
    return changes.filter(reduce(lambda left, right: left | right, hits))


def average_change(
    changes: DataFrame, minutes: int = AVG_CHANGE_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """Mean absolute change per server, largest first."""
    return (
        changes.filter(F.col("event_time") >= clock.minutes_before(as_of, minutes))
        .groupBy("server_name")
        .agg(F.avg(F.abs("bytes_changed")).alias("avg_change"))
        .orderBy(F.desc("avg_change"), F.asc_nulls_first("server_name"))
    )


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: clock.AsOf = None) -> DataFrame:
    """Latest time and its age in seconds per table; ``tables`` maps a name to a DataFrame and
    its time column. An empty table has nulls."""

    def latest(name: str, df: DataFrame, time: str) -> DataFrame:
        newest = df.agg(F.max(time).alias("latest"))
        age = F.unix_seconds(clock.moment(as_of)) - F.unix_seconds("latest")
        return newest.select(F.lit(name).alias("table_name"), "latest", age.alias("age_seconds"))

    return reduce(
        DataFrame.unionByName, [latest(name, df, time) for name, (df, time) in tables.items()]
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table. On stored tables the counts come from file footers."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ],
    )


def hourly_spikes(trends: DataFrame, threshold: float | None = None) -> DataFrame:
    """Hours against their trailing 24 h mean; with ``threshold``, only those at or above it."""
    ratios = trends.select(
        "hour_bucket",
        "total_events",
        "events_24h_avg",
        (F.col("total_events") / F.col("events_24h_avg")).alias("spike_ratio"),
    )
    return ratios if threshold is None else ratios.filter(F.col("spike_ratio") >= threshold)


def silence_now(
    changes: DataFrame, minutes: int = SILENCE_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """The silence that goes on at ``as_of``: one row with an open end if the last event is at least
    ``minutes`` old, else none; none either without any event."""
    start = F.col("gap_start")
    now = F.unix_seconds(clock.minute_of(clock.moment(as_of)))
    return (
        changes.agg(clock.minute_of(F.max("event_time")).alias("gap_start"))
        .select(
            "gap_start",
            F.lit(None).cast("timestamp").alias("gap_end"),
            F.floor((now - F.unix_seconds(start)) / 60).alias("gap_minutes"),
        )
        .filter(F.col("gap_minutes") >= minutes)
    )


def silence_gaps(changes: DataFrame, minutes: int = SILENCE_MINUTES) -> DataFrame:
    """Stretches without events: pairs of consecutive active minutes at least ``minutes`` apart.

    Events shrink to active minutes first, at most 1,440 a day. Minutes are then ordered per
    day; only the first minute of each day still lacks its predecessor, and it is the last minute
    of the previous active day. Those first minutes, one per day, are ordered together.
    """
    minute = F.col("minute")
    active = changes.select(clock.minute_of(F.col("event_time")).alias("minute")).distinct()
    day = F.date_trunc("day", minute)
    within_day = Window.partitionBy(day)
    placed = active.select(
        "minute",
        F.lag(minute).over(within_day.orderBy("minute")).alias("_before"),
        F.max(minute).over(within_day).alias("_day_end"),
    )
    # Rows that have a predecessor are grouped by day again and ignore the result.
    first_of_day = F.col("_before").isNull()
    across_days = Window.partitionBy(F.when(~first_of_day, day)).orderBy("minute")
    gap_start = F.coalesce("_before", F.lag("_day_end").over(across_days))
    return (
        placed.select(gap_start.alias("gap_start"), minute.alias("gap_end"))
        .withColumn(
            "gap_minutes",
            F.floor((F.unix_seconds("gap_end") - F.unix_seconds("gap_start")) / 60),
        )
        .filter(F.col("gap_minutes") >= minutes)
    )
