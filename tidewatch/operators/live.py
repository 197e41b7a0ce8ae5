"""The live tables and the queries the live monitor asks of them.

Queries over recent changes take ``event_time`` rows, queries over traffic take ``window_start``
rows. All look back ``minutes`` from ``as_of``; the bound is a plain comparison on the time
column, so it reaches the scan.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import change, clock
from tidewatch.functions import event as ev
from tidewatch.operators.ordering import descending, top_k, value_counts

# Window, sizes and thresholds of the live monitor.
LOOKBACK_MINUTES = 30
TOP_N = 12
TOP_NAMESPACES = 20
LATEST_POINTS = 500
LATEST_CHANGES = 400
POWER_USER_EDITS = 10
HISTOGRAM_BINS = 20
COUNT_WINDOW = 100
# Offsets numbered together.
OFFSET_SPAN = 100_000
UNKNOWN = "unknown"
NO_SERVER = "N/A"
LEADERBOARD_NAMES = {"total_edits": "Edits", "total_bytes": "Bytes", "server_name": "Server"}


# --- building the live tables -------------------------------------------------------------


def recent_changes(
    events: DataFrame, keep_null_flags: bool = False, carry: list[str] | None = None
) -> DataFrame:
    """One row per event with the feed's defaults for missing values.

    ``carry`` names further input columns to keep, such as an id to break ties with.
    """
    return events.select(
        clock.timestamp_of(events, "timestamp").alias("event_time"),
        F.coalesce("user", F.lit(UNKNOWN)).alias("user"),
        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
        F.coalesce("server_name", F.lit(UNKNOWN)).alias("server_name"),
        ev.flag(F.col("bot"), keep_null_flags).alias("is_bot"),
        F.coalesce("type", F.lit("edit")).alias("type"),
        F.coalesce("bytes_changed", F.lit(0)).alias("bytes_changed"),
        ev.length_diff(F.col("length")).alias("length_diff"),
        *(carry or []),
    )


def with_average(traffic: DataFrame) -> DataFrame:
    """Traffic rows in table shape: the stored average is computed when a row is written."""
    return traffic.select(
        "window_start",
        "total_bytes",
        "event_count",
        change.avg_bytes_per_event(F.col("total_bytes"), F.col("event_count")).alias(
            "avg_bytes_per_event"
        ),
    )


def traffic_totals() -> list[Column]:
    return [
        F.sum("bytes_changed").alias("total_bytes"),
        F.count(F.lit(1)).alias("event_count"),
    ]


def traffic_volume(changes: DataFrame, window: str = "10 seconds") -> DataFrame:
    """Bytes and events per tumbling event-time window. On a stream, set the watermark first."""
    return with_average(
        changes.groupBy(F.window("event_time", window).alias("_window"))
        .agg(*traffic_totals())
        .withColumn("window_start", F.col("_window.start"))
    )


def numbered_records(records: DataFrame) -> DataFrame:
    """``partition, event_time, bytes_changed`` and the ``number`` of each record in its topic
    partition, from 0, whatever offsets lie between them.

    Records are numbered within spans of offsets, and the spans by what was counted before them, so no
    partition is sorted as a whole.
    """
    span = F.floor(F.col("offset") / OFFSET_SPAN).alias("_span")
    placed = records.select("partition", "offset", "event_time", "bytes_changed", span)
    earlier = Window.partitionBy("partition").orderBy("_span").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = (
        placed.groupBy("partition", "_span")
        .agg(F.count(F.lit(1)).alias("_records"))
        .select(
            F.col("partition").alias("_partition"),
            F.col("_span").alias("_of"),
            F.coalesce(F.sum("_records").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    within = Window.partitionBy("partition", "_span").orderBy("offset")
    numbered = placed.withColumn("_number", F.row_number().over(within)).join(
        spans,
        F.col("partition").eqNullSafe(F.col("_partition")) & F.col("_span").eqNullSafe(F.col("_of")),
    )
    number = (F.col("_before") + F.col("_number") - 1).alias("number")
    return numbered.select("partition", "event_time", "bytes_changed", number)


def count_windows(numbered: DataFrame, size: int) -> DataFrame:
    """Sums per ``partition`` and ``window`` of ``size`` numbers, labelled with the latest event time."""
    window = F.floor(F.col("number") / size).alias("window")
    return numbered.groupBy("partition", window).agg(
        F.max("event_time").alias("window_start"), *traffic_totals()
    )


def traffic_count_window(records: DataFrame, size: int = COUNT_WINDOW) -> DataFrame:
    """Bytes and events per ``size`` consecutive records of a topic partition; the row is labelled with
    its latest event time. Only the last window of a partition may lack records, and is left out."""
    windows = count_windows(numbered_records(records), size)
    return windows.filter(F.col("event_count") == size).transform(with_average)


# --- queries ------------------------------------------------------------------------------


def _window_of(df: DataFrame, time: str, minutes: int, as_of: clock.AsOf) -> DataFrame:
    return df.filter(F.col(time) >= clock.minutes_before(as_of, minutes))


def _recent(changes: DataFrame, minutes: int, as_of: clock.AsOf) -> DataFrame:
    return _window_of(changes, "event_time", minutes, as_of)


def _edits() -> Column:
    return F.count(F.lit(1))


def _moved(column: str) -> Column:
    return F.sum(F.abs(column))


def live_traffic(
    traffic: DataFrame, minutes: int = LOOKBACK_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """The latest traffic windows, oldest first."""
    latest = (
        _window_of(traffic, "window_start", minutes, as_of)
        .select("window_start", "total_bytes", "event_count", "avg_bytes_per_event")
        .orderBy(F.desc("window_start"))
        .limit(LATEST_POINTS)
    )
    return latest.orderBy("window_start")


def live_velocity(
    traffic: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    window_seconds: int = change.WINDOW_SECONDS,
) -> DataFrame:
    """Events per second of the latest traffic windows, oldest first."""
    return velocity_of(live_traffic(traffic, minutes, as_of), window_seconds)


def velocity_of(
    points: DataFrame, window_seconds: int = change.WINDOW_SECONDS
) -> DataFrame:
    """Events per second of traffic windows."""
    return points.select(
        "window_start",
        change.events_per_second(F.col("event_count"), window_seconds).alias("events_per_second"),
        "event_count",
    )


def live_servers(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    top_n: int = TOP_N,
) -> DataFrame:
    """Servers with the most edits."""
    servers = (
        _recent(changes, minutes, as_of)
        .groupBy("server_name")
        .agg(_edits().alias("total_edits"), _moved("bytes_changed").alias("total_bytes"))
    )
    return top_k(servers, "total_edits", ["server_name"], top_n)


def live_leaderboard(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    top_n: int = TOP_N,
) -> DataFrame:
    """Pages with the most edits, under the leaderboard's column names."""
    pages = (
        _recent(changes, minutes, as_of)
        .groupBy("title", "server_name")
        .agg(_edits().alias("total_edits"), _moved("bytes_changed").alias("total_bytes"))
    )
    return top_k(pages, "total_edits", ["title", "server_name"], top_n).withColumnsRenamed(
        LEADERBOARD_NAMES
    )


def live_actions(
    changes: DataFrame, minutes: int = LOOKBACK_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """Actions per minute and type, latest first."""
    return (
        _recent(changes, minutes, as_of)
        .groupBy(
            clock.minute_of(F.col("event_time")).alias("window_start"),
            F.col("type").alias("action_type"),
        )
        .agg(_edits().alias("action_count"))
        .orderBy(F.desc("window_start"), F.asc_nulls_first("action_type"))
        .limit(LATEST_POINTS)
    )


def live_severity(
    changes: DataFrame, minutes: int = LOOKBACK_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """Changes per size class."""
    return (
        _recent(changes, minutes, as_of)
        .groupBy(change.severity(F.col("bytes_changed")).alias("edit_type"))
        .agg(_edits().alias("total_count"))
    )


def live_volume_change(
    changes: DataFrame, minutes: int = LOOKBACK_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """Bytes and changes, additions against deletions."""
    return (
        _recent(changes, minutes, as_of)
        .groupBy(change.change_type(F.col("length_diff")).alias("change_type"))
        .agg(_moved("length_diff").alias("total_bytes"), _edits().alias("count"))
    )


def live_namespaces(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    top_n: int = TOP_NAMESPACES,
) -> DataFrame:
    """Changes per title prefix, among titles that have one."""
    namespaces = (
        _recent(changes, minutes, as_of)
        .filter(F.col("title").contains(":"))
        .groupBy(change.title_namespace(F.col("title")).alias("namespace"))
        .agg(_edits().alias("total_count"))
    )
    return top_k(namespaces, "total_count", ["namespace"], top_n)


def live_languages(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    top_n: int = TOP_N,
) -> DataFrame:
    """Changes per first host label."""
    languages = (
        _recent(changes, minutes, as_of)
        .groupBy(change.server_language(F.col("server_name")).alias("language"))
        .agg(_edits().alias("total_count"), _moved("bytes_changed").alias("total_bytes"))
    )
    return top_k(languages, "total_count", ["language"], top_n)


def live_users(
    changes: DataFrame, minutes: int = LOOKBACK_MINUTES, as_of: clock.AsOf = None
) -> DataFrame:
    """Edits per user."""
    return (
        _recent(changes, minutes, as_of).groupBy("user").agg(_edits().alias("total_edits"))
    )


def live_power_users(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    threshold: int = POWER_USER_EDITS,
) -> DataFrame:
    """Users with at least ``threshold`` edits."""
    return live_users(changes, minutes, as_of).filter(F.col("total_edits") >= threshold)


def live_user_histogram(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    threshold: int = POWER_USER_EDITS,
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Power users per edit-count bin: ``bins`` of equal width from the least to the most
    edits; bins without users have no row."""
    counts = value_counts(
        live_power_users(changes, minutes, as_of, threshold), "total_edits", "_users"
    )
    every = Window.partitionBy()
    low, high = F.min("total_edits").over(every), F.max("total_edits").over(every)
    return (
        counts.select(
            "_users",
            F.floor((F.col("total_edits") - low) * bins / (high - low + 1)).alias("bin"),
        )
        .groupBy("bin")
        .agg(F.sum("_users").alias("users"))
    )


def live_recent(
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    limit: int = LATEST_CHANGES,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The latest changes, newest first. Ties on time go by ``tie_break`` descending, by default
    by all other columns."""
    ties = tie_break or [name for name in changes.columns if name != "event_time"]
    return (
        _recent(changes, minutes, as_of)
        .orderBy(F.desc("event_time"), *[F.desc_nulls_last(name) for name in ties])
        .limit(limit)
    )


def live_battlefield(recent: DataFrame) -> DataFrame:
    """The latest changes with impact and direction, for the scatter feed."""
    return recent.withColumns(
        {
            "impact": change.impact(F.col("bytes_changed")),
            "direction": change.direction(F.col("length_diff")),
        }
    )


def live_kpis(
    traffic: DataFrame,
    changes: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: clock.AsOf = None,
    window_seconds: int = change.WINDOW_SECONDS,
) -> DataFrame:
    """One row: events, bytes, megabytes, current velocity, top server; zeros and ``N/A`` when
    the window is empty."""
    points = live_traffic(traffic, minutes, as_of)
    top_server = live_servers(changes, minutes, as_of, top_n=1).select("server_name")
    total_bytes = F.coalesce(F.sum("total_bytes"), F.lit(0))
    velocity = change.events_per_second(F.max_by("event_count", "window_start"), window_seconds)
    return points.agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events"),
        total_bytes.alias("total_bytes"),
        change.megabytes(total_bytes).alias("total_mb"),
        F.coalesce(velocity, F.lit(0.0)).alias("current_velocity"),
    ).select("*", F.coalesce(top_server.scalar(), F.lit(NO_SERVER)).alias("top_server"))
