"""The aggregates of the live page from counts per minute.

A change adds one to a few counters of its minute: its server's, its page's, its user's and so on. The
live stream stores these per batch, and they merge by addition, so a look-back of half an hour is
answered from some thirty minutes of counters, whatever the number of changes. All top lists of the
page come from one aggregation of them.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import change, clock
from tidewatch.operators import live
from tidewatch.schemas import MINUTE_PARTIALS_SCHEMA

SERVER, PAGE, ACTION, SEVERITY, CHANGE, NAMESPACE, LANGUAGE, USER = (
    "server", "page", "action", "severity", "change", "namespace", "language", "user",
)
# Rows a list of the page has; the others have as many as there are.
LIMITS = {
    SERVER: live.TOP_N, PAGE: live.TOP_N, LANGUAGE: live.TOP_N, NAMESPACE: live.TOP_NAMESPACES,
    ACTION: live.LATEST_POINTS,
}
# Lists that classes bound.
CLASSES = [SEVERITY, CHANGE]
_KEYS = ["minute", "dimension", "key", "key_2"]


def minute_partials(changes: DataFrame) -> DataFrame:
    """``minute, dimension, key, key_2, edits, moved`` of change rows. ``moved`` adds up the absolute
    bytes of a change, for additions and deletions its absolute difference. Counters combine before
    their shuffle."""
    return merged(_counters(changes))


def _counters(changes: DataFrame) -> DataFrame:
    """What each change adds, in the shape of partials."""
    size, title, server = F.abs("bytes_changed"), F.col("title"), F.col("server_name")
    counters = [
        _counter(SERVER, server, size),
        _counter(PAGE, title, size, server),
        _counter(ACTION, F.col("type"), size),
        _counter(SEVERITY, change.severity(F.col("bytes_changed")), size),
        _counter(CHANGE, change.change_type(F.col("length_diff")), F.abs("length_diff")),
        F.when(title.contains(":"), _counter(NAMESPACE, change.title_namespace(title), size)),
        _counter(LANGUAGE, change.server_language(server), size),
        _counter(USER, F.col("user"), size),
    ]
    minute = clock.minute_of(F.col("event_time")).alias("minute")
    return (
        changes.select(minute, F.explode(F.array(*counters)).alias("counter"))
        .where("counter IS NOT NULL")
        .select("minute", "counter.*", F.lit(1).cast("bigint").alias("edits"))
        .select(*MINUTE_PARTIALS_SCHEMA.fieldNames())
    )


def _counter(dimension: str, key: Column, moved: Column, key_2: Column | None = None) -> Column:
    second = F.lit(None).cast("string") if key_2 is None else key_2
    return F.struct(
        F.lit(dimension).alias("dimension"), key.alias("key"), second.alias("key_2"),
        moved.alias("moved"),
    )


def merged(partials: DataFrame) -> DataFrame:
    """Partials of several batches as one row per counter."""
    return (
        partials.groupBy(*_KEYS)
        .agg(F.sum("edits").alias("edits"), F.sum("moved").alias("moved"))
        .select(*MINUTE_PARTIALS_SCHEMA.fieldNames())
    )


def within(
    partials: DataFrame, changes: DataFrame, minutes: int, as_of: clock.AsOf = None
) -> DataFrame:
    """The counters of exactly the last ``minutes``: whole minutes from the partials, and what the
    cutoff leaves of its own minute from the changes."""
    cutoff = clock.minutes_before(as_of, minutes)
    whole = clock.minute_of(cutoff + F.expr("INTERVAL '59.999999' SECOND"))
    rest = (F.col("event_time") >= cutoff) & (F.col("event_time") < whole)
    return partials.where(F.col("minute") >= whole).unionByName(_counters(changes.where(rest)))


def top_lists(partials: DataFrame) -> DataFrame:
    """All lists of the page but the users', ``dimension, place, minute, key, key_2, edits, moved``, in
    one aggregation. Actions are counted per minute, the others over all; there are some hundred
    rows, since every list has a limit or is one of a few classes."""
    by_minute = F.col("dimension") == ACTION
    lists = (
        partials.where(F.col("dimension").isin(*LIMITS, *CLASSES))
        .groupBy("dimension", "key", "key_2", F.when(by_minute, F.col("minute")).alias("minute"))
        .agg(F.sum("edits").alias("edits"), F.sum("moved").alias("moved"))
    )
    order = Window.partitionBy("dimension").orderBy(
        F.desc_nulls_last("minute"),
        F.desc_nulls_last(F.when(~by_minute, F.col("edits"))),
        F.asc_nulls_first("key"),
        F.asc_nulls_first("key_2"),
    )
    limit = F.lit(max(LIMITS.values()))
    for dimension, most in LIMITS.items():
        limit = F.when(F.col("dimension") == dimension, most).otherwise(limit)
    return (
        lists.withColumn("place", F.row_number().over(order))
        # The first bound lets each task of the aggregation keep that many rows only.
        .where(F.col("place") <= max(LIMITS.values()))
        .where(F.col("place") <= limit)
        .select("dimension", "place", "minute", "key", "key_2", "edits", "moved")
    )


def users(partials: DataFrame) -> DataFrame:
    """``live.live_users`` from partials."""
    mine = partials.where(F.col("dimension") == USER).groupBy(F.col("key").alias("user"))
    return mine.agg(F.sum("edits").alias("total_edits"))


def views_of(lists: DataFrame, in_order: bool = False) -> dict[str, DataFrame]:
    """The page's queries, as ``operators.live`` names their columns, from ``top_lists``, which may be
    ``in_order`` of their places already, as held rows are."""

    def view(dimension: str, columns: dict[str, str]) -> DataFrame:
        mine = lists.where(F.col("dimension") == dimension)
        mine = mine if in_order else mine.orderBy("place")
        return mine.select(*(F.col(held).alias(name) for name, held in columns.items()))

    return {
        "live_servers": view(
            SERVER, {"server_name": "key", "total_edits": "edits", "total_bytes": "moved"}
        ),
        "live_leaderboard": view(
            PAGE, {"title": "key", "Server": "key_2", "Edits": "edits", "Bytes": "moved"}
        ),
        "live_actions": view(
            ACTION, {"window_start": "minute", "action_type": "key", "action_count": "edits"}
        ),
        "live_severity": view(SEVERITY, {"edit_type": "key", "total_count": "edits"}),
        "live_volume_change": view(
            CHANGE, {"change_type": "key", "total_bytes": "moved", "count": "edits"}
        ),
        "live_namespaces": view(NAMESPACE, {"namespace": "key", "total_count": "edits"}),
        "live_languages": view(
            LANGUAGE, {"language": "key", "total_count": "edits", "total_bytes": "moved"}
        ),
    }
