"""The five historical views.

Each view has two entry points: from events, and ``*_of`` from rollup rows of its grain, which
is what the batch job uses to read the lake once for all five.

``literal_counts`` counts the rows where a condition is known instead of where it holds. It
reproduces results of jobs that count a comparison directly; a flag that is false then counts too.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators import rollup as ru
from tidewatch.operators.ordering import descending, rank_top, top_k

# Sizes of the views.
TOP_CONTRIBUTORS = 100
TOP_SERVERS = 50
TREND_HOURS = 24


def _counted(holds: str, known: str, literal_counts: bool) -> Column:
    return F.col(known if literal_counts else holds)


def hourly_patterns(events: DataFrame, literal_counts: bool = False) -> DataFrame:
    """Events, bytes and bot / human split per hour, in time order."""
    return hourly_patterns_of(ru.rollup(events, ru.HOURS), literal_counts)


def hourly_patterns_of(hours: DataFrame, literal_counts: bool = False) -> DataFrame:
    return hours.select(
        "hour_bucket",
        F.col("events").alias("total_events"),
        F.col("bytes").alias("total_bytes"),
        F.try_divide(F.col("bytes"), F.col("bytes_known")).alias("avg_bytes"),
        _counted("bots", "bots_known", literal_counts).alias("bot_events"),
        _counted("humans", "bots_known", literal_counts).alias("human_events"),
    ).orderBy("hour_bucket")


def hourly_trends(
    events: DataFrame, literal_counts: bool = False, frame: str = "rows"
) -> DataFrame:
    """Hourly totals with trailing means over 24 rows, or over 24 hours with ``frame='range'``.

    Both agree when every hour has events; over a gap the row frame reaches further back.
    """
    return hourly_trends_of(ru.rollup(events, ru.HOURS), literal_counts, frame)


def hourly_trends_of(
    hours: DataFrame, literal_counts: bool = False, frame: str = "rows"
) -> DataFrame:
    # One task orders the hours: fewer than 9,000 rows per year of data, however many events.
    if frame == "rows":
        trailing = Window.orderBy("hour_bucket").rowsBetween(1 - TREND_HOURS, 0)
    elif frame == "range":
        seconds = F.unix_seconds("hour_bucket")
        trailing = Window.orderBy(seconds).rangeBetween((1 - TREND_HOURS) * 3600, 0)
    else:
        raise ValueError(f"unknown frame: {frame}")
    return (
        hours.select(
            "hour_bucket",
            F.col("events").alias("total_events"),
            F.col("bytes").alias("total_bytes"),
            _counted("bots", "bots_known", literal_counts).alias("bot_count"),
            _counted("type_new", "type_known", literal_counts).alias("new_pages"),
            _counted("type_edit", "type_known", literal_counts).alias("edits"),
        )
        .withColumns(
            {
                "events_24h_avg": F.avg("total_events").over(trailing),
                "bytes_24h_avg": F.avg("total_bytes").over(trailing),
            }
        )
        .orderBy("hour_bucket")
    )


def top_contributors(
    events: DataFrame, top_n: int = TOP_CONTRIBUTORS, literal_counts: bool = False
) -> DataFrame:
    """Users (bot and non-bot edits apart) with the most edits."""
    return top_contributors_of(ru.rollup(events, ru.CONTRIBUTORS), top_n, literal_counts)


def top_contributors_of(
    contributors: DataFrame, top_n: int = TOP_CONTRIBUTORS, literal_counts: bool = False
) -> DataFrame:
    edits = contributors.select(
        *ru.CONTRIBUTORS,
        F.col("events").alias("edit_count"),
        F.col("bytes").alias("total_bytes"),
        _counted("new_flagged", "new_known", literal_counts).alias("pages_created"),
    )
    return top_k(edits, "edit_count", ru.CONTRIBUTORS, top_n)


def language_distribution(events: DataFrame, literal_counts: bool = False) -> DataFrame:
    """Edits per language and project, most first; hosts without either form one group."""
    return language_distribution_of(ru.rollup(events, ru.LANGUAGES), literal_counts)


def language_distribution_of(languages: DataFrame, literal_counts: bool = False) -> DataFrame:
    return languages.select(
        *ru.LANGUAGES,
        F.col("events").alias("edit_count"),
        F.col("bytes").alias("total_bytes"),
        _counted("bots", "bots_known", literal_counts).alias("bot_edits"),
        _counted("new_flagged", "new_known", literal_counts).alias("new_pages"),
    ).orderBy(*descending("edit_count", ru.LANGUAGES))


def server_rankings(
    events: DataFrame, top_n: int = TOP_SERVERS, approximate_users: bool = False
) -> DataFrame:
    """Servers by edits with rank, percentile over all servers and distinct users.

    Users are counted exactly by aggregating per server and user first, which spreads a dominant
    server over its users. ``approximate_users`` uses a sketch instead (default relative error).
    Percentiles and places come from one per-server table: the events are scanned once.
    """
    if approximate_users:
        servers = events.groupBy(*ru.SERVERS).agg(
            F.count(F.lit(1)).alias("edit_count"),
            F.sum("bytes_changed").alias("total_bytes"),
            F.approx_count_distinct("user").alias("unique_users"),
        )
    else:
        servers = _servers(ru.rollup(events, ru.SERVER_USERS))
    return rank_top(servers, "edit_count", ru.SERVERS, top_n)


def server_rankings_of(server_users: DataFrame, top_n: int = TOP_SERVERS) -> DataFrame:
    return rank_top(_servers(server_users), "edit_count", ru.SERVERS, top_n)


def _servers(server_users: DataFrame) -> DataFrame:
    return server_users.groupBy(*ru.SERVERS).agg(
        F.sum("events").alias("edit_count"),
        F.sum("bytes").alias("total_bytes"),
        F.count("user").alias("unique_users"),
    )
