"""One set of measures at any grain, and all grains of the historical job in one pass.

Every historical view is a projection of these measures, so the lake needs to be read once: the
grouping-sets aggregation expands rows in memory and combines them before the shuffle, and what
is shuffled and stored is counts per hour, per user, per language and per server and user.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import clock

HOURS = ["hour_bucket"]
CONTRIBUTORS = ["user", "is_bot"]
LANGUAGES = ["language", "project"]
SERVERS = ["server_name", "language", "project"]
SERVER_USERS = [*SERVERS, "user"]

GRAINS = {
    "hours": HOURS,
    "contributors": CONTRIBUTORS,
    "languages": LANGUAGES,
    "server_users": SERVER_USERS,
}


# The names of ``measures``, for tables that store them.
MEASURES = [
    "events", "bytes", "bytes_known", "bots", "humans", "bots_known", "new_flagged", "new_known",
    "type_new", "type_edit", "type_known",
]


def measures() -> dict[str, Column]:
    """Additive measures. ``*_known`` counts rows where the condition is not null."""
    size, is_bot, is_new, kind = (
        F.col(name) for name in ("bytes_changed", "is_bot", "is_new_page", "type")
    )
    return {
        "events": F.count(F.lit(1)),
        "bytes": F.sum(size),
        "bytes_known": F.count(size),
        "bots": F.count_if(is_bot),
        "humans": F.count_if(~is_bot),
        "bots_known": F.count(is_bot),
        "new_flagged": F.count_if(is_new),
        "new_known": F.count(is_new),
        "type_new": F.count_if(kind == "new"),
        "type_edit": F.count_if(kind == "edit"),
        "type_known": F.count(kind),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _with_hour(events: DataFrame) -> DataFrame:
    return events.withColumn("hour_bucket", clock.hour_of(clock.timestamp_of(events, "timestamp")))


def rollup(events: DataFrame, keys: list[str]) -> DataFrame:
    """Measures per ``keys``; measures a caller does not use are pruned from the plan."""
    keyed = _with_hour(events) if "hour_bucket" in keys else events
    return keyed.groupBy(*keys).agg(*_named(measures()))


def roll_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser rows from already aggregated ones."""
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures()])


def rollup_all(events: DataFrame, grains: dict[str, list[str]] = GRAINS) -> DataFrame:
    """Measures of every grain from a single scan, told apart by ``grain``."""
    keys = list(dict.fromkeys(key for grain in grains.values() for key in grain))
    # grouping_id sets a bit, first key highest, for every key a row is not grouped by.
    grain = F.lit(None)
    for name, grouped in grains.items():
        mask = int("".join("0" if key in grouped else "1" for key in keys), 2)
        grain = F.when(F.col("_grouping") == mask, name).otherwise(grain)
    return (
        _with_hour(events)
        .groupingSets(list(grains.values()), *keys)
        .agg(F.grouping_id().alias("_grouping"), *_named(measures()))
        .withColumn("grain", grain)
        .drop("_grouping")
    )


def grain_rows(rows: DataFrame, grain: str) -> DataFrame:
    """The rows of one grain, with that grain's keys and the measures."""
    return rows.filter(F.col("grain") == grain).select(*GRAINS[grain], *measures())
