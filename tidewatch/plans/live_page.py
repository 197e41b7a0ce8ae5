"""The live page in a few jobs: one read of the minute partials for all top lists."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidewatch.operators import live, live_page
from tidewatch.streaming import live as streams


def _sources(
    spark: SparkSession, root: str, minutes: int, now: datetime
) -> tuple[DataFrame, DataFrame]:
    """The look-back's changes and minute partials."""
    hours = minutes // 60 + 1
    changes = streams.read_live_changes(spark, root, hours, now)
    partials = streams.read_partials(spark, root, hours, now)
    return changes, live_page.within(partials, changes, minutes, now)


def read_lists(
    spark: SparkSession, root: str, minutes: int = live.LOOKBACK_MINUTES, as_of: datetime | None = None
) -> DataFrame:
    """All top lists of the page (``operators.live_page.top_lists``)."""
    now = as_of or datetime.now(timezone.utc)
    return live_page.top_lists(_sources(spark, root, minutes, now)[1])


def read_page(
    spark: SparkSession,
    root: str,
    minutes: int = live.LOOKBACK_MINUTES,
    as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """The queries of the page over the live tables below ``root``, by name.

    The top lists and the traffic points, some hundred and 500 rows, are computed here, in one job
    each, so that all of them are of one moment; showing them costs no further read. The latest
    changes and the users, of which there may be many, are read when they are asked for.
    """
    now = as_of or datetime.now(timezone.utc)
    changes, partials = _sources(spark, root, minutes, now)
    lists = _held(live_page.top_lists(partials), "place")
    points = streams.read_live_traffic(spark, root, minutes // 60 + 1, now)
    traffic = _held(live.live_traffic(points, minutes, now), "window_start")
    return {
        "live_traffic": traffic,
        "live_velocity": live.velocity_of(traffic),
        **live_page.views_of(lists, in_order=True),
        "live_users": live_page.users(partials),
        "live_recent": live.live_recent(changes, minutes, now),
    }


def _held(bounded: DataFrame, order: str) -> DataFrame:
    """A result of bounded size, computed once; filters and projections of it need no job."""
    rows = bounded.toArrow().sort_by(order)
    return bounded.sparkSession.createDataFrame(rows, bounded.schema)
