"""Pages and users with the most changes, from sketches that merge.

An exact board needs a counter for every key. A sketch tracks ``TRACKED`` keys at most, so that one per
hour takes the same space whatever the number of pages, and sketches of batches and hours combine into
one of any look-back. A key with more than one in 4,000 of the changes is always tracked; where no more
keys than are tracked exist, counts are exact. ``leaderboard`` counts the tracked keys over the changes, so
its numbers are exact and only the choice of keys is the sketch's.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidewatch.functions import clock
from tidewatch.operators.live import LEADERBOARD_NAMES, TOP_N
from tidewatch.operators.ordering import top_k
from tidewatch.schemas import INT, LONG, RECENT_CHANGES_SCHEMA, TEXT, TIME, struct

TRACKED = 10_000
PAGE, USER = "page", "user"
KEYS = {PAGE: ["title", "server_name"], USER: ["user"]}
# The fields of a sketch as Spark's functions name them.
_STATE = struct(
    {
        "sketch": BinaryType(), "maxItemsTracked": INT,
        "itemDataType": TEXT, "itemDataTypeDDL": TEXT,
    }
)
SKETCHES = struct({"hour": TIME, "dimension": TEXT, "changes": LONG, "state": _STATE})


def sketches(changes: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``hour, dimension, changes, state`` of change rows. Tasks sketch what they read; only sketches
    are shuffled, so a page that has most changes costs nothing more."""
    items = [
        F.struct(F.lit(name).alias("dimension"), F.to_json(F.struct(*columns)).alias("item"))
        for name, columns in KEYS.items()
    ]
    hour = clock.hour_of(F.col("event_time")).alias("hour")
    return (
        changes.select(hour, F.explode(F.array(*items)).alias("_key"))
        .groupBy("hour", F.col("_key.dimension").alias("dimension"))
        .agg(
            F.count(F.lit(1)).alias("changes"),
            F.expr(f"approx_top_k_accumulate(_key.item, {tracked})").alias("state"),
        )
    )


def merged(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One sketch per hour and dimension of those that batches, or folders of them, hold."""
    return rows.groupBy("hour", "dimension").agg(
        F.sum("changes").alias("changes"), _combined(tracked)
    )


def _combined(tracked: int) -> Column:
    return F.expr(f"approx_top_k_combine(state, {tracked})").alias("state")


def tracked_keys(rows: DataFrame, dimension: str, tracked: int = TRACKED) -> DataFrame:
    """The keys that the sketches of all hours given track together, with estimated ``total_edits``."""
    shape = struct({name: RECENT_CHANGES_SCHEMA[name].dataType for name in KEYS[dimension]})
    return (
        rows.where(F.col("dimension") == dimension)
        .groupBy("dimension")
        .agg(_combined(tracked))
        .select(F.explode(F.expr(f"approx_top_k_estimate(state, {tracked})")).alias("_found"))
        .select(F.from_json("_found.item", shape).alias("_key"), F.col("_found.count").alias("total_edits"))
        .select("_key.*", "total_edits")
    )


def heavy_keys(
    rows: DataFrame, dimension: str, top_n: int = TOP_N, tracked: int = TRACKED
) -> DataFrame:
    """Keys with the most changes by the sketches' estimates; ties go to the smaller keys."""
    found = tracked_keys(rows, dimension, tracked)
    return top_k(found, "total_edits", KEYS[dimension], top_n)


def leaderboard(
    changes: DataFrame, rows: DataFrame, top_n: int = TOP_N, tracked: int = TRACKED
) -> DataFrame:
    """``live.live_leaderboard`` of the changes whose sketches ``rows`` are, counting tracked pages only:
    the shuffle holds no more counters than are tracked, a task at a time."""
    keys = KEYS[PAGE]
    # As many rows as are tracked at most, so a broadcast's size has a bound.
    found = F.broadcast(tracked_keys(rows, PAGE, tracked).select(*keys).alias("found"))
    same = [F.col(f"change.{key}").eqNullSafe(F.col(f"found.{key}")) for key in keys]
    counted = (
        changes.alias("change")
        .join(found, same, "left_semi")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_edits"), F.sum(F.abs("bytes_changed")).alias("total_bytes")
        )
    )
    return top_k(counted, "total_edits", keys, top_n).withColumnsRenamed(LEADERBOARD_NAMES)
