"""Boards from merged sketches against exact counts."""

from pyspark.sql import functions as F

from tests.build import changes
from tidewatch.operators import heavy_hitters, live
from tidewatch.schemas import RECENT_CHANGES_SCHEMA
from tidewatch.streaming import live as streams


def skewed(spark, size):
    """Changes of which a third are one user's, a third follow a power law, and the others are of a
    user each."""
    place = (F.col("id") * 0.6180339887498949) % 1
    some = F.floor(1 / (place + 0.00005))
    user = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, some).otherwise(F.col("id") + 10**6)
    filled = {
        "event_time": F.timestamp_seconds(F.lit(1_705_332_000) + F.col("id") % 20_000),
        "user": F.concat(F.lit("u"), user),
        "title": F.concat(F.lit("t"), user),
        "server_name": F.lit("en.wikipedia.org"),
        "bytes_changed": F.col("id") % 100 - 50,
    }
    return spark.range(size).select(
        *[filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECENT_CHANGES_SCHEMA]
    )


def test_few_tracked_keys_find_the_heaviest_of_many(spark):
    df = skewed(spark, 60_000).withColumn("batch", F.floor(F.rand(7) * 5)).cache()
    assert df.select("user").distinct().count() > 5_000
    parts = [heavy_hitters.sketches(df.where(F.col("batch") == n).drop("batch"), 400) for n in range(5)]
    held = parts[0]
    for part in parts[1:]:
        held = held.unionByName(part)
    held = heavy_hitters.merged(held, 400)
    exact = df.groupBy("user").count().orderBy(F.desc("count"), "user").limit(12).collect()
    found = heavy_hitters.heavy_keys(held, heavy_hitters.USER, 12, 400).collect()
    assert len({r.user for r in exact} & {r.user for r in found}) >= 11
    error = 60_000 * 3.5 / 1024
    counts = {r.user: r["count"] for r in exact}
    assert all(abs(r.total_edits - counts[r.user]) <= error for r in found if r.user in counts)


def test_the_leaderboard_counts_tracked_pages_exactly(spark):
    df = skewed(spark, 60_000).cache()
    held = heavy_hitters.sketches(df, 400)
    board = heavy_hitters.leaderboard(df, held, 12, 400).collect()
    exact = live.live_leaderboard(df, minutes=10**8, top_n=12).collect()
    assert len(set(board) & set(exact)) >= 11


def test_unknown_keys_ties_and_empty_tables(spark, rows):
    df = changes(
        spark,
        {"user": "b", "title": "x", "bytes_changed": 1},
        {"user": "a", "title": "x", "bytes_changed": None},
        {"user": None, "title": None, "bytes_changed": 5},
        {"user": "", "title": 'quote " and \\ and \n', "server_name": "s", "bytes_changed": -5},
    )
    held = heavy_hitters.sketches(df)
    found = heavy_hitters.heavy_keys(held, heavy_hitters.USER, 3).collect()
    assert [tuple(r) for r in found] == [(None, 1), ("", 1), ("a", 1)]
    assert heavy_hitters.leaderboard(df, held).collect() == live.live_leaderboard(df, 10**8).collect()
    none = heavy_hitters.sketches(df.limit(0))
    assert heavy_hitters.heavy_keys(none, heavy_hitters.PAGE).collect() == []
    assert heavy_hitters.leaderboard(df.limit(0), none).collect() == []


def test_a_look_back_takes_whole_hours(spark, tmp_path):
    root = str(tmp_path / "live")
    for batch, at in enumerate((0, 3 * 3600, 5 * 3600)):
        df = changes(spark, {"user": f"u{batch}", "title": "t", "bytes_changed": 1, "at": at})
        streams.store_live_batch(df, root, batch, fold_every=2, hitters=True)
    end = changes(spark, {"at": 5 * 3600 + 60}).first().event_time.astimezone()
    for hours, users in ((0, ["u0", "u1", "u2"]), (3, ["u1", "u2"]), (1, ["u2"])):
        held = streams.read_hitters(spark, root, hours, end)
        assert [r.user for r in heavy_hitters.heavy_keys(held, heavy_hitters.USER).collect()] == users
