"""Live tables and queries on hand-made changes."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.build import NOON, changes, raw
from tests.conftest import plan_of
from tidewatch.functions import change
from tidewatch.operators import ingest, live, monitoring, retention
from tidewatch.plans import serving

NOW = datetime.fromtimestamp(NOON, timezone.utc)


def at(seconds):
    return NOW + timedelta(seconds=seconds)


@pytest.fixture
def feed(spark):
    return changes(
        spark,
        {"at": 0, "user": "u1", "title": "Talk:A", "server_name": "en.wikipedia.org", "type": "edit",
         "bytes_changed": 100, "length_diff": 0},
        {"at": 5, "user": "u1", "title": "A:B:C", "server_name": "en.wikipedia.org", "type": "edit",
         "bytes_changed": 101, "length_diff": -101},
        {"at": 12, "user": "u2", "title": "Plain", "server_name": "localhost", "type": "new",
         "bytes_changed": 1000, "length_diff": 1000},
        {"at": 70, "user": "u2", "title": "Plain", "server_name": "localhost", "type": "new",
         "bytes_changed": 1001, "length_diff": None},
    )


def test_defaults_of_a_change_row(spark):
    events = ingest.enrich_events(raw(spark, {"timestamp": NOON})).withColumn(
        "bytes_changed", F.lit(None).cast("bigint")
    )
    row = live.recent_changes(events).first()
    assert tuple(row)[1:] == ("unknown", "unknown", "unknown", False, "edit", 0, 0)
    assert live.recent_changes(events, keep_null_flags=True).first().is_bot is None


def test_severity_bounds(spark, feed, rows):
    assert rows(live.live_severity(feed, as_of=at(70))) == [("Major", 1), ("Minor", 1), ("Moderate", 2)]


def test_zero_and_unknown_differences(feed, rows):
    totals = rows(live.live_volume_change(feed, as_of=at(70)))
    assert totals == [("Addition", 1000, 2), ("Deletion", 101, 2)]
    scatter = live.live_battlefield(feed)
    assert rows(scatter, "impact", "direction") == [
        (100, "Deletion"), (101, "Deletion"), (500, "Addition"), (500, "Deletion"),
    ]


def test_impact_is_clipped_and_keeps_nulls(spark):
    sizes = spark.createDataFrame([(-3,), (None,), (-700,)], "b BIGINT")
    assert [r[0] for r in sizes.select(change.impact(F.col("b"))).collect()] == [5, None, 500]


def test_lookback_includes_its_first_moment(feed):
    assert live.live_users(feed, minutes=1, as_of=at(70)).collect() == [("u2", 2)]
    assert live.live_users(feed, minutes=1, as_of=at(72)).collect() == [("u2", 2)]
    assert live.live_users(feed, minutes=1, as_of=at(72.5)).collect() == [("u2", 1)]
    assert live.live_users(feed, minutes=30).count() == 0


def test_namespace_is_the_text_before_the_first_colon(feed, rows):
    assert rows(live.live_namespaces(feed, as_of=at(70))) == [("A", 1), ("Talk", 1)]


def test_language_of_a_host_without_a_dot_is_the_host(feed, rows):
    assert rows(live.live_languages(feed, as_of=at(70)), "language", "total_count") == [
        ("en", 2), ("localhost", 2),
    ]


def test_ties_go_to_the_smaller_key(feed):
    servers = live.live_servers(feed, as_of=at(70), top_n=1).first()
    assert tuple(servers) == ("en.wikipedia.org", 2, 201)
    page = live.live_leaderboard(feed, as_of=at(70), top_n=1).first()
    assert page.asDict() == {"title": "Plain", "Server": "localhost", "Edits": 2, "Bytes": 2001}


def test_actions_per_minute_latest_first(feed):
    got = live.live_actions(feed, as_of=at(70)).select(
        F.unix_seconds("window_start") - NOON, "action_type", "action_count"
    )
    assert [tuple(r) for r in got.collect()] == [(60, "new", 1), (0, "edit", 2), (0, "new", 1)]


def test_traffic_windows_and_velocity(feed):
    traffic = live.traffic_volume(feed)
    got = live.live_traffic(traffic, as_of=at(70)).select(
        F.unix_seconds("window_start") - NOON, "total_bytes", "event_count", "avg_bytes_per_event"
    )
    assert [tuple(r) for r in got.collect()] == [(0, 201, 2, 100.5), (10, 1000, 1, 1000.0), (70, 1001, 1, 1001.0)]
    velocity = live.live_velocity(traffic, as_of=at(70)).collect()
    assert [r.events_per_second for r in velocity] == [0.2, 0.1, 0.1]


def test_average_of_an_empty_window_is_zero(spark):
    row = spark.createDataFrame([(0, 0)], "b BIGINT, n BIGINT")
    assert row.select(change.avg_bytes_per_event(F.col("b"), F.col("n"))).first()[0] == 0.0


def test_count_windows_leave_the_partial_one_out(spark):
    records = spark.range(25).selectExpr(
        "cast(id % 2 AS int) AS partition", "id div 2 AS offset",
        f"timestamp_seconds({NOON} + id) AS event_time", "id AS bytes_changed",
    )
    got = live.traffic_count_window(records, size=5).orderBy("window_start").select(
        F.unix_seconds("window_start") - NOON, "total_bytes", "event_count"
    )
    assert [tuple(r) for r in got.collect()] == [(8, 20, 5), (9, 25, 5), (18, 70, 5), (19, 75, 5)]


def test_kpis(feed):
    traffic = live.traffic_volume(feed)
    full = live.live_kpis(traffic, feed, as_of=at(70)).first()
    assert tuple(full) == (4, 2202, 2202 / 1024 / 1024, 0.1, "en.wikipedia.org")
    empty = live.live_kpis(traffic, feed, as_of=at(10**6)).first()
    assert tuple(empty) == (0, 0, 0.0, 0.0, "N/A")


def test_power_users_and_histogram(spark, rows):
    edits = [10, 10, 11, 29, 30, 9]
    feed = changes(spark, {"at": 0}).crossJoin(
        spark.createDataFrame([(f"u{i}", n) for i, n in enumerate(edits)], "who STRING, n INT")
    ).selectExpr("event_time", "who AS user", "explode(sequence(1, n)) AS k")
    assert live.live_power_users(feed, as_of=NOW).count() == 5
    # 21 values in 20 bins
    want = {}
    for n in edits[:5]:
        want[(n - 10) * 20 // 21] = want.get((n - 10) * 20 // 21, 0) + 1
    assert rows(live.live_user_histogram(feed, as_of=NOW)) == sorted(want.items(), key=lambda i: str(i[0]))


def test_recent_is_newest_first_and_limited(feed):
    got = live.live_recent(feed, as_of=at(70), limit=2).collect()
    assert [r.bytes_changed for r in got] == [1001, 1000]


def test_top_k_does_not_sort_everything(feed):
    plan = plan_of(live.live_servers(feed, as_of=at(70)))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_keyword_monitor(feed):
    assert monitoring.keyword_monitor(feed, ["TALK", "a:b"]).count() == 2
    assert monitoring.keyword_monitor(feed, ["U2"]).count() == 2
    assert monitoring.keyword_monitor(feed, []).count() == 0


def test_average_change(feed):
    got = [tuple(r) for r in monitoring.average_change(feed, as_of=at(70)).collect()]
    assert got == [("localhost", 1000.5), ("en.wikipedia.org", 100.5)]


def test_silence_gaps_cross_days(spark):
    day = 24 * 3600
    minutes = [0, 60, 7 * 60, day, 4 * day, 4 * day + 6 * 60]
    got = monitoring.silence_gaps(changes(spark, *[{"at": s} for s in minutes])).select(
        F.unix_seconds("gap_start") - NOON, F.unix_seconds("gap_end") - NOON, "gap_minutes"
    )
    want = [(a, b, (b - a) // 60) for a, b in zip(minutes, minutes[1:]) if b - a >= 300]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_freshness_and_counts(feed, rows):
    tables = {"live": (feed, "event_time"), "none": (feed.filter("false"), "event_time")}
    ages = monitoring.freshness(tables, as_of=at(100))
    assert rows(ages, "table_name", "age_seconds") == [("live", 30), ("none", None)]
    assert rows(monitoring.table_counts({"a": feed, "b": feed.limit(1)})) == [("a", 4), ("b", 1)]


def test_spikes(spark):
    trends = spark.createDataFrame([(1, 30, 10.0), (2, 5, 10.0)], "h INT, n BIGINT, m DOUBLE").selectExpr(
        "timestamp_seconds(h) AS hour_bucket", "n AS total_events", "m AS events_24h_avg"
    )
    assert [r.spike_ratio for r in monitoring.hourly_spikes(trends).collect()] == [3.0, 0.5]
    assert monitoring.hourly_spikes(trends, 2.0).count() == 1


def test_retention_filter(feed):
    assert retention.keep_recent(feed, "event_time", 1, at(3605)).count() == 3


def test_sql_serving_binds_values_and_raises(spark, feed):
    serving.register({serving.RECENT_CHANGES: feed})
    text = f"SELECT user FROM {serving.RECENT_CHANGES} WHERE bytes_changed > :least"
    assert serving.query(spark, text, {"least": 1000}).collect() == [("u2",)]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        serving.query(spark, "SELECT * FROM no_such_table")
