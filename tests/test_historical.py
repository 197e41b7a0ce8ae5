"""Historical views against hand-counted rows and brute force."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.build import HOUR, NOON, stored
from tests.conftest import plan_of
from tidewatch.operators import historical, ordering, rollup


@pytest.fixture(scope="module")
def mixed(spark):
    """Flags true, false and unknown; types new, edit and unknown; a gap of two days."""
    return stored(
        spark,
        {"user": "a", "is_bot": True, "type": "new", "is_new_page": True, "bytes_changed": 10,
         "server_name": "en.wikipedia.org", "language": "en", "project": "wikipedia"},
        {"user": "a", "is_bot": False, "bytes_changed": 20, "timestamp": NOON + 1,
         "server_name": "en.wikipedia.org", "language": "en", "project": "wikipedia"},
        {"user": "b", "is_bot": None, "bytes_changed": None, "type": None, "is_new_page": None,
         "timestamp": NOON + HOUR, "server_name": "localhost"},
        {"user": None, "is_bot": False, "bytes_changed": 5, "timestamp": NOON + 48 * HOUR,
         "server_name": "de.wikipedia.org", "language": "de", "project": "wikipedia"},
    ).cache()


def test_patterns_count_what_holds(mixed):
    got = [tuple(r)[1:] for r in historical.hourly_patterns(mixed).collect()]
    assert got == [(2, 30, 15.0, 1, 1), (1, None, None, 0, 0), (1, 5, 5.0, 0, 1)]


def test_patterns_literal_counts_what_is_known(mixed):
    got = [tuple(r)[4:] for r in historical.hourly_patterns(mixed, literal_counts=True).collect()]
    assert got == [(2, 2), (0, 0), (1, 1)]


def test_trends_row_frame_reaches_over_a_gap(mixed):
    rows = historical.hourly_trends(mixed).collect()
    assert [(r.bot_count, r.new_pages, r.edits) for r in rows] == [(1, 1, 1), (0, 0, 0), (0, 0, 1)]
    assert [r.events_24h_avg for r in rows] == [2.0, 1.5, pytest.approx(4 / 3)]
    assert rows[2].bytes_24h_avg == pytest.approx(17.5)


def test_trends_range_frame_stops_at_the_gap(mixed):
    rows = historical.hourly_trends(mixed, frame="range").collect()
    assert [r.events_24h_avg for r in rows] == [2.0, 1.5, 1.0]


def test_trends_literal(mixed):
    rows = historical.hourly_trends(mixed, literal_counts=True).collect()
    assert [(r.bot_count, r.new_pages, r.edits) for r in rows] == [(2, 2, 2), (0, 0, 0), (1, 1, 1)]


def test_contributors_keep_bot_and_human_edits_apart(mixed):
    got = [tuple(r) for r in historical.top_contributors(mixed).collect()]
    assert got == [
        (None, False, 1, 5, 0),
        ("a", False, 1, 20, 0),
        ("a", True, 1, 10, 1),
        ("b", None, 1, None, 0),
    ]
    assert historical.top_contributors(mixed, top_n=2).count() == 2


def test_languages_group_hosts_without_a_language(mixed):
    got = [tuple(r) for r in historical.language_distribution(mixed).collect()]
    assert got == [
        ("en", "wikipedia", 2, 30, 1, 1),
        (None, None, 1, None, 0, 0),
        ("de", "wikipedia", 1, 5, 0, 0),
    ]


def test_rankings(mixed):
    got = [
        (r.rank, r.server_name, r.edit_count, r.unique_users, r.percentile)
        for r in historical.server_rankings(mixed).orderBy("rank").collect()
    ]
    assert got == [
        (1, "en.wikipedia.org", 2, 1, 0.0),
        (2, "de.wikipedia.org", 1, 0, 0.5),
        (3, "localhost", 1, 1, 0.5),
    ]


def test_approximate_users_agree_on_small_data(mixed, rows):
    exact = historical.server_rankings(mixed)
    assert rows(exact) == rows(historical.server_rankings(mixed, approximate_users=True), *exact.columns)


def test_a_single_server_has_percentile_zero(spark):
    only = historical.server_rankings(stored(spark, {"server_name": "a.b"})).first()
    assert (only.rank, only.percentile) == (1, 0.0)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 6), min_size=1, max_size=30), st.integers(1, 12))
def test_rank_and_percentile_equal_brute_force(spark, sizes, k):
    servers = spark.createDataFrame(
        [(f"s{i:02d}", size) for i, size in enumerate(sizes)], "server STRING, edits BIGINT"
    )
    got = ordering.rank_top(servers, "edits", ["server"], k).orderBy("rank").collect()
    frame = pd.DataFrame({"server": [f"s{i:02d}" for i in range(len(sizes))], "edits": sizes})
    frame["percentile"] = (
        (frame.edits.rank(method="min", ascending=False) - 1) / (len(sizes) - 1)
        if len(sizes) > 1
        else 0.0
    )
    want = frame.sort_values(["edits", "server"], ascending=[False, True]).head(k)
    assert [r.server for r in got] == list(want.server)
    assert [r["rank"] for r in got] == list(range(1, len(want) + 1))
    assert [r.percentile for r in got] == pytest.approx(list(want.percentile))


@pytest.mark.parametrize("approximate", [False, True])
def test_server_rankings_scan_the_events_once(spark, mixed, tmp_path, approximate):
    mixed.write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    ranked = historical.server_rankings(events, approximate_users=approximate)
    ranked.collect()
    final = plan_of(ranked).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_one_pass_rollup_equals_each_grain(mixed, rows):
    together = rollup.rollup_all(mixed).cache()
    for grain, keys in rollup.GRAINS.items():
        alone = rollup.rollup(mixed, keys)
        assert rows(rollup.grain_rows(together, grain)) == rows(alone, *keys, *rollup.measures())


def test_one_pass_rollup_scans_once_and_combines_before_the_shuffle(spark, mixed, tmp_path):
    mixed.write.parquet(str(tmp_path / "e"))
    plan = plan_of(rollup.rollup_all(spark.read.parquet(str(tmp_path / "e"))))
    assert plan.count("FileScan") == 1
    assert plan.index("Exchange") < plan.index("partial_count")
    assert "comment" not in plan


def test_hours_add_up_to_the_events(mixed):
    hours = historical.hourly_patterns(mixed)
    assert hours.agg(F.sum("total_events")).first()[0] == mixed.count()
    known = mixed.filter("is_bot IS NOT NULL").count()
    assert hours.agg(F.sum("bot_events") + F.sum("human_events")).first()[0] == known


def test_the_names_of_the_measures(spark):
    assert list(rollup.measures()) == rollup.MEASURES
