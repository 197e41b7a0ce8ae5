"""Every registered query against its SQL, and rules all plans must keep."""

import pytest

import __spark_entry__ as entry
from checks import compare
from checks.oracle import all_oracles
from checks.registry import _QUERIES, all_queries
from tests.conftest import SMALL, plan_of
from tidewatch.streaming import live

WRITES = (
    "lake_", "batch_run", "hist_read_", "incremental_", "server_users_sketch", "stream_", "live_sink", "live_fold", "live_page_",
    "pipeline_live", "retention_",
    "freshness", "table_counts",
)


def test_same_names():
    assert set(all_queries()) == set(all_oracles()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(_QUERIES))
def test_equals_sql(spark, name):
    found = compare.difference(spark, SMALL, entry.queries()[name], entry.oracle_sql()[name])
    assert found is None


@pytest.mark.parametrize("name", sorted(n for n in _QUERIES if not n.startswith(WRITES)))
def test_plan_rules(spark, name):
    plan = plan_of(_QUERIES[name](spark, SMALL))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.count() > 0
    assert flagship.columns[-2:] == ["rank", "percentile"]


@pytest.mark.parametrize("name", ["stream_heavy_pages", "live_fold"])
def test_no_batch_is_read_by_one_task(spark, name, monkeypatch):
    tasks, store = [], live.store_live_batch

    def counted(changes, *asked):
        tasks.append(changes.rdd.getNumPartitions())
        store(changes, *asked)

    monkeypatch.setattr(live, "store_live_batch", counted)
    all_queries()[name](spark, SMALL)
    assert len(tasks) == {"stream_heavy_pages": 3, "live_fold": 6}[name] and min(tasks) > 1
