"""The archive that asks a ledger: late copies, retries, restarts, expiry, odd events."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks import feed
from tests.build import NOON, raw
from tidewatch.operators import dedup, ingest
from tidewatch.plans import pipelines, retention
from tidewatch.schemas import LAKE_SCHEMA
from tidewatch.sources import lake, payload, topic
from tidewatch.streaming import archive
from tidewatch.streaming.queries import run_available


@pytest.fixture
def at(tmp_path):
    return lambda name: str(tmp_path / name)


def keyed(spark, *events):
    return dedup.with_key(ingest.enrich_events(raw(spark, *events)), ["title"])


def event(number, seconds=0, **more):
    return {"id": number, "timestamp": NOON + seconds, "type": "edit", "title": f"p{number}", **more}


def when(seconds):
    return datetime.fromtimestamp(NOON + seconds, timezone.utc)


def ids(df):
    return sorted(row.id for row in df.select("id").collect())


def test_a_copy_an_hour_later_is_known_and_a_retry_is_not_its_own_copy(spark, at):
    first = keyed(spark, event(1), event(2), event(2), event(3, 86_400))
    archive.archive_batch(first, at("lake"), at("ledger"), 0, None)
    again = keyed(spark, event(1), event(4, 3_000))
    late = archive.not_archived(again, at("ledger"), 1, "10 minutes", when(3_600))
    assert ids(late) == [4]
    for _ in range(2):
        archive.archive_batch(first, at("lake"), at("ledger"), 0, None)
    assert ids(lake.scan_lake(spark, at("lake"), days_back=0)) == [1, 2, 3]
    assert archive.read_ledger(spark, at("ledger")).count() == 3


def test_young_events_are_not_asked_for(spark, at, monkeypatch):
    def unasked(*_):
        raise AssertionError("the ledger was read")

    monkeypatch.setattr(archive, "read_ledger", unasked)
    young = keyed(spark, event(1), event(1), event(2, 60))
    assert ids(archive.not_archived(young, at("ledger"), 0, "10 minutes", when(120))) == [1, 2]
    for seconds in (10 * 60, -60):
        with pytest.raises(AssertionError, match="was read"):
            archive.not_archived(young, at("ledger"), 0, "10 minutes", when(seconds))


def test_expired_days_are_forgotten(spark, at):
    events = keyed(spark, event(1), event(2, 10 * 86_400))
    archive.archive_batch(events, at("lake"), at("ledger"), 0, None)
    gone = retention.expire_levels(spark, at("ledger"), 24 * 5, when(11 * 86_400))
    assert gone == ["2024-01-15"]
    assert ids(archive.not_archived(events, at("ledger"), 1, None)) == [1]


def test_events_without_id_or_time(spark, at):
    odd = keyed(
        spark,
        {"title": "a", "type": "edit"}, {"title": "b", "type": "edit"}, {"title": "a", "type": "edit"},
        {"id": 7, "timestamp": 1_705_332_000_000, "title": "c"},
        {"id": 8, "timestamp": -5, "title": "d"}, {"id": 9, "title": "e"},
    )
    archive.archive_batch(odd.where("title <> 'c'"), at("lake"), at("ledger"), 0, None)
    assert lake.scan_lake(spark, at("lake"), days_back=0).count() == 4
    fresh = archive.not_archived(odd, at("ledger"), 1, None)
    assert [row.title for row in fresh.collect()] == ["c"]
    nothing = odd.limit(0)
    archive.archive_batch(nothing, at("lake"), at("ledger"), 1, None)
    assert lake.scan_lake(spark, at("lake"), days_back=0).count() == 4


def test_streams_that_start_anew_replace_and_repeat_nothing(spark, at):
    def deliver(*events):
        records = topic.encode(ingest.enrich_events(raw(spark, *events)))
        broken = records.limit(1).withColumn("value", F.lit("{"))
        records.unionByName(broken).coalesce(1).write.mode("append").parquet(at("source"))
        return records.schema

    def run(checkpoint):
        stream = spark.readStream.schema(shape).parquet(at("source"))
        writer = pipelines.records_to_lake_once(stream, at("lake"), at("ledger"), at(checkpoint), fold_every=2)
        run_available(writer)

    for number, checkpoint in ((1, "cp"), (2, "cp"), (3, "cp2"), (4, "cp"), (5, "cp3")):
        shape = deliver(event(number), event(1))
        run(checkpoint)
        wanted = list(range(1, number + 1))
        assert ids(lake.scan_lake(spark, at("lake"), days_back=0)) == wanted
    rejects = pipelines.read_quarantine(spark, pipelines.rejects_path(at("lake")))
    assert {row.payload for row in rejects.collect()} == {"{"}


def test_a_delivered_part_is_one_batch_and_many_tasks(spark, at):
    feed.deliver(spark.range(4_000), at("source"), 3)
    feed.deliver(spark.range(4_000, 6_000), at("source"), 1)
    seen = []

    def store(batch, _):
        seen.append((batch.rdd.getNumPartitions(), [row.id for row in batch.collect()]))

    stream = feed.delivered(spark, at("source"), spark.range(0).schema, parts=2)
    run_available(stream.writeStream.foreachBatch(store).option("checkpointLocation", at("cp")))
    assert len(seen) == 2 and sorted(sum((ids for _, ids in seen), [])) == list(range(6_000))
    assert min(tasks for tasks, _ in seen) > 1


def test_whether_a_payload_has_any_field_is_one_expression(spark):
    payloads = spark.createDataFrame([('{"id": 1}',), ('{"id": ',), ("[1]",), ("",), (None,)], "payload string")
    decoded = payload.decode(payloads, LAKE_SCHEMA)
    plan = decoded._jdf.queryExecution().analyzed().toString()
    assert "greatest(" in plan and "OR isnotnull" not in plan
    reasons = {row.payload: row.reject_reason for row in decoded.collect()}
    assert reasons.pop('{"id": 1}') is None and set(reasons.values()) == {payload.MALFORMED}


def test_the_optimizer_derives_few_constraints_from_a_decoded_payload(spark):
    payloads = spark.createDataFrame([('{"id": 1, "title": "a"}',), ('{"id": ',)], "payload string")
    decoded = payload.decode(payloads, LAKE_SCHEMA)
    good = payload.accepted(dedup.with_key(decoded, ["payload"], F.col("reject_reason").isNull()))
    for df in (decoded, good, payload.rejects(decoded)):
        plan = df._jdf.queryExecution().optimizedPlan()
        # Of a projection they were twice as many with every text field: over 30,000 each.
        assert plan.validConstraints().size() < 1_000
    assert [(row.id, row.title) for row in good.collect()] == [(1, "a")]
    assert [row.payload for row in payload.rejects(decoded).collect()] == ['{"id": ']
