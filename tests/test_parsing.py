"""Captured lines and topic records: what is kept, rejected, cast and ignored."""

import json

import pytest
from pyspark.sql import functions as F

from tests.build import raw
from tidewatch.operators import ingest
from tidewatch.schemas import RAW_SCHEMA
from tidewatch.sources import payload, sse, topic


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value STRING")


def event(spark, **fields):
    parsed = sse.parse(lines(spark, "data: " + json.dumps(fields, ensure_ascii=False)))
    return payload.accepted(parsed)


def test_only_data_lines_are_payloads(spark):
    feed = lines(spark, "event: message", "id: [1]", ":ok", "", "data:{}", ' data: {"id":1}', "data: {}")
    assert [row.payload for row in sse.payloads(feed).collect()] == ["{}"]


@pytest.mark.parametrize(
    "text", ["{broken", '{"id":5,"user":"ok"', "[1,2]", "7", '"text"', "null", ""]
)
def test_a_payload_that_is_no_object_is_rejected(spark, text):
    parsed = sse.parse(lines(spark, "data: " + text, 'data: {"id":1,"type":"edit"}'))
    assert [tuple(row) for row in payload.rejects(parsed).collect()] == [(text, "malformed")]
    assert payload.accepted(parsed).select("id").collect() == [(1,)]


def test_odd_values_are_not_malformed(spark):
    row = event(
        spark, id="12", type="edit", namespace="User_talk", length=7, meta=[1], bot="x", user="after"
    ).first()
    assert (row.id, row.namespace, row.length, row.meta, row.bot) == (12, "User_talk", None, None, None)
    assert row.user == "after"


@pytest.mark.parametrize(
    "sent, read",
    [(1705334400, 1705334400), ("1705334400", 1705334400), (17.9, 17), ("x", None), (None, None)],
)
def test_timestamps_arrive_in_many_forms(spark, sent, read):
    assert event(spark, id=1, timestamp=sent).first().timestamp == read


@pytest.mark.parametrize(
    "sent, read",
    [
        ({"a": ["é", 1]}, '{"a":["é",1]}'),
        (["x", 2], '["x",2]'),
        ("bare", "bare"),
        (None, None),
    ],
)
def test_log_params_become_json_text(spark, sent, read):
    stored = event(spark, id=1, log_params=sent).first().log_params
    assert stored == read


def test_struct_leaves_are_cast(spark):
    row = event(
        spark, id=1, length={"old": 3, "new": "8"}, meta={"id": "m", "partition": 2}, revision={"new": 9}
    ).first()
    assert (row.length.old, row.length.new, row.meta.id, row.meta.partition) == (3, 8, "m", 2)
    assert (row.revision.old, row.revision.new) == (None, 9)


def test_null_length_is_rejected_on_request_only(spark):
    texts = ['{"id":1,"length":{"old":null,"new":5}}', '{"id":2,"length":{"new":5}}', '{"id":3,"length":null}']
    feed = lines(spark, *["data: " + text for text in texts])
    assert payload.rejects(sse.parse(feed)).count() == 0
    strict = payload.rejects(sse.parse(feed, reject_null_length=True))
    assert [tuple(row) for row in strict.collect()] == [(texts[0], "null_length")]


def test_each_payload_is_parsed_once(spark):
    from tests.conftest import plan_of

    plan = plan_of(payload.accepted(sse.parse(lines(spark, "data: {}"))))
    assert plan.count("from_json(") == 1


def test_unused_fields_are_not_cast(spark):
    decoded = payload.accepted(sse.parse(lines(spark, "data: {}"))).select("user")
    from tests.conftest import plan_of

    assert "try_cast" not in plan_of(decoded)


def test_ingest_counters(spark):
    feed = lines(
        spark,
        'data: {"type":"edit"}',
        'data: {"type":"categorize"}',
        'data: {"type":"new","namespace":"Talk"}',
        "data: {broken",
        ": comment",
    )
    counted = sse.parse(feed).agg(*ingest.ingest_counters()).first().asDict()
    assert counted == {"seen": 4, "failed": 1, "skipped": 2, "sent": 1}


def test_topic_round_trip(spark):
    sent = ingest.enrich_events(
        raw(
            spark,
            {"id": 1, "type": "new", "timestamp": 5, "server_name": "en.wikipedia.org", "length": (3, 8)},
            {"id": 2, "type": "edit", "bot": True, "title": "é"},
        )
    )
    records = topic.encode(sent)
    assert [row.key for row in records.orderBy("value").collect()] == ["en.wikipedia.org", "unknown"]
    assert set(json.loads(records.filter("key = 'unknown'").first().value)) >= {"id", "title", "is_bot"}
    binary = records.select(F.encode("value", "utf-8").alias("value"), F.lit(4).alias("partition"))
    back = payload.accepted(topic.decode_records(binary)).orderBy("id").collect()
    assert [(row.id, row.bytes_changed, row.language, row.is_new_page) for row in back] == [
        (1, 5, "en", True),
        (2, 0, None, False),
    ]
    assert {row.partition for row in back} == {4}


def test_topic_options():
    live = topic.source_options("h:1", "t")
    assert live == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"}
    archive = topic.source_options("h:1", "t", min_offsets=5000, max_delay="60s")
    assert (archive["minOffsetsPerTrigger"], archive["maxTriggerDelay"]) == ("5000", "60s")
    assert topic.sink_options("h:1", "t")["kafka.acks"] == "all"


def test_raw_schema_is_delivered_in_full(spark):
    assert event(spark, id=1).columns == RAW_SCHEMA.fieldNames()
