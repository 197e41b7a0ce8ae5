"""Noise filter, enrichment and normalisation on hand-made events."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.build import NOON, raw
from tidewatch.functions import event as ev
from tidewatch.operators import dedup, ingest
from tidewatch.schemas import (
    ANALYTICS_SCHEMA,
    FULL_SCHEMA,
    LAKE_SCHEMA,
    MINIMAL_SCHEMA,
    MapType,
)


def test_type_allow_list(spark, rows):
    events = raw(spark, *[{"type": kind} for kind in ("edit", "new", "log", "categorize", None)])
    assert rows(ingest.filter_events(events), "type") == [("edit",), ("log",), ("new",)]


@pytest.mark.parametrize(
    "namespace, kept, kept_by_id",
    [("User_talk", False, False), ("TALK", False, False), ("1", True, False), ("0", True, True),
     ("-1", True, True), ("Template", True, True), (None, True, True)],
)
def test_namespace_deny_list(spark, namespace, kept, kept_by_id):
    events = raw(spark, {"type": "edit"}).withColumn("namespace", F.lit(namespace).cast("string"))
    assert ingest.filter_events(events).count() == kept
    assert ingest.filter_events(events, skip_namespace_ids=True).count() == kept_by_id


@pytest.mark.parametrize(
    "length, size, diff",
    [(None, 0, 0), ((None, 5), 5, 5), ((5, None), 5, -5), ((9, 4), 5, -5), ((4, 9), 5, 5), ((3, 3), 0, 0),
     ((-2147483648, 2147483647), 4294967295, 4294967295)],
)
def test_change_size(spark, length, size, diff):
    enriched = ingest.enrich_events(raw(spark, {"length": length}))
    row = enriched.withColumn("diff", ev.length_diff(F.col("length"))).first()
    assert (row.bytes_changed, row.diff) == (size, diff)


@pytest.mark.parametrize(
    "server, language, project",
    [("en.wikipedia.org", "en", "wikipedia"), ("www.wikidata.org", "www", "wikidata"), ("a.b", "a", "b"),
     ("a.", "a", ""), (".", "", ""), ("localhost", None, None), ("", None, None), (None, None, None)],
)
def test_language_and_project(spark, server, language, project):
    row = ingest.enrich_events(raw(spark, {"server_name": server})).first()
    assert (row.language, row.project) == (language, project)


def test_flags(spark):
    events = raw(spark, {"type": None}, {"bot": True, "minor": True, "type": "new"})
    enriched = ingest.enrich_events(events).collect()
    assert [(r.is_bot, r.is_minor, r.is_new_page) for r in enriched] == [
        (False, False, False),
        (True, True, True),
    ]
    assert ingest.enrich_events(events, keep_null_flags=True).first().is_bot is None


def test_normalised_rows_have_the_lake_shape_and_a_timestamp(spark):
    events = ingest.enrich_events(raw(spark, {"id": 1, "timestamp": NOON}, {"id": 2}))
    now = datetime(2024, 2, 1, tzinfo=timezone.utc)
    lake = ingest.normalize_events(events, ingest_time=now)
    assert lake.schema.simpleString() == LAKE_SCHEMA.simpleString()
    assert [(r.timestamp, r.timestamp_imputed) for r in lake.orderBy("id").collect()] == [
        (NOON, False),
        (int(now.timestamp()), True),
    ]
    again = ingest.normalize_events(lake, ingest_time=now).orderBy("id").collect()
    assert [r.timestamp_imputed for r in again] == [False, True]


def test_schema_projections(spark):
    events = ingest.enrich_events(raw(spark, {"user": "u", "length": (1, 2)}))
    for schema in (ANALYTICS_SCHEMA, MINIMAL_SCHEMA):
        assert ingest.project_schema(events, schema).schema.simpleString() == schema.simpleString()
    assert isinstance(FULL_SCHEMA["log_params"].dataType, MapType)
    assert len(FULL_SCHEMA) == len(LAKE_SCHEMA) - 1


def test_cap(spark, rows):
    events = raw(spark, *[{"id": n} for n in (3, 1, 2)])
    assert rows(ingest.cap(events, 2, ["id"]), "id") == [(1,), (2,)]
    assert ingest.cap(events, None, ["id"]).count() == 3


def test_batch_dedup_keeps_events_without_identity(spark, rows):
    events = raw(
        spark,
        {"id": 1, "user": "a"},
        {"id": 1, "user": "a"},
        {"id": 2, "user": "b", "meta": (None, None, "m", None, None, None, None, None, None)},
        {"id": 3, "user": "b", "meta": (None, None, "m", None, None, None, None, None, None)},
        {"user": "none"},
        {"user": "none"},
    )
    kept = rows(dedup.dedup_events(events), "user")
    assert kept == [("a",), ("b",), ("none",), ("none",)]


def test_missing_key_filter_reaches_the_scan(spark, tmp_path):
    from tests.conftest import plan_of

    raw(spark, {"id": 1}).write.parquet(str(tmp_path / "e"))
    plan = plan_of(dedup.dedup_events(spark.read.parquet(str(tmp_path / "e"))))
    assert "IsNull(id)" in plan
