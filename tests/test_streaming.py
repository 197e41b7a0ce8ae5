"""Streams against their batch twins, lateness, duplicates, restarts and retried batches."""

import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks import feed
from tests.build import HOUR, NOON, changes, raw
from tests.conftest import SMALL
from tidewatch.operators import dedup, ingest, live
from tidewatch.operators import live_page as operators_page
from tidewatch.plans import live_page, pipelines
from tidewatch.schemas import LAKE_SCHEMA, RECENT_CHANGES_SCHEMA, TRAFFIC_SCHEMA
from tidewatch.sources import files, lake, payload, sse, topic
from tidewatch.sources.tables import read_table
from tidewatch.streaming import count_windows, folding, silence
from tidewatch.streaming import live as streams
from tidewatch.streaming.queries import rows_dropped_late, run_available
from tidewatch.streaming.stats import IngestTotals, observe_ingest


@pytest.fixture
def at(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture(scope="module")
def batch(spark):
    return feed.changes(spark, SMALL).cache()


@pytest.fixture
def arrivals(spark, batch, at):
    """The changes in time order over several files, streamed one file per trigger."""
    path = at("arrivals")
    batch.repartitionByRange(4, "event_time").sortWithinPartitions("event_time").write.parquet(path)

    def stream(files=1):
        return (
            spark.readStream.schema(RECENT_CHANGES_SCHEMA)
            .option("maxFilesPerTrigger", files)
            .parquet(path)
        )

    return stream


def test_changes_stream_equals_batch(spark, batch, arrivals, at, rows):
    query = run_available(streams.recent_changes_writer(arrivals(), at("out"), at("cp")))
    assert query.lastProgress["batchId"] >= 3
    assert rows(streams.read_appended_changes(spark, at("out")).drop(streams.DAY)) == rows(batch)


@pytest.mark.parametrize("window", ["10 seconds", "1 hour"])
def test_traffic_stream_equals_batch_over_several_batches(spark, batch, at, rows, window):
    path = at("ordered")
    quarters = F.ntile(4).over(streams_window())
    for quarter in range(1, 5):
        part = batch.withColumn("q", quarters).filter(F.col("q") == quarter).drop("q")
        part.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(RECENT_CHANGES_SCHEMA).parquet(path)
        run_available(
            streams.traffic_writer(streams.traffic_stream(stream, window), at("out"), at("cp"))
        )
    assert rows(streams.read_traffic(spark, at("out"), hours=0)) == rows(live.traffic_volume(batch, window))


def streams_window():
    from pyspark.sql import Window

    return Window.orderBy("event_time")


def write_changes(spark, path, *seconds):
    rows = changes(spark, *[{"at": s, "bytes_changed": 1} for s in seconds])
    rows.coalesce(1).write.mode("append").parquet(path)


def traffic_run(spark, source, at):
    stream = spark.readStream.schema(RECENT_CHANGES_SCHEMA).parquet(source)
    return run_available(streams.traffic_writer(streams.traffic_stream(stream), at("out"), at("cp")))


def test_late_events_are_dropped_and_counted_across_restarts(spark, at):
    source = at("source")
    write_changes(spark, source, 0, 3, 100)
    assert rows_dropped_late(traffic_run(spark, source, at)) == 0
    # The watermark is at 90 s: the window of 11 s is closed, those of 95 s and 101 s are open.
    write_changes(spark, source, 11, 95, 101)
    assert rows_dropped_late(traffic_run(spark, source, at)) == 1
    got = streams.read_traffic(spark, at("out"), hours=0).select(
        F.unix_seconds("window_start") - NOON, "event_count"
    )
    assert sorted(tuple(r) for r in got.collect()) == [(0, 2), (90, 1), (100, 2)]


def delivered(spark, at, *events):
    """Write raw events as one more file of the stream's source."""
    rows = raw(spark, *events)
    rows.coalesce(1).write.mode("append").parquet(at("source"))


@pytest.mark.parametrize("spread", [None, F.col], ids=["plain", "spread"])
def test_duplicates_are_dropped_within_and_between_batches(spark, at, rows, spread):
    def run():
        stream = spark.readStream.schema(LAKE_SCHEMA).parquet(at("source")).withColumn(
            "event_time", F.timestamp_seconds("timestamp")
        )
        by = spread("namespace") if spread else None
        unique = dedup.dedup_stream(stream, delay="1 hour", spread=by).select("id", "user")
        run_available(
            unique.writeStream.format("parquet").option("path", at("out")).option("checkpointLocation", at("cp"))
        )

    same = {"id": 1, "user": "a", "timestamp": NOON}
    delivered(spark, at, *[{**same, "namespace": n} for n in range(5)], {"user": "x", "timestamp": NOON})
    run()
    delivered(
        spark, at, {**same, "namespace": 9}, {"id": 2, "user": "b", "timestamp": NOON}, {"user": "x", "timestamp": NOON}
    )
    run()
    assert rows(read_table(spark, at("out"), raw(spark).select("id", "user").schema)) == [
        (1, "a"), (2, "b"), (None, "x"), (None, "x"),
    ]


def test_restart_on_the_same_checkpoint_loses_and_repeats_nothing(spark, at, rows):
    source = at("source")
    for seconds in ((0, 1), (2,), (50, 60)):
        write_changes(spark, source, *seconds)
        for _ in range(2):
            stream = spark.readStream.schema(RECENT_CHANGES_SCHEMA).parquet(source)
            run_available(streams.live_tables_writer(stream, at("live"), at("cp")))
    stored = spark.read.schema(RECENT_CHANGES_SCHEMA).parquet(source)
    assert rows(streams.read_live_changes(spark, at("live"), hours=0)) == rows(stored)
    traffic = streams.read_live_traffic(spark, at("live"), hours=0)
    assert rows(traffic) == rows(live.traffic_volume(stored))


def test_a_retried_batch_replaces_itself(spark, at, rows):
    batch = changes(spark, {"at": 0, "bytes_changed": 3}, {"at": 20, "bytes_changed": 4})
    for _ in range(3):
        folding.write_batch(batch, "event_time", at("changes"), 7)
    folding.write_batch(changes(spark, {"at": 1, "bytes_changed": 5}), "event_time", at("changes"), 8)
    assert spark.read.parquet(at("changes")).count() == 3


def test_an_empty_batch_writes_nothing(spark, at):
    folding.write_batch(changes(spark).limit(0), "event_time", at("changes"), 0)
    assert read_table(spark, at("changes"), RECENT_CHANGES_SCHEMA).isEmpty()


def test_an_error_in_a_batch_fails_the_query(spark, at):
    source = at("source")
    write_changes(spark, source, 0)
    stream = spark.readStream.schema(RECENT_CHANGES_SCHEMA).parquet(source).withColumn(
        "bytes_changed", F.raise_error(F.lit("sink is down")).cast("bigint")
    )
    with pytest.raises(Exception, match="sink is down"):
        run_available(streams.live_tables_writer(stream, at("live"), at("cp")))
    healthy = spark.readStream.schema(RECENT_CHANGES_SCHEMA).parquet(source)
    run_available(streams.live_tables_writer(healthy, at("live"), at("cp")))
    assert streams.read_live_changes(spark, at("live"), hours=0).count() == 1


def test_retention_on_read_prunes_days(spark, at):
    from tests.conftest import plan_of

    for batch_id, seconds in enumerate((0, 30 * HOUR, 50 * HOUR)):
        folding.write_batch(
            changes(spark, {"at": seconds}), "event_time", streams.changes_path(at("live")), batch_id
        )
    now = datetime.fromtimestamp(NOON + 50 * HOUR, timezone.utc)
    kept = streams.read_live_changes(spark, at("live"), as_of=now)
    assert kept.count() == 2
    assert "event_date" in plan_of(kept).split("PartitionFilters")[1]


def captured(spark, at):
    lines = feed.sse_lines(spark, SMALL)
    lines.repartition(2).write.text(at("captured"))
    return lines


def test_ingest_counters_of_a_stream(spark, at):
    lines = captured(spark, at)
    want = sse.parse(lines).agg(*ingest.ingest_counters()).first().asDict()
    listener = IngestTotals()
    spark.streams.addListener(listener)
    try:
        decoded = observe_ingest(sse.parse(sse.stream_lines(spark, at("captured"), 1)))
        sink = pipelines.to_publish(decoded).select("id").writeStream.format("parquet")
        query = run_available(sink.option("path", at("out")).option("checkpointLocation", at("cp")))
        assert len(query.recentProgress) == 2
        # Progress events are delivered in the background.
        for _ in range(100):
            if listener.totals == want:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals == want


def test_from_captured_lines_to_lake_and_live_tables(spark, at, rows):
    """Feed -> records -> archive and live tables, rejects to quarantine."""
    lines = captured(spark, at)
    stream = sse.stream_lines(spark, at("captured"))

    def send(records):
        records.write.mode("append").parquet(at("topic"))

    run_available(pipelines.lines_to_records(stream, send, at("cps")))
    found = pipelines.read_quarantine(spark, at("cps") + "/rejects")
    assert rows(found) == rows(payload.rejects(sse.parse(lines)))

    def consume():
        return spark.readStream.schema("key STRING, value STRING").parquet(at("topic"))

    run_available(pipelines.records_to_lake(consume(), at("lake"), at("cp2"), by="event_time"))
    run_available(pipelines.records_to_live(consume(), at("live"), at("cp3")))
    sent = pipelines.to_publish(sse.parse(lines))
    archived = lake.scan_lake(spark, at("lake"), 0)
    assert rows(archived, "id", "bytes_changed", "language") == rows(sent, "id", "bytes_changed", "language")
    live_rows = streams.read_live_changes(spark, at("live"), hours=0)
    assert rows(live_rows) == rows(live.recent_changes(sent))


def test_counters_are_observed_where_batches_are_kept(spark, at):
    lines = captured(spark, at)
    want = sse.parse(lines).agg(*ingest.ingest_counters()).first().asDict()
    listener = IngestTotals()
    spark.streams.addListener(listener)
    try:
        writer = pipelines.lines_to_records(
            sse.stream_lines(spark, at("captured")), lambda records: records.count(), at("cps")
        )
        run_available(writer)
        for _ in range(100):
            if listener.totals:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals == want


def test_folded_levels_hold_each_batch_once(spark, at, rows):
    path, every = at("changes"), []
    read = lambda: folding.read_levels(spark, path, RECENT_CHANGES_SCHEMA).drop("event_date", "batch_id")

    def fold(up_to, level=0):
        folding.fold(spark, path, RECENT_CHANGES_SCHEMA, "event_time", up_to, level)

    for batch_id in range(7):
        batch = changes(spark, {"at": batch_id, "bytes_changed": batch_id})
        folding.write_batch(batch, "event_time", path, batch_id)
        every.append(batch_id)
        if batch_id in (2, 4, 6):
            fold(batch_id - 1)
            fold(batch_id - 1)
        if batch_id == 4:
            fold(1, level=1)
            # Written by a fold that did not get as far as its mark.
            folding.write_batch(batch, "event_time", folding.level_path(path, 1), 99)
        assert sorted(r.bytes_changed for r in read().collect()) == every
    days = [name for name in files.names(spark, path) if name.startswith("event_date")]
    assert len(files.names(spark, f"{path}/{days[0]}")) == 3


def test_archive_stream_by_ingest_time(spark, at):
    delivered(spark, at, {"id": 1, "timestamp": NOON})
    stream = spark.readStream.schema(LAKE_SCHEMA).parquet(at("source"))
    now = datetime(2024, 5, 2, tzinfo=timezone.utc)
    run_available(lake.lake_writer(ingest.normalize_events(stream), at("lake"), at("cp"), ingest_time=now))
    row = lake.scan_lake(spark, at("lake"), 0).first()
    assert (row.year, row.month) == (2024, 5)


# --- event-time traffic as a job, the page from minute partials ----------------------------


def moments(spark, *pairs):
    """Change rows at ``(seconds, bytes)``."""
    return changes(spark, *[{"at": at, "bytes_changed": size} for at, size in pairs])


def test_a_newer_state_of_a_window_supersedes_folded_ones(spark, at, rows):
    def store(batch_id, *windows):
        states = spark.createDataFrame(
            [(datetime.fromtimestamp(NOON + start, timezone.utc), size, 1, 0.0) for start, size in windows],
            TRAFFIC_SCHEMA,
        )
        folding.write_batch(states, "window_start", at("t"), batch_id)
        folding.fold_when_due(spark, at("t"), TRAFFIC_SCHEMA, "window_start", batch_id, 2, 2, streams.newest)

    expected = {}
    for batch_id in range(9):
        windows = [(10 * (batch_id % 3), batch_id), (100, 50 + batch_id)]
        store(batch_id, *windows)
        store(batch_id, *windows)
        expected.update(windows)
        found = streams.read_traffic(spark, at("t"), hours=0)
        assert {r.window_start.replace(tzinfo=timezone.utc).timestamp() - NOON: r.total_bytes for r in found.collect()} == expected
        assert {r.avg_bytes_per_event for r in found.collect()} == set(map(float, expected.values()))
    assert files.names(spark, folding.level_path(at("t"), 2))


def test_the_traffic_job_equals_batch_and_reads_by_time(spark, at, rows):
    events = feed.enriched(spark, SMALL)
    records = topic.encode(feed.with_coordinates(events))
    records.repartition(4).write.parquet(at("topic"))
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(at("topic"))
    writer = pipelines.records_to_traffic(stream, at("live"), at("cp"), "1 hour", "1000 days")
    run_available(writer)
    whole = live.traffic_volume(live.recent_changes(events), "1 hour")
    path = streams.window_traffic_path(at("live"))
    assert rows(streams.read_traffic(spark, path, hours=0)) == rows(whole)
    newest = whole.agg(F.unix_seconds(F.max("window_start"))).first()[0]
    now = datetime.fromtimestamp(newest, timezone.utc)
    day = streams.read_traffic(spark, path, hours=24, as_of=now)
    since = F.unix_seconds("window_start") >= newest - 24 * HOUR
    assert rows(day) == rows(whole.where(since)) and day.count() < whole.count()
    # Older days are not even listed.
    states = folding.read_levels(spark, path, TRAFFIC_SCHEMA, streams._first_day(24, now))
    assert 0 < len(states.inputFiles()) < len(folding.read_levels(spark, path, TRAFFIC_SCHEMA).inputFiles())


@pytest.mark.parametrize("seconds", [0, 17])
def test_the_page_equals_the_queries_over_all_changes(spark, batch, at, rows, seconds):
    """Also where the cutoff lies inside a minute, and with folded partials."""
    batch.repartition(3).write.parquet(at("arrivals"))
    stream = spark.readStream.schema(RECENT_CHANGES_SCHEMA).option("maxFilesPerTrigger", 1).parquet(at("arrivals"))
    run_available(streams.live_tables_writer(stream, at("live"), at("cp"), fold_every=2))
    newest = batch.agg(F.unix_seconds(F.max("event_time"))).first()[0]
    now = datetime.fromtimestamp(newest - newest % 60 + seconds, timezone.utc)
    minutes = 5 * 24 * 60
    page = live_page.read_page(spark, at("live"), minutes, now)
    traffic = live.traffic_volume(batch)
    for name, found in page.items():
        over = traffic if name in ("live_traffic", "live_velocity") else batch
        expected = getattr(live, name)(over, minutes=minutes, as_of=now)
        assert found.columns == expected.columns, name
        if name in ("live_severity", "live_volume_change", "live_users", "live_recent"):
            assert rows(found) == rows(expected), name
        else:
            assert found.collect() == expected.collect(), name


def test_minute_partials_of_odd_changes(spark, rows):
    odd = changes(
        spark,
        {"at": 0, "title": "a:b:c", "server_name": "x", "type": "edit", "bytes_changed": -7, "length_diff": None},
        {"at": 1, "title": None, "server_name": None, "user": None, "type": None, "bytes_changed": 1001, "length_diff": 0},
        {"at": 61, "title": ":", "server_name": "", "user": "", "type": "", "bytes_changed": 0, "length_diff": -3},
    )
    found = operators_page.minute_partials(odd)
    assert rows(operators_page.merged(found.unionByName(found)).selectExpr("edits div 2", "moved div 2")) == rows(found, "edits", "moved")
    counted = {(r.dimension, r.key, r.key_2): (r.edits, r.moved) for r in found.where("minute = date_trunc('minute', timestamp_seconds(%d))" % NOON).collect()}
    assert counted[("namespace", "a", None)] == (1, 7) and ("namespace", None, None) not in counted
    assert counted[("server", None, None)] == (1, 1001) and counted[("page", None, None)] == (1, 1001)
    assert counted[("change", "Addition", None)] == (1, 0) and counted[("change", "Deletion", None)] == (1, None)
    assert counted[("severity", "Major", None)] == (1, 1001) and counted[("severity", "Minor", None)] == (1, 7)
    assert operators_page.minute_partials(odd.limit(0)).isEmpty()
    assert operators_page.top_lists(operators_page.minute_partials(odd.limit(0))).isEmpty()


# --- count windows, silence ---------------------------------------------------------------


def topic_records(spark, *rows):
    """Records ``(partition, offset, bytes)``, stamped by their offset."""
    frame = spark.createDataFrame(rows, "partition int, offset long, bytes_changed long")
    return frame.withColumn("event_time", F.timestamp_seconds(F.lit(NOON) + F.col("offset")))


def test_count_windows_over_batches_gaps_and_retries(spark, at, rows, monkeypatch):
    monkeypatch.setattr(live, "OFFSET_SPAN", 4)
    batches = [
        [(0, 0, 1), (0, 3, 2), (1, 5, 10)],
        [(1, 6, 20)],
        [(0, n, 1) for n in range(10, 31, 2)] + [(1, 7, 30), (2, 0, 5)],
        [(0, 40, 100)],
    ]
    every = []
    for batch_id, batch in enumerate(batches):
        every += batch
        for _ in range(2):
            count_windows.store_windows(topic_records(spark, *batch), at("w"), batch_id, 3)
        expected = live.traffic_count_window(topic_records(spark, *every), 3)
        assert rows(count_windows.read_count_windows(spark, at("w"))) == rows(expected)
    assert len(files.names(spark, count_windows.open_path(at("w")))) == 2
    count_windows.store_windows(topic_records(spark, *batches[0]).limit(0), at("w"), 4, 3)
    assert rows(count_windows.read_count_windows(spark, at("w"))) == rows(expected)
    held = read_table(spark, f"{count_windows.open_path(at('w'))}/batch_id=4", count_windows.OPEN)
    assert rows(held, "partition", "event_count") == [(0, 2), (2, 1)]


def test_a_silence_is_told_when_it_begins_and_when_it_ends(spark, at):
    def send(name):
        spark.createDataFrame([(name,)] * 3, "feed string").coalesce(1).write.mode("append").parquet(at("in"))

    def wait(count):
        for _ in range(300):
            found = silence.read_alarms(spark, at("alarms")).orderBy("silent_since", "silent_until").collect()
            if len(found) >= count:
                return found
            time.sleep(0.2)
        raise AssertionError(f"{len(found)} alarms, {count} expected")

    send("a")
    stream = spark.readStream.schema("feed string").parquet(at("in"))
    writer = silence.alarms_writer(silence.silence_alarms(stream, 4), at("alarms"), at("cp"))
    query = writer.trigger(processingTime="1 second").start()
    try:
        begun = wait(1)[0]
        assert begun.silent_until is None and begun.seconds >= 4
        send("b")
        ended = [row for row in wait(2) if row.silent_until is not None][0]
        assert ended.silent_since == begun.silent_since and ended.silent_until > ended.silent_since
        # It falls silent again.
        assert sum(row.silent_until is None for row in wait(3)) == 2
    finally:
        query.stop()


def test_feeds_are_told_apart_before_the_state(spark):
    frame = spark.createDataFrame([(n % 3,) for n in range(5_000)], "p int").coalesce(1)
    found = silence._arrivals(frame, F.col("p")).collect()
    assert {row.feed for row in found} == {"0", "1", "2"} and len(found) < 30
