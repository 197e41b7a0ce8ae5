"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from checks import feed
from tidewatch.operators import dedup, heavy_hitters, historical, ingest, live, monitoring
from tidewatch.plans import (
    batch_job,
    history_reads,
    incremental,
    live_page,
    pipelines,
    retention,
    serving,
    sketches,
)
from tidewatch.schemas import (
    ANALYTICS_SCHEMA,
    FULL_SCHEMA,
    MINIMAL_SCHEMA,
    RECENT_CHANGES_SCHEMA,
    history_table,
)
from tidewatch.session import configure, work_dir
from tidewatch.sources import lake, payload, sse, topic
from tidewatch.sources.tables import read_table
from tidewatch.streaming import count_windows
from tidewatch.streaming import live as streams
from tidewatch.streaming.queries import run_available

Query = Callable[[SparkSession, str], DataFrame]

# The test table has about 14 events an hour; a week holds enough rows to compare.
LOOKBACK = 7 * 24 * 60
KEYWORDS = ["template", "user_7"]
CAP = 500
SPIKE = 1.5

_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    _QUERIES[query.__name__] = query
    return query


def _add(name: str, query: Query) -> None:
    _QUERIES[name] = query


def _comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone, which is what the other engine's tables hold."""
    return df.withColumns(
        {
            field.name: F.col(f"`{field.name}`").cast("timestamp_ntz")
            for field in df.schema
            if isinstance(field.dataType, TimestampType)
        }
    )


def all_queries() -> dict[str, Query]:
    def prepared(query: Query) -> Query:
        return lambda spark, sf_dir: _comparable(query(configure(spark), sf_dir))

    return {name: prepared(query) for name, query in _QUERIES.items()}


def _newest(df: DataFrame, time: str = "event_time") -> Column:
    """The table's latest time, as the moment a query is asked."""
    return df.agg(F.max(time)).scalar()


# --- ingest -------------------------------------------------------------------------------

SSE_COLUMNS = [
    "id", "timestamp", "type", "bot", "minor", "user", "server_name", "title", "namespace",
    "log_params", "len_old", "len_new",
]


@_register
def sse_parse(spark, sf_dir):
    decoded = sse.parse(feed.sse_lines(spark, sf_dir))
    return feed.flat(payload.accepted(decoded)).select(*SSE_COLUMNS)


@_register
def sse_rejects(spark, sf_dir):
    return payload.rejects(sse.parse(feed.sse_lines(spark, sf_dir)))


@_register
def max_messages(spark, sf_dir):
    events = feed.enriched(spark, sf_dir)
    return ingest.cap(events, CAP, ["id"]).select("id", "type", "title", "bytes_changed")


@_register
def ingest_stats(spark, sf_dir):
    return sse.parse(feed.sse_lines(spark, sf_dir)).agg(*ingest.ingest_counters())


@_register
def filter_events(spark, sf_dir):
    return feed.flat(ingest.filter_events(feed.raw(spark, sf_dir))).select(*SSE_COLUMNS)


@_register
def filter_events_talk_ids(spark, sf_dir):
    kept = ingest.filter_events(feed.raw(spark, sf_dir), skip_namespace_ids=True)
    return kept.select("id", "type", "namespace")


DERIVED = ["id", "is_bot", "is_minor", "is_new_page", "bytes_changed", "language", "project"]


@_register
def enrich_events(spark, sf_dir):
    return ingest.enrich_events(feed.raw(spark, sf_dir)).select(*DERIVED)


@_register
def normalize_events(spark, sf_dir):
    decoded = payload.accepted(sse.parse(feed.sse_lines(spark, sf_dir)))
    rows = ingest.normalize_events(ingest.enrich_events(ingest.filter_events(decoded)))
    return feed.flat(rows).select(*SSE_COLUMNS, *DERIVED[1:], "timestamp_imputed")


@_register
def kafka_records(spark, sf_dir):
    """Key and decoded check of the value; the JSON text itself differs between engines."""
    records = topic.encode(feed.enriched(spark, sf_dir))
    checked = "id BIGINT, bytes_changed BIGINT, length STRUCT<new: INT>"
    return records.select("key", F.from_json("value", checked).alias("event")).select(
        "key", "event.id", "event.bytes_changed", F.col("event.length.new").alias("len_new")
    )


@_register
def kafka_decode(spark, sf_dir):
    placed = feed.with_coordinates(feed.enriched(spark, sf_dir))
    records = topic.encode(placed).withColumn("value", F.encode("value", "utf-8"))
    return payload.accepted(topic.decode_records(records)).select(
        "partition", "offset", "timestamp", "type", "user", "server_name", *DERIVED
    )


@_register
def project_analytics(spark, sf_dir):
    return feed.flat(ingest.project_schema(feed.enriched(spark, sf_dir), ANALYTICS_SCHEMA))


@_register
def project_minimal(spark, sf_dir):
    return ingest.project_schema(feed.enriched(spark, sf_dir), MINIMAL_SCHEMA)


@_register
def project_full(spark, sf_dir):
    """All fields typed; the map's entries as text, in order of their keys."""
    full = feed.flat(ingest.project_schema(feed.enriched(spark, sf_dir), FULL_SCHEMA))
    entries = F.array_sort(F.map_entries("log_params"))
    shown = F.transform(entries, lambda entry: F.concat(entry["key"], F.lit("="), entry["value"]))
    return full.select(
        *SSE_COLUMNS[:9], *DERIVED[1:], F.array_join(shown, ",").alias("log_params")
    )


@_register
def dedup_events(spark, sf_dir):
    delivered = feed.twice(feed.enriched(spark, sf_dir))
    return dedup.dedup_events(delivered).select("id", "type", "user", "title", "bytes_changed")


# --- lake ---------------------------------------------------------------------------------

LAKE_COLUMNS = [
    "id", "timestamp", "type", "user", "server_name", "title", "is_bot", "is_new_page",
    "bytes_changed", "language", "project", "log_params", "timestamp_imputed", "year", "month",
]


def _written_lake(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> str:
    path = work_dir(spark, "lake")
    rows = feed.enriched(spark, sf_dir) if events is None else events
    lake.write_lake(ingest.normalize_events(rows), path, by="event_time")
    return path


def _feed_end(spark: SparkSession, sf_dir: str) -> Column:
    return _newest(feed.enriched(spark, sf_dir).select(F.timestamp_seconds("timestamp").alias("t")), "t")


@_register
def lake_roundtrip(spark, sf_dir):
    return lake.scan_lake(spark, _written_lake(spark, sf_dir), days_back=0).select(*LAKE_COLUMNS)


@_register
def lake_scan(spark, sf_dir):
    path = _written_lake(spark, sf_dir)
    end = _feed_end(spark, sf_dir)
    return lake.scan_lake(spark, path, days_back=7, as_of=end, by="event_time").select(
        *LAKE_COLUMNS
    )


@_register
def lake_backfill(spark, sf_dir):
    """One half of the feed streamed, the other appended by a batch job: both are read."""
    path = work_dir(spark, "lake")
    streamed = ingest.normalize_events(feed.enriched_stream(spark, sf_dir)).where("id % 2 = 0")
    run_available(lake.lake_writer(streamed, path, work_dir(spark, "checkpoint"), by="event_time"))
    events = ingest.normalize_events(feed.enriched(spark, sf_dir)).where("id % 2 = 1")
    lake.write_lake(events, path, by="event_time")
    return lake.scan_lake(spark, path, days_back=0).select(*LAKE_COLUMNS)


@_register
def lake_scan_future(spark, sf_dir):
    """Archived years before the events' own time: the look-back finds them in an old folder."""
    path, end = work_dir(spark, "lake"), _feed_end(spark, sf_dir)
    events = ingest.normalize_events(feed.enriched(spark, sf_dir))
    lake.write_lake(events, path, ingest_time=datetime(2000, 1, 1, tzinfo=timezone.utc))
    columns = [name for name in LAKE_COLUMNS if name not in lake.PARTITIONS]
    return lake.scan_lake(spark, path, days_back=7, as_of=end).select(*columns)


@_register
def lake_scan_daily(spark, sf_dir):
    """The same in a lake divided by day, half of it streamed: the look-back prunes folders."""
    path, end = work_dir(spark, "lake"), _feed_end(spark, sf_dir)
    archived = datetime(2000, 1, 1, tzinfo=timezone.utc)
    streamed = ingest.normalize_events(feed.enriched_stream(spark, sf_dir)).where("id % 2 = 0")
    checkpoint = work_dir(spark, "checkpoint")
    run_available(lake.lake_writer(streamed, path, checkpoint, ingest_time=archived, by_day=True))
    events = ingest.normalize_events(feed.enriched(spark, sf_dir)).where("id % 2 = 1")
    lake.write_lake(events, path, ingest_time=archived, by_day=True)
    columns = [name for name in LAKE_COLUMNS if name not in lake.PARTITIONS]
    return lake.scan_lake(spark, path, days_back=7, as_of=end).select(*columns)


@_register
def lake_scan_empty(spark, sf_dir):
    """A look-back window after the last event, and a lake that was never written."""
    later = _feed_end(spark, sf_dir) + F.expr("INTERVAL '100' DAY")
    written = lake.scan_lake(spark, _written_lake(spark, sf_dir), days_back=7, as_of=later)
    missing = lake.scan_lake(spark, work_dir(spark, "no-lake"))
    return written.unionByName(missing).select(*LAKE_COLUMNS)


@_register
def lake_compact(spark, sf_dir):
    compacted = work_dir(spark, "lake-compacted")
    lake.compact_lake(spark, _written_lake(spark, sf_dir), compacted)
    return lake.scan_lake(spark, compacted, days_back=0).select(*LAKE_COLUMNS)


# --- historical views ---------------------------------------------------------------------


def _history(view: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: view(feed.enriched(spark, sf_dir), **options)


for _view in (
    historical.hourly_patterns,
    historical.hourly_trends,
    historical.top_contributors,
    historical.language_distribution,
):
    _add(_view.__name__, _history(_view))
    _add(f"{_view.__name__}_literal", _history(_view, literal_counts=True))
_add("hourly_trends_range", _history(historical.hourly_trends, frame="range"))
_add("server_rankings", _history(historical.server_rankings))
# Fewer places than servers, so that the cut and the ranks beyond it are exercised.
_add("server_rankings_top3", _history(historical.server_rankings, top_n=3))
_add("top_contributors_top20", _history(historical.top_contributors, top_n=20))


def _stored_history(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    root = work_dir(spark, "history")
    counts = batch_job.run(
        spark, _written_lake(spark, sf_dir), batch_job.parquet_store(root), days_back=0
    )
    return root, counts


@_register
def batch_run(spark, sf_dir):
    """The whole job, lake to tables; rows stored per table."""
    root, _ = _stored_history(spark, sf_dir)
    return monitoring.table_counts(
        {
            history_table(view): batch_job.read_history(spark, root, view)
            for view in batch_job.HISTORY_SCHEMAS
        }
    )


def _history_read(view: str, read: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark, sf_dir):
        root, _ = _stored_history(spark, sf_dir)
        return read(batch_job.read_history(spark, root, view))

    return query


_add("hist_read_trends", _history_read("hourly_trends", history_reads.read_trends))
_add("hist_read_patterns", _history_read("hourly_patterns", history_reads.read_patterns))
_add("hist_read_languages", _history_read("language_distribution", history_reads.read_languages))
_add(
    "hist_read_languages_top3",
    _history_read("language_distribution", lambda rows: history_reads.read_languages(rows, 3)),
)
_add(
    "hist_read_servers_top3",
    _history_read("server_rankings", lambda rows: history_reads.read_servers(rows, 3)),
)
_add("hist_read_servers", _history_read("server_rankings", history_reads.read_servers))
_add("hist_read_contributors", _history_read("top_contributors", history_reads.read_contributors))


# --- live tables and queries --------------------------------------------------------------


@_register
def recent_changes(spark, sf_dir):
    return feed.changes(spark, sf_dir, carry=["id"])


@_register
def traffic_volume(spark, sf_dir):
    return live.traffic_volume(feed.changes(spark, sf_dir))


@_register
def traffic_volume_hourly(spark, sf_dir):
    return live.traffic_volume(feed.changes(spark, sf_dir), "1 hour")


@_register
def traffic_count_window(spark, sf_dir):
    """Over the records that the noise filter leaves, so that offsets have gaps."""
    return live.traffic_count_window(
        live.recent_changes(
            feed.with_coordinates(feed.enriched(spark, sf_dir)), carry=["partition", "offset"]
        )
    )


@_register
def stream_count_window(spark, sf_dir):
    """The same windows from a stream of a batch per file: two waves of offsets, each with a file per
    topic partition."""
    arrived, path = work_dir(spark, "arrivals"), work_dir(spark, "windows")
    records = live.recent_changes(
        feed.with_coordinates(feed.enriched(spark, sf_dir)), carry=["partition", "offset"]
    )
    checkpoint = work_dir(spark, "checkpoint")
    middle = records.agg(F.avg("offset")).first()[0]
    for wave in (F.col("offset") < middle, F.col("offset") >= middle):
        records.where(wave).repartition(feed.PARTITIONS, "partition").write.mode("append").parquet(
            arrived
        )
    stream = (
        spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    )
    run_available(count_windows.count_windows_writer(stream, path, checkpoint))
    return count_windows.read_count_windows(spark, path)


def _live(query: Callable[..., DataFrame], minutes: int = LOOKBACK, **options) -> Query:
    def run(spark, sf_dir):
        changes = feed.changes(spark, sf_dir)
        return query(changes, minutes=minutes, as_of=_newest(changes), **options)

    return run


def _live_traffic(query: Callable[..., DataFrame]) -> Query:
    def run(spark, sf_dir):
        changes = feed.changes(spark, sf_dir)
        return query(live.traffic_volume(changes), minutes=LOOKBACK, as_of=_newest(changes))

    return run


for _query in (live.live_traffic, live.live_velocity):
    _add(_query.__name__, _live_traffic(_query))
for _query in (
    live.live_servers,
    live.live_leaderboard,
    live.live_actions,
    live.live_severity,
    live.live_volume_change,
    live.live_namespaces,
    live.live_languages,
    live.live_users,
    live.live_power_users,
    live.live_user_histogram,
):
    _add(_query.__name__, _live(_query))
_add("live_severity_30min", _live(live.live_severity, live.LOOKBACK_MINUTES))
_add("live_servers_30min", _live(live.live_servers, live.LOOKBACK_MINUTES))
# Fewer rows than there are servers, languages and namespaces, so that the cut is exercised.
_add("live_servers_top3", _live(live.live_servers, top_n=3))
_add("live_languages_top3", _live(live.live_languages, top_n=3))
_add("live_namespaces_top2", _live(live.live_namespaces, top_n=2))
_add("live_avg_change", _live(monitoring.average_change))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = feed.changes(spark, sf_dir, carry=["id"])
    return live.live_recent(changes, LOOKBACK, _newest(changes), tie_break=["id"])


@_register
def live_recent(spark, sf_dir):
    return _latest(spark, sf_dir)


@_register
def live_battlefield(spark, sf_dir):
    return live.live_battlefield(_latest(spark, sf_dir)).select(
        "id", "event_time", "length_diff", "impact", "direction", "title", "user", "server_name"
    )


@_register
def live_kpis(spark, sf_dir):
    changes = feed.changes(spark, sf_dir)
    return live.live_kpis(live.traffic_volume(changes), changes, LOOKBACK, _newest(changes))


@_register
def live_sql(spark, sf_dir):
    """A parameterised SQL text over the registered live table."""
    serving.register({serving.RECENT_CHANGES: feed.changes(spark, sf_dir)})
    return serving.query(
        spark,
        f"""
        SELECT server_name, type, count(*) AS total_edits
        FROM {serving.RECENT_CHANGES}
        WHERE event_time >= (SELECT max(event_time) FROM {serving.RECENT_CHANGES})
                            - make_interval(0, 0, 0, 0, 0, :minutes)
        GROUP BY server_name, type HAVING count(*) >= :least
        """,
        {"minutes": LOOKBACK, "least": 2},
    )


# --- monitors -----------------------------------------------------------------------------


@_register
def keyword_monitor(spark, sf_dir):
    return monitoring.keyword_monitor(feed.changes(spark, sf_dir, carry=["id"]), KEYWORDS)


@_register
def hourly_spikes(spark, sf_dir):
    return monitoring.hourly_spikes(historical.hourly_trends(feed.enriched(spark, sf_dir)))


@_register
def hourly_spikes_over(spark, sf_dir):
    trends = historical.hourly_trends(feed.enriched(spark, sf_dir))
    return monitoring.hourly_spikes(trends, SPIKE)


@_register
def silence_gaps(spark, sf_dir):
    return monitoring.silence_gaps(feed.changes(spark, sf_dir))


@_register
def silence_now(spark, sf_dir):
    """Asked eight minutes after the last event."""
    changes = feed.changes(spark, sf_dir)
    later = _newest(changes) + F.expr("INTERVAL '8' MINUTE")
    return monitoring.silence_now(changes, as_of=later)


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven tables, the historical ones as the batch job stored them."""
    root, _ = _stored_history(spark, sf_dir)
    changes = feed.changes(spark, sf_dir)
    return {
        serving.TRAFFIC_VOLUME: live.traffic_volume(changes),
        serving.RECENT_CHANGES: changes,
        **{
            history_table(view): batch_job.read_history(spark, root, view)
            for view in batch_job.HISTORY_SCHEMAS
        },
    }


@_register
def freshness(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    time = {
        serving.TRAFFIC_VOLUME: "window_start",
        serving.RECENT_CHANGES: "event_time",
        history_table("hourly_patterns"): "hour_bucket",
        history_table("hourly_trends"): "hour_bucket",
    }
    return monitoring.freshness(
        {name: (tables[name], column) for name, column in time.items()},
        as_of=_newest(tables[serving.RECENT_CHANGES]),
    )


@_register
def table_counts(spark, sf_dir):
    return monitoring.table_counts(_tables(spark, sf_dir))


@_register
def incremental_hours(spark, sf_dir):
    """Three runs over a growing lake must equal one run over everything: the first part holds
    the oldest events and the very last one, the next what is new, the third what came late."""
    path, table = work_dir(spark, "lake"), work_dir(spark, "hours")
    events = ingest.normalize_events(feed.enriched(spark, sf_dir))
    middle, last = events.agg(F.avg("timestamp").cast("bigint"), F.max("id")).first()
    late, newest = F.col("id") % 10 == 3, F.col("id") == last
    old = F.col("timestamp") < middle
    for part in (~late & old | newest, ~late & ~old & ~newest, late & ~newest):
        lake.write_lake(events.filter(part), path, by="event_time")
        incremental.update_hours(spark, path, table)
    return incremental.read_hours(spark, table)


def _growing_state(spark: SparkSession, sf_dir: str) -> str:
    """Partials after three waves over a growing lake, half of it divided by day."""
    path, state = work_dir(spark, "lake"), work_dir(spark, "state")
    events = ingest.normalize_events(feed.enriched(spark, sf_dir))
    middle, last = events.agg(F.avg("timestamp").cast("bigint"), F.max("id")).first()
    late, newest = F.col("id") % 10 == 3, F.col("id") == last
    old = F.col("timestamp") < middle
    for part in (~late & old | newest, ~late & ~old & ~newest, late & ~newest):
        wave = events.filter(part)
        lake.write_lake(wave.where("id % 2 = 0"), path, by="event_time")
        lake.write_lake(wave.where("id % 2 = 1"), path, by_day=True)
        incremental.update(spark, path, state)
    return state


def _incremental(view: str) -> Query:
    def query(spark, sf_dir):
        rows = incremental.rollup_rows(spark, _growing_state(spark, sf_dir))
        return batch_job.views_of(rows)[view]

    return query


for _view_name in batch_job.HISTORY_SCHEMAS:
    _add(f"incremental_tables_{_view_name}", _incremental(_view_name))


@_register
def incremental_lookback(spark, sf_dir):
    """Server rankings of the last week from the partials; the cutoff divides a day."""
    state, end = _growing_state(spark, sf_dir), _feed_end(spark, sf_dir)
    rows = incremental.rollup_rows(spark, state, days_back=7, as_of=end)
    return batch_job.views_of(rows)["server_rankings"]


@_register
def server_users_sketch(spark, sf_dir):
    """Server rankings whose users come from hourly sketches, stored in two waves. So few users are
    counted exactly."""
    path, state, table = (work_dir(spark, name) for name in ("lake", "state", "sketches"))
    events = ingest.normalize_events(feed.enriched(spark, sf_dir))
    for wave in (F.col("id") % 3 != 0, F.col("id") % 3 == 0):
        lake.write_lake(events.where(wave), path, by_day=True)
        sketches.update_sketches(spark, path, state, table)
    return sketches.server_rankings(sketches.read_sketches(spark, table))


@_register
def incremental_late_file(spark, sf_dir):
    """Half of the events come in files that are two hours older than those already counted."""
    path, table = work_dir(spark, "lake"), work_dir(spark, "hours")
    events = ingest.normalize_events(feed.enriched(spark, sf_dir))
    lake.write_lake(events.where("id % 2 = 0"), path, by="event_time")
    incremental.update_hours(spark, path, table)
    lake.write_lake(events.where("id % 2 = 1"), path, by_day=True)
    feed.age_files(spark, lake.events_path(path, by_day=True), 2 * 3600)
    incremental.update_hours(spark, path, table)
    return incremental.read_hours(spark, table)


# --- streaming ----------------------------------------------------------------------------


@_register
def stream_recent_changes(spark, sf_dir):
    path = work_dir(spark, "changes")
    changes = live.recent_changes(feed.enriched_stream(spark, sf_dir))
    run_available(streams.recent_changes_writer(changes, path, work_dir(spark, "checkpoint")))
    return streams.read_appended_changes(spark, path).drop(streams.DAY)


def _stream_traffic(window: str) -> Query:
    def query(spark, sf_dir):
        path = work_dir(spark, "traffic")
        changes = live.recent_changes(feed.enriched_stream(spark, sf_dir))
        traffic = streams.traffic_stream(changes, window)
        run_available(streams.traffic_writer(traffic, path, work_dir(spark, "checkpoint")))
        return streams.read_traffic(spark, path, hours=0)

    return query


_add("stream_traffic", _stream_traffic(streams.WINDOW))
_add("stream_traffic_hourly", _stream_traffic("1 hour"))


@_register
def stream_traffic_fold(spark, sf_dir):
    """Hourly windows after six batches that each changed most of them, folded and folded again."""
    arrived, path = work_dir(spark, "arrivals"), work_dir(spark, "traffic")
    feed.deliver(feed.changes(spark, sf_dir), arrived, 6)
    stream = feed.delivered(spark, arrived, RECENT_CHANGES_SCHEMA)
    # The files are in no order of time, so the windows stay open for all of it.
    traffic = streams.traffic_stream(stream, "1 hour", watermark="1000 days")
    run_available(
        streams.traffic_writer(traffic, path, work_dir(spark, "checkpoint"), fold_every=2, fold_again=2)
    )
    return streams.read_traffic(spark, path, hours=0)


@_register
def stream_late_data(spark, sf_dir):
    """Every twentieth event arrives after all others: windows the watermark has closed by then
    do not change, the open ones do."""
    arrived = work_dir(spark, "arrivals")
    path, checkpoint = work_dir(spark, "traffic"), work_dir(spark, "checkpoint")
    changes = feed.changes(spark, sf_dir, carry=["id"])
    late = F.col("id") % 20 == 0
    for wave in (changes.filter(~late), changes.filter(late)):
        wave.drop("id").write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(RECENT_CHANGES_SCHEMA).parquet(arrived)
        traffic = streams.traffic_stream(stream, "1 hour")
        run_available(streams.traffic_writer(traffic, path, checkpoint))
    return streams.read_traffic(spark, path, hours=0)


@_register
def stream_dedup(spark, sf_dir):
    path, checkpoint = work_dir(spark, "dedup"), work_dir(spark, "checkpoint")
    delivered = feed.twice(feed.enriched_stream(spark, sf_dir)).withColumn(
        "event_time", F.timestamp_seconds("timestamp")
    )
    unique = dedup.dedup_stream(delivered, "10 seconds", spread=F.col("copy")).select(
        "id", "event_time", "type", "user", "title", "bytes_changed"
    )
    run_available(
        unique.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    )
    return read_table(spark, path, unique.schema)


@_register
def stream_archive(spark, sf_dir):
    path = work_dir(spark, "lake")
    rows = ingest.normalize_events(feed.enriched_stream(spark, sf_dir))
    run_available(lake.lake_writer(rows, path, work_dir(spark, "checkpoint"), by="event_time"))
    return lake.scan_lake(spark, path, days_back=0).select(*LAKE_COLUMNS)


def _live_tables(spark: SparkSession, sf_dir: str) -> str:
    root = work_dir(spark, "live")
    changes = live.recent_changes(feed.enriched_stream(spark, sf_dir))
    run_available(streams.live_tables_writer(changes, root, work_dir(spark, "checkpoint")))
    return root


@_register
def live_sink(spark, sf_dir):
    root = _live_tables(spark, sf_dir)
    return streams.read_live_traffic(spark, root, hours=0)


@_register
def live_fold(spark, sf_dir):
    """Traffic after six batches that were folded, and the folds again."""
    arrived, root = work_dir(spark, "arrivals"), work_dir(spark, "live")
    feed.deliver(feed.changes(spark, sf_dir), arrived, 6)
    stream = feed.delivered(spark, arrived, RECENT_CHANGES_SCHEMA)
    checkpoint = work_dir(spark, "checkpoint")
    run_available(streams.live_tables_writer(stream, root, checkpoint, fold_every=2, fold_again=2))
    return streams.read_live_traffic(spark, root, hours=0)


def _sketched(spark: SparkSession, sf_dir: str) -> str:
    """The live tables of three batches with sketches of heavy keys, folded after two."""
    arrived, root = work_dir(spark, "arrivals"), work_dir(spark, "live")
    feed.deliver(feed.changes(spark, sf_dir), arrived, 3)
    stream = feed.delivered(spark, arrived, RECENT_CHANGES_SCHEMA)
    checkpoint = work_dir(spark, "checkpoint")
    run_available(streams.live_tables_writer(stream, root, checkpoint, fold_every=2, hitters=True))
    return root


@_register
def stream_heavy_pages(spark, sf_dir):
    """The leaderboard of pages that merged sketches name, counted over the stored changes. There
    are fewer pages than are tracked, so the choice is exact."""
    root = _sketched(spark, sf_dir)
    found = streams.read_hitters(spark, root, hours=0)
    return heavy_hitters.leaderboard(streams.read_live_changes(spark, root, hours=0), found)


@_register
def stream_heavy_users(spark, sf_dir):
    """Users with the most changes, from the sketches alone."""
    found = streams.read_hitters(spark, _sketched(spark, sf_dir), hours=0)
    return heavy_hitters.heavy_keys(found, heavy_hitters.USER)


def _page(read: Callable[..., DataFrame]) -> Query:
    """Something of the live page, after three batches whose tables were folded."""

    def query(spark, sf_dir):
        arrived, root = work_dir(spark, "arrivals"), work_dir(spark, "live")
        changes = feed.changes(spark, sf_dir)
        feed.deliver(changes, arrived, 3)
        stream = feed.delivered(spark, arrived, RECENT_CHANGES_SCHEMA)
        checkpoint = work_dir(spark, "checkpoint")
        run_available(streams.live_tables_writer(stream, root, checkpoint, fold_every=2))
        newest = changes.agg(F.unix_seconds(F.max("event_time"))).first()[0]
        return read(spark, root, LOOKBACK, datetime.fromtimestamp(newest, timezone.utc))

    return query


_add("live_page_lists", _page(live_page.read_lists))
for _name in ("live_traffic", "live_users"):
    _add(
        _name.replace("live_", "live_page_"),
        _page(lambda *asked, name=_name: live_page.read_page(*asked)[name]),
    )


@_register
def pipeline_live(spark, sf_dir):
    """Topic records, every tenth delivered twice and every fiftieth malformed, to both live
    tables and quarantine; rows and bytes of each."""
    arrived, root = work_dir(spark, "arrivals"), work_dir(spark, "live")
    placed = feed.with_coordinates(feed.twice(feed.enriched(spark, sf_dir)))
    placed = placed.withColumn("offset", F.col("offset") * 2 + F.col("copy")).drop("copy")
    whole = F.get_json_object("value", "$.id").cast("bigint") % 50 != 0
    records = topic.encode(placed).withColumn(
        "value", F.when(whole, F.col("value")).otherwise(F.lit('{"id": 5, "log_params": {"a": '))
    )
    records.write.parquet(arrived)
    stream = spark.readStream.schema(records.schema).parquet(arrived)
    run_available(pipelines.records_to_live(stream, root, work_dir(spark, "checkpoint")))

    def summary(name: str, df: DataFrame, bytes_: str) -> DataFrame:
        total = F.coalesce(F.sum(bytes_), F.lit(0)).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("rows"), total.alias("bytes")).select(
            F.lit(name).alias("table_name"), "rows", "bytes"
        )

    rejects = pipelines.read_quarantine(spark, pipelines.rejects_path(root))
    return (
        summary("changes", streams.read_live_changes(spark, root, hours=0), "bytes_changed")
        .unionByName(summary("traffic", streams.read_live_traffic(spark, root, 0), "total_bytes"))
        .unionByName(summary("rejects", rejects.withColumn("none", F.lit(0)), "none"))
    )


@_register
def archive_dedup(spark, sf_dir):
    """Topic records that come again after every state is gone: in a later run of the stream, and in
    one that starts anew. The ledger alone keeps them out of the lake."""
    arrived, path, ledger = (work_dir(spark, name) for name in ("arrivals", "lake", "ledger"))
    placed = feed.with_coordinates(feed.enriched(spark, sf_dir))

    def run(checkpoint: str) -> None:
        stream = feed.delivered(spark, arrived, records.schema, parts=2)
        run_available(
            pipelines.records_to_lake_once(stream, path, ledger, checkpoint, None, fold_every=2)
        )

    checkpoint = work_dir(spark, "checkpoint")
    for delivered in (placed.where("id % 2 = 0"), placed):
        records = topic.encode(delivered)
        feed.deliver(records, arrived, 3)
        run(checkpoint)
    run(work_dir(spark, "checkpoint"))
    return lake.scan_lake(spark, path, days_back=0).select(
        "id", F.col("timestamp").alias("event_time"), "type", "user", "title", "bytes_changed"
    )


@_register
def retention_24h(spark, sf_dir):
    """Expired days are deleted from the stored table, the rest of the cutoff's day is left out
    on reading."""
    root = _live_tables(spark, sf_dir)
    stored = streams.read_live_changes(spark, root, hours=0)
    seconds = stored.agg(F.unix_seconds(F.max("event_time"))).first()[0]
    newest = datetime.fromtimestamp(seconds, timezone.utc)
    retention.expire_days(spark, streams.changes_path(root), as_of=newest)
    return streams.read_live_changes(spark, root, as_of=newest)
