"""The long-running streams, put together from their sources, operators and sinks.

Every function returns a writer that is not started yet; ``streaming.queries`` starts it, either
for what is there now or for good. Each stream parses a payload in one place: a micro-batch is kept
while its good events go to their sink and its malformed payloads to quarantine, and the counters
of ``stats.IngestTotals`` are observed on the way.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewatch.operators import dedup, ingest
from tidewatch.operators.live import recent_changes
from tidewatch.schemas import TEXT, struct
from tidewatch.sources import lake, payload, sse, topic
from tidewatch.sources.tables import read_table
from tidewatch.streaming import archive, folding, silence
from tidewatch.streaming import live as streams
from tidewatch.streaming.stats import observe_ingest

# An archive batch closes at this many records or after this long.
ARCHIVE_RECORDS = 5000
ARCHIVE_DELAY = "60s"
# How long after its first copy an event's redelivery is recognised.
DEDUP_DELAY = "10 minutes"
REJECTS = struct({"payload": TEXT, "reject_reason": TEXT})

Send = Callable[[DataFrame], None]


def captured_to_topic(
    spark: SparkSession,
    captured: str,
    servers: str,
    topic_name: str,
    checkpoints: str,
    max_files_per_trigger: int | None = None,
) -> DataStreamWriter:
    """Captured feed files -> topic, and malformed payloads -> quarantine table."""
    options = topic.sink_options(servers, topic_name)

    def send(records: DataFrame) -> None:
        records.write.format("kafka").options(**options).save()

    lines = sse.stream_lines(spark, captured, max_files_per_trigger)
    return lines_to_records(lines, send, checkpoints)


def lines_to_records(lines: DataFrame, send: Send, checkpoints: str) -> DataStreamWriter:
    def store(batch: DataFrame, batch_id: int) -> None:
        send(topic.encode(to_publish(batch)))
        quarantine(batch, f"{checkpoints}/rejects", batch_id)

    decoded = observe_ingest(sse.parse(lines))
    return _each_batch(decoded, store, f"{checkpoints}/ingest")


def to_publish(decoded: DataFrame) -> DataFrame:
    """Decoded events -> the filtered, enriched events a topic carries."""
    return ingest.enrich_events(ingest.filter_events(payload.accepted(decoded)))


def quarantine(batch: DataFrame, path: str, batch_id: int) -> None:
    """Store a batch's malformed payloads; a retried batch replaces its own."""
    payload.rejects(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, REJECTS).select(*REJECTS.fieldNames())


def topic_to_live(
    spark: SparkSession,
    servers: str,
    topic_name: str,
    root: str,
    checkpoint: str,
    max_offsets: int | None = None,
    hitters: bool = False,
) -> DataStreamWriter:
    """Topic -> both live tables. ``max_offsets`` bounds a batch, such as the first after a stop."""
    options = topic.source_options(servers, topic_name, max_offsets=max_offsets)
    return records_to_live(
        topic.read_stream(spark, options), root, checkpoint, hitters=hitters
    )


def records_to_live(
    records: DataFrame,
    root: str,
    checkpoint: str,
    dedup_delay: str | None = DEDUP_DELAY,
    hitters: bool = False,
) -> DataStreamWriter:
    """Both live tables, and ``<root>/rejects``; with ``hitters`` sketches of the heaviest pages and
    users. Redelivered events count once (see ``dedup_stream``); ``dedup_delay`` of None counts each
    delivery and needs no state."""

    def store(batch: DataFrame, batch_id: int) -> None:
        events = ingest.normalize_events(payload.accepted(batch))
        streams.store_live_batch(recent_changes(events), root, batch_id, hitters=hitters)
        quarantine(batch, rejects_path(root), batch_id)

    return _each_batch(_decoded_once(records, dedup_delay), store, checkpoint)


def rejects_path(root: str) -> str:
    return f"{root.rstrip('/')}/rejects"


def topic_to_traffic(
    spark: SparkSession,
    servers: str,
    topic_name: str,
    root: str,
    checkpoint: str,
    max_offsets: int | None = None,
) -> DataStreamWriter:
    """Topic -> event-time traffic windows, with a position of its own."""
    options = topic.source_options(servers, topic_name, max_offsets=max_offsets)
    return records_to_traffic(topic.read_stream(spark, options), root, checkpoint)


def records_to_traffic(
    records: DataFrame,
    root: str,
    checkpoint: str,
    window: str = streams.WINDOW,
    watermark: str = streams.WATERMARK,
) -> DataStreamWriter:
    """Event-time windows below ``root``, late events dropped and counted. A redelivered event counts
    again: an open window is shown before it is final, and Spark has no deduplication ahead of an
    aggregation whose rows may still change."""
    decoded = observe_ingest(topic.decode_records(records))
    changes = recent_changes(ingest.normalize_events(payload.accepted(decoded)))
    traffic = streams.traffic_stream(changes, window, watermark)
    return streams.traffic_writer(traffic, streams.window_traffic_path(root), checkpoint)


def topic_to_alarms(
    spark: SparkSession, servers: str, topic_name: str, root: str, checkpoint: str, seconds: int
) -> DataStreamWriter:
    """Topic -> rows below ``root`` when the whole of it falls silent, and when that ends."""
    records = topic.read_stream(spark, topic.source_options(servers, topic_name))
    alarms = silence.silence_alarms(records, seconds)
    return silence.alarms_writer(alarms, alarms_path(root), checkpoint)


def alarms_path(root: str) -> str:
    return f"{root.rstrip('/')}/silence_alarms"


def topic_to_lake(
    spark: SparkSession,
    servers: str,
    topic_name: str,
    lake_path: str,
    checkpoint: str,
    by_day: bool = True,
    ledger: str | None = None,
) -> DataStreamWriter:
    """Topic -> lake, with its own position, independent of the live tables; with a ``ledger`` of keys
    each event once, by day, however late its copies come.

    The source closes a batch at ``ARCHIVE_RECORDS`` records or ``ARCHIVE_DELAY``, whichever comes
    first, as often as the trigger looks: start it with a short interval.
    """
    options = topic.source_options(
        servers, topic_name, min_offsets=ARCHIVE_RECORDS, max_delay=ARCHIVE_DELAY
    )
    records = topic.read_stream(spark, options)
    if ledger is not None:
        return records_to_lake_once(records, lake_path, ledger, checkpoint)
    return records_to_lake(records, lake_path, checkpoint, by_day=by_day)


def records_to_lake(
    records: DataFrame,
    lake_path: str,
    checkpoint: str,
    by: str = "ingest_time",
    dedup_delay: str | None = DEDUP_DELAY,
    by_day: bool = False,
) -> DataStreamWriter:
    """The lake's streamed files, through the file sink's commit log. Malformed records are counted
    by the observed metrics; their text is kept by the live stream's quarantine."""
    decoded = _decoded_once(records, dedup_delay)
    events = ingest.normalize_events(payload.accepted(decoded))
    return lake.lake_writer(events, lake_path, checkpoint, by=by, by_day=by_day)


def records_to_lake_once(
    records: DataFrame,
    lake_path: str,
    ledger: str,
    checkpoint: str,
    dedup_delay: str | None = DEDUP_DELAY,
    fold_every: int = folding.FOLD_BATCHES,
) -> DataStreamWriter:
    """The lake's events of the ledger's archive, and ``<lake>/rejects``. Copies within ``dedup_delay``
    are dropped by the stream's state, later ones by the ledger (see ``archive``); with a delay of None
    the ledger alone answers, for every event."""

    first = archive.first_batch(records.sparkSession, lake_path, ledger, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        keyed = payload.accepted(dedup.with_key(batch, *_identity(batch)))
        archive.archive_batch(keyed, lake_path, ledger, number, dedup_delay, fold_every)
        quarantine(batch, rejects_path(lake_path), number)

    return _each_batch(_decoded_once(records, dedup_delay), store, checkpoint)


def _identity(decoded: DataFrame) -> tuple[list[str], Column]:
    """What names a record without an id, and where an id counts. What a malformed record says of its
    id must not push out an event; without coordinates its text is its key."""
    coordinates = [name for name in topic.COORDINATES if name in decoded.columns]
    return coordinates or ["payload"], F.col("reject_reason").isNull()


def _decoded_once(records: DataFrame, delay: str | None) -> DataFrame:
    decoded = observe_ingest(topic.decode_records(records))
    if delay is None:
        return decoded
    coordinates, good = _identity(decoded)
    return dedup.dedup_stream(decoded, delay, coordinates, identified=good)


def _each_batch(decoded: DataFrame, store: Callable, checkpoint: str) -> DataStreamWriter:
    def keep(rows: DataFrame, batch_id: int) -> None:
        batch = rows.persist()
        try:
            store(batch, batch_id)
        finally:
            batch.unpersist()

    return decoded.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
