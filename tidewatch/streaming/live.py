"""Streams that feed the live tables."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import DateType

from tidewatch.functions import clock
from tidewatch.operators import heavy_hitters, live_page
from tidewatch.operators.live import traffic_volume, with_average
from tidewatch.operators.retention import RETENTION_HOURS, keep_recent
from tidewatch.schemas import MINUTE_PARTIALS_SCHEMA, RECENT_CHANGES_SCHEMA, TRAFFIC_SCHEMA
from tidewatch.sources.tables import read_table
from tidewatch.streaming import folding
from tidewatch.streaming.folding import BATCH, DAY

# Window and allowed lateness of live traffic.
WINDOW = "10 seconds"
WATERMARK = "10 seconds"


# --- recent changes: append only ----------------------------------------------------------


def recent_changes_writer(changes: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append change rows by day; the file sink's commit log makes each batch count once."""
    return (
        changes.withColumn(DAY, F.to_date("event_time"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(DAY)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def read_appended_changes(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RECENT_CHANGES_SCHEMA, {DAY: DateType()})


# --- traffic: event-time windows with state -----------------------------------------------


def traffic_stream(
    changes: DataFrame, window: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """Tumbling windows with bounded state; events later than the watermark are dropped."""
    return traffic_volume(changes.withWatermark("event_time", watermark), window)


def traffic_writer(
    traffic: DataFrame,
    path: str,
    checkpoint: str,
    fold_every: int = folding.FOLD_BATCHES,
    fold_again: int = folding.FOLD_AGAIN,
) -> DataStreamWriter:
    """Store the windows each batch changed. Append mode would hold back a window until the
    watermark passes it; here an open window is visible and a later batch supersedes it. Folding keeps
    the newest state of each window."""

    def store(rows: DataFrame, batch_id: int) -> None:
        folding.write_batch(rows, "window_start", path, batch_id)
        folding.fold_when_due(
            rows.sparkSession, path, TRAFFIC_SCHEMA, "window_start", batch_id, fold_every, fold_again,
            newest,
        )

    return (
        traffic.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
    )


def newest(states: DataFrame) -> DataFrame:
    """The latest state of every window among those that batches, or folders of them, hold."""
    latest = F.max_by(F.struct("total_bytes", "event_count"), folding.BATCH)
    return with_average(
        states.groupBy("window_start")
        .agg(latest.alias("_latest"))
        .select("window_start", "_latest.*")
    )


def read_traffic(
    spark: SparkSession, path: str, hours: int = RETENTION_HOURS, as_of: clock.AsOf = None
) -> DataFrame:
    """The latest state of the windows of the last ``hours``; of all windows for 0 or less."""
    states = folding.read_levels(spark, path, TRAFFIC_SCHEMA, _first_day(hours, as_of))
    return newest(_retained(states, "window_start", hours, as_of))


# --- both live tables from one query ------------------------------------------------------


def live_tables_writer(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    window: str = WINDOW,
    fold_every: int = folding.FOLD_BATCHES,
    fold_again: int = folding.FOLD_AGAIN,
    hitters: bool = False,
) -> DataStreamWriter:
    """One query that stores change rows and traffic of each batch under the same batch id.

    Traffic rows are the batch's share of a window; readers add the shares up. That needs no
    state and no watermark: a late event adds a share to its window. A retried batch replaces
    its own partitions, so nothing counts twice, and an error fails the batch instead of losing
    it. Finished batches are folded together from time to time (see ``folding``).
    """

    def store(rows: DataFrame, batch_id: int) -> None:
        store_live_batch(rows, root, batch_id, window, fold_every, fold_again, hitters)

    return changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def store_live_batch(
    changes: DataFrame,
    root: str,
    batch_id: int,
    window: str = WINDOW,
    fold_every: int = folding.FOLD_BATCHES,
    fold_again: int = folding.FOLD_AGAIN,
    hitters: bool = False,
) -> None:
    """Store one batch in both live tables, and its minute partials; with ``hitters`` also sketches of
    its heaviest pages and users."""
    batch = changes.persist()
    try:
        folding.write_batch(batch, "event_time", changes_path(root), batch_id)
        folding.write_batch(
            traffic_volume(batch, window), "window_start", traffic_path(root), batch_id
        )
        folding.write_batch(
            live_page.minute_partials(batch), "minute", partials_path(root), batch_id
        )
        if hitters:
            folding.write_batch(
                heavy_hitters.sketches(batch), "hour", hitters_path(root), batch_id
            )
    finally:
        batch.unpersist()
    due = (batch_id, fold_every, fold_again)
    folding.fold_when_due(
        changes.sparkSession, changes_path(root), RECENT_CHANGES_SCHEMA, "event_time", *due
    )
    folding.fold_when_due(
        changes.sparkSession, traffic_path(root), TRAFFIC_SCHEMA, "window_start", *due, summed
    )
    folding.fold_when_due(
        changes.sparkSession, partials_path(root), MINUTE_PARTIALS_SCHEMA, "minute", *due,
        live_page.merged,
    )
    if hitters:
        folding.fold_when_due(
            changes.sparkSession, hitters_path(root), heavy_hitters.SKETCHES, "hour", *due,
            heavy_hitters.merged,
        )


def changes_path(root: str) -> str:
    return f"{root.rstrip('/')}/recent_changes"


def traffic_path(root: str) -> str:
    return f"{root.rstrip('/')}/traffic_volume"


def window_traffic_path(root: str) -> str:
    return f"{root.rstrip('/')}/window_traffic"


def partials_path(root: str) -> str:
    return f"{root.rstrip('/')}/minute_partials"


def hitters_path(root: str) -> str:
    return f"{root.rstrip('/')}/heavy_hitters"


def read_hitters(
    spark: SparkSession, root: str, hours: int = RETENTION_HOURS, as_of: clock.AsOf = None
) -> DataFrame:
    """Sketches of the whole hours of a look-back, or of all hours for 0 or less."""
    rows = folding.read_levels(
        spark, hitters_path(root), heavy_hitters.SKETCHES, _first_day(hours, as_of)
    ).drop(BATCH)
    if hours > 0:
        first = clock.hour_of(clock.hours_before(as_of, hours))
        rows = rows.where((F.col(DAY) >= F.to_date(first)) & (F.col("hour") >= first))
    return rows.drop(DAY)


def read_live_changes(
    spark: SparkSession, root: str, hours: int = RETENTION_HOURS, as_of: clock.AsOf = None
) -> DataFrame:
    rows = folding.read_levels(
        spark, changes_path(root), RECENT_CHANGES_SCHEMA, _first_day(hours, as_of)
    )
    return _retained(rows, "event_time", hours, as_of).drop(DAY, BATCH)


def read_live_traffic(
    spark: SparkSession, root: str, hours: int = RETENTION_HOURS, as_of: clock.AsOf = None
) -> DataFrame:
    shares = folding.read_levels(
        spark, traffic_path(root), TRAFFIC_SCHEMA, _first_day(hours, as_of)
    )
    return summed(_retained(shares, "window_start", hours, as_of))


def read_partials(
    spark: SparkSession, root: str, hours: int = RETENTION_HOURS, as_of: clock.AsOf = None
) -> DataFrame:
    """Minute partials as batches, or folders of them, hold them: they merge by addition."""
    rows = folding.read_levels(
        spark, partials_path(root), MINUTE_PARTIALS_SCHEMA, _first_day(hours, as_of)
    )
    return _retained(rows, "minute", hours, as_of).drop(DAY, BATCH)


def summed(shares: DataFrame) -> DataFrame:
    """Windows from the shares that batches, or folders of them, hold."""
    return with_average(
        shares.groupBy("window_start").agg(
            F.sum("total_bytes").alias("total_bytes"), F.sum("event_count").alias("event_count")
        )
    )


def _first_day(hours: int, as_of: clock.AsOf) -> date | None:
    """A day before which no row is in the last ``hours``, where that is known without a job; the
    day before the cutoff's, whatever zone ``as_of`` was meant in."""
    if hours <= 0 or isinstance(as_of, Column):
        return None
    now = (as_of or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return (now - timedelta(hours=hours + 24)).date()


def _retained(rows: DataFrame, time: str, hours: int, as_of: clock.AsOf) -> DataFrame:
    """Rows inside the retention; the day bound prunes folders, 0 hours or less keeps all."""
    if hours <= 0:
        return rows
    first_day = F.to_date(clock.hours_before(as_of, hours))
    return keep_recent(rows.filter(F.col(DAY) >= first_day), time, hours, as_of)
