"""Traffic per fixed number of topic records, as a stream.

A batch's records are numbered in spans of offsets (``operators.live``), so no task handles more than
a span at once, and only sums per window go further. What a window still lacks, a time, a sum and a
count per topic partition, is stored with the batch and taken up by the next.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType

from tidewatch.operators import live
from tidewatch.schemas import INT, LONG, TIME, TRAFFIC_SCHEMA, struct
from tidewatch.sources import files
from tidewatch.sources.tables import materialised, read_table
from tidewatch.streaming.folding import BATCH

OPEN = struct({"partition": INT, "window_start": TIME, "total_bytes": LONG, "event_count": LONG})


def count_windows_writer(
    records: DataFrame, path: str, checkpoint: str, size: int = live.COUNT_WINDOW
) -> DataStreamWriter:
    """Store the windows that each batch fills. A topic delivers a partition in the order of its
    offsets, across batches too. A retried batch replaces its own windows and what it left open."""

    def store(batch: DataFrame, batch_id: int) -> None:
        store_windows(batch, path, batch_id, size)

    return records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def open_path(path: str) -> str:
    return f"{path.rstrip('/')}_open"


def store_windows(batch: DataFrame, path: str, batch_id: int, size: int) -> None:
    spark = batch.sparkSession
    held = _left_open(spark, path, batch_id)
    records = batch.select("partition", "offset", "event_time", "bytes_changed").persist()
    try:
        waiting = held.select(F.col("partition").alias("_of"), F.col("event_count").alias("_waiting"))
        numbered = (
            live.numbered_records(records)
            .join(waiting, F.col("partition").eqNullSafe(F.col("_of")), "left")
            .withColumn("number", F.col("number") + F.coalesce("_waiting", F.lit(0)))
        )
        windows = live.count_windows(numbered, size).unionByName(held.withColumn("window", F.lit(0)))
        windows = windows.groupBy("partition", "window").agg(
            F.max("window_start").alias("window_start"),
            F.sum("total_bytes").alias("total_bytes"),
            F.sum("event_count").alias("event_count"),
        )
        with materialised(windows, "count-windows") as windows:
            full = F.col("event_count") == size
            live.with_average(windows.where(full)).write.mode("overwrite").parquet(
                f"{path.rstrip('/')}/{BATCH}={batch_id}"
            )
            windows.where(~full).select(*OPEN.fieldNames()).write.mode("overwrite").parquet(
                f"{open_path(path)}/{BATCH}={batch_id}"
            )
    finally:
        records.unpersist()
    for number, name in _batches(spark, path):
        if number < batch_id - 1:
            files.delete(spark, f"{open_path(path)}/{name}")


def _batches(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    names = [name for name in files.names(spark, open_path(path)) if name.startswith(f"{BATCH}=")]
    return [(int(name.partition("=")[2]), name) for name in names]


def _left_open(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The windows that the batch before left open: at most one per topic partition."""
    before = [
        (number, name) for number, name in _batches(spark, path)
        if number < batch_id and files.finished(spark, f"{open_path(path)}/{name}")
    ]
    if not before:
        return spark.createDataFrame([], OPEN)
    return read_table(spark, f"{open_path(path)}/{max(before)[1]}", OPEN)


def read_count_windows(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, TRAFFIC_SCHEMA, {BATCH: LongType()}).drop(BATCH)
