"""Keyed topic records: encoding and decoding are pure, the connector calls are thin.

The connector is a separate jar (``spark-sql-kafka``); ``encode`` and ``decode_records`` work on
any DataFrame of the connector's shape, so they are tested without it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewatch.schemas import LAKE_SCHEMA
from tidewatch.sources.payload import decode

# Fixed value: the key of an event that names no server.
UNKNOWN_KEY = "unknown"
COORDINATES = ["topic", "partition", "offset"]


def encode(events: DataFrame) -> DataFrame:
    """Events -> ``key`` (server name) and ``value`` (JSON), with no shuffle. Topic coordinates,
    where present, stay columns of their own."""
    carried = [name for name in COORDINATES if name in events.columns]
    fields = [name for name in events.columns if name not in carried]
    return events.select(
        F.coalesce("server_name", F.lit(UNKNOWN_KEY)).alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        *carried,
    )


def decode_records(records: DataFrame) -> DataFrame:
    """Topic records -> decoded enriched events; topic coordinates are carried when present."""
    carried = [name for name in COORDINATES if name in records.columns]
    return decode(
        records.select(*carried, F.col("value").cast("string").alias("payload")), LAKE_SCHEMA
    )


def source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    min_offsets: int | None = None,
    max_delay: str | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a topic scan.

    ``min_offsets`` with ``max_delay`` makes a trigger wait for that many records or that long,
    whichever comes first. Offsets are kept in the query's checkpoint, so every query has its
    own position and no consumer group is needed.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "minOffsetsPerTrigger": min_offsets,
        "maxTriggerDelay": max_delay,
        "maxOffsetsPerTrigger": max_offsets,
    }
    return {key: str(value) for key, value in options.items() if value is not None}


def sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options of a topic sink: wait for all replicas, compress batches."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.compression.type": "gzip",
    }


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("kafka").options(**options).load()


def write_batch(events: DataFrame, options: dict[str, str]) -> None:
    encode(events).write.format("kafka").options(**options).save()


def write_stream(events: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    return (
        encode(events)
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
