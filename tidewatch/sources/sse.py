"""Captured server-sent-event text: one line per row in ``value``, batch or streaming."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.schemas import RAW_SCHEMA
from tidewatch.sources.payload import decode

# Fixed value: the prefix of a line that carries an event.
DATA_PREFIX = "data: "


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def payloads(lines: DataFrame) -> DataFrame:
    """Keep the data lines and strip their prefix; comments, ids and blank lines go."""
    value = F.col("value")
    return lines.filter(value.startswith(DATA_PREFIX)).select(
        F.substr(value, F.lit(len(DATA_PREFIX) + 1)).alias("payload")
    )


def parse(lines: DataFrame, reject_null_length: bool = False) -> DataFrame:
    """Lines -> decoded raw events, rejects included (see ``payload.accepted`` / ``rejects``)."""
    return decode(payloads(lines), RAW_SCHEMA, reject_null_length)
