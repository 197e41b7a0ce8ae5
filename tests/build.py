"""Small hand-made inputs."""

from pyspark.sql import DataFrame, SparkSession

from tidewatch.schemas import LAKE_SCHEMA, RAW_SCHEMA, RECENT_CHANGES_SCHEMA, StructType

HOUR = 3600
# 2024-01-15 15:20:00 UTC
NOON = 1_705_332_000


def _frame(spark: SparkSession, schema: StructType, events: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [tuple(event.get(name) for name in schema.fieldNames()) for event in events], schema
    )


def raw(spark: SparkSession, *events: dict) -> DataFrame:
    return _frame(spark, RAW_SCHEMA, list(events))


def stored(spark: SparkSession, *events: dict) -> DataFrame:
    """Rows of the lake's shape, an hour-aligned edit unless said otherwise."""
    defaults = {"type": "edit", "timestamp": NOON, "bytes_changed": 0, "is_new_page": False}
    return _frame(spark, LAKE_SCHEMA, [{**defaults, **event} for event in events])


def changes(spark: SparkSession, *events: dict) -> DataFrame:
    """Change rows with ``at`` in seconds after ``NOON``."""
    df = _frame(spark, RECENT_CHANGES_SCHEMA, list(events))
    at = spark.createDataFrame(
        [(i, NOON + event.get("at", 0)) for i, event in enumerate(events)], "i INT, at BIGINT"
    )
    columns = ", ".join(f"`{name}`" for name in RECENT_CHANGES_SCHEMA.fieldNames()[1:])
    numbered = spark.createDataFrame(
        [(i, *tuple(row)[1:]) for i, row in enumerate(df.collect())],
        StructType([at.schema["i"], *RECENT_CHANGES_SCHEMA.fields[1:]]),
    )
    return numbered.join(at, "i").selectExpr(
        "timestamp_seconds(at) AS event_time", *columns.split(", ")
    )
