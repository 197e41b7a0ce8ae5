"""Parameterised SQL over the live and historical tables."""

from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Names the live tables are queried under.
RECENT_CHANGES = "realtime_recent_changes"
TRAFFIC_VOLUME = "realtime_traffic_volume"


def register(tables: dict[str, DataFrame]) -> None:
    """Make DataFrames queryable by name in their session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, args: dict[str, Any] | list | None = None) -> DataFrame:
    """Run SQL with bound values (``:name`` or ``?``). Errors are raised, not turned into an
    empty result."""
    return spark.sql(text, args=args)
