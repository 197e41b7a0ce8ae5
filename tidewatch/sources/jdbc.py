"""Relational tables through Spark's JDBC source. Credentials are the caller's to pass."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def connection(url: str, driver: str, user: str | None = None, password: str | None = None) -> dict:
    options = {"url": url, "driver": driver, "user": user, "password": password}
    return {key: value for key, value in options.items() if value is not None}


def write_options(
    connect: dict, table: str, truncate: bool = False, batch_size: int = 1000, connections: int = 8
) -> dict[str, str]:
    """Options of a write. ``truncate`` keeps the table's definition on overwrite; without it the
    table is dropped and created. ``connections`` bounds how many tasks write at once."""
    return {
        **connect,
        "dbtable": table,
        "truncate": str(truncate).lower(),
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }


def overwrite(df: DataFrame, options: dict[str, str]) -> int:
    """Replace the table's rows; returns the row count, observed during the write itself."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.format("jdbc").options(
        **options
    ).mode("overwrite").save()
    return written.get["rows"]


def append(df: DataFrame, options: dict[str, str]) -> None:
    """Add rows. An error fails the batch, so a streaming caller retries it."""
    df.write.format("jdbc").options(**options).mode("append").save()


def read(spark: SparkSession, connect: dict, table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**connect, dbtable=table).load()
