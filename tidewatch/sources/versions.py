"""Tables that are replaced as a whole while somebody reads them.

Every write makes a new ``version=N`` folder; a reader takes the newest one that was finished. The
version before it stays for readers that were planned earlier, older ones are deleted. One job
writes a table at a time.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewatch.sources import files
from tidewatch.sources.tables import read_table

PREFIX = "version="
KEPT = 2


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(
        int(name.removeprefix(PREFIX)) for name in files.names(spark, path) if name.startswith(PREFIX)
    )


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{PREFIX}{version}"


def newest(spark: SparkSession, path: str) -> int | None:
    """The last finished version, None if there is none."""
    for version in reversed(_versions(spark, path)):
        if files.finished(spark, _folder(path, version)):
            return version
    return None


def replace(df: DataFrame, path: str) -> None:
    """Write ``df`` as the next version. What an interrupted write has left is overwritten."""
    spark = df.sparkSession
    version = (newest(spark, path) or 0) + 1
    df.write.mode("overwrite").parquet(_folder(path, version))
    for old in _versions(spark, path):
        if old <= version - KEPT:
            files.delete(spark, _folder(path, old))


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest version; a table that was never written is empty, and one that was written without
    versions is read as it is."""
    version = newest(spark, path)
    return read_table(spark, path if version is None else _folder(path, version), schema)
