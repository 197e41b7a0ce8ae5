"""Parquet tables read with a declared schema."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType

from tidewatch.schemas import extended
from tidewatch.session import work_dir
from tidewatch.sources import files


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partitions: dict[str, DataType] | None = None,
) -> DataFrame:
    """The table at ``path``, or an empty one of the same shape when nothing was written yet.

    ``partitions`` are the partition columns; naming them keeps Spark from guessing their types
    from folder names.
    """
    schema = extended(schema, partitions or {})
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@contextmanager
def materialised(
    df: DataFrame, purpose: str, partition_by: list[str] | None = None
) -> Iterator[DataFrame]:
    """An intermediate result, written to the shared work folder and deleted afterwards.

    Several outputs can be derived from it without computing it again, and a lost executor costs
    a re-read instead of a re-computation.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    try:
        df.write.partitionBy(*(partition_by or [])).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.delete(spark, path)
