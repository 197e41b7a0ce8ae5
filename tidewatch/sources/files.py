"""Folders of the cluster's file system, through Hadoop's API in the session's JVM."""

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly inside ``folder``; none when it does not exist."""
    path, files = _located(spark, folder)
    if not files.exists(path):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(path))


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` was committed."""
    path, files = _located(spark, f"{folder}/_SUCCESS")
    return files.exists(path)


def delete(spark: SparkSession, path: str) -> None:
    located, files = _located(spark, path)
    files.delete(located, True)
