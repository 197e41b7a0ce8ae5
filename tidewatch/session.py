"""Session settings the jobs are written for, and the shared working folder."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # As most JSON readers do, take the last of repeated keys instead of refusing the object.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Dedup and window state may outgrow the heap; RocksDB keeps it on executor disk and
    # uploads only changes to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. Anywhere else the setting is
    required: a driver-local folder would not be seen by the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{_session_root(spark, root)}/{purpose}-{uuid.uuid4().hex}"


def _session_root(spark: SparkSession, root: str) -> str:
    return f"{root.rstrip('/')}/tidewatch/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete all work folders of this session; call it when their results have been read."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        remove(spark, _session_root(spark, root))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete one folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries begun within leave no shuffle files: these go as each query ends, not when the driver
    next collects garbage. For queries that are run once, as a plan run again makes them anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="tidewatch-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root
