"""Keeping the number of folders of a live table small while a stream writes it.

A stream writes one ``event_date/batch_id`` folder per micro-batch, which makes a retried batch
replace itself. ``fold`` gathers the finished batches of a level in one folder of the next level,
whose ``batch_id`` is the last one it holds; level 0 is the stream's own. A mark, written last, says
up to which batch a level has been folded: readers take what is behind the mark from the next level,
so an interrupted or repeated fold counts nothing twice. Folders behind a mark stay until the next
fold, for readers that were planned before it. How the rows of several batches become one row, added
up or the newest instead of the older ones, is up to the table's ``combine``.
"""

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, LongType, StructType

from tidewatch.schemas import extended
from tidewatch.sources import files
from tidewatch.sources.tables import read_table

DAY = "event_date"
BATCH = "batch_id"
PARTITIONS = {DAY: DateType(), BATCH: LongType()}
LEVELS = 3
# Batches in a folder of level 1 (five minutes of 5 s batches), and folders of that in one of
# level 2 (two hours).
FOLD_BATCHES = 60
FOLD_AGAIN = 24

Combine = Callable[[DataFrame], DataFrame]
# Columns that divide the batches of a table further.
Further = dict[str, DataType]


def level_path(path: str, level: int) -> str:
    return path.rstrip("/") if level == 0 else f"{path.rstrip('/')}_level{level}"


def _marks(path: str, level: int) -> str:
    return f"{level_path(path, level)}_marks"


def folded_up_to(spark: SparkSession, path: str, level: int) -> int:
    """The last batch of ``level`` that is held by the next level; -1 for none."""
    folder, found = _marks(path, level), -1
    for name in files.names(spark, folder):
        if "_SUCCESS" in files.names(spark, f"{folder}/{name}"):
            found = max(found, int(name.partition("=")[2]))
    return found


def write_batch(
    rows: DataFrame, time: str, path: str, batch_id: int, further: Further | None = None
) -> None:
    """Replace the batch's own partitions. The rebalance makes few files of a batch that many
    tasks read; they are in time order, so their statistics prune."""
    below = list(further or {})
    (
        rows.withColumns({DAY: F.to_date(time), BATCH: F.lit(batch_id).cast("bigint")})
        .hint("rebalance", DAY, *below)
        .sortWithinPartitions(DAY, BATCH, *below, time)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH, *below)
        .parquet(path)
    )


def _read_days(
    spark: SparkSession,
    path: str,
    schema: StructType,
    first_day: date | None,
    further: Further | None = None,
) -> DataFrame:
    """A level's rows, of the days from ``first_day`` on; the folders of older days aren't listed."""
    partitions = {**PARTITIONS, **(further or {})}
    if first_day is None:
        return read_table(spark, path, schema, partitions)
    days = [
        f"{path}/{name}" for name in files.names(spark, path)
        if name.startswith(f"{DAY}=") and name.partition("=")[2] >= first_day.isoformat()
    ]
    shape = extended(schema, partitions)
    if not days:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).option("basePath", path).parquet(*days)


def read_levels(
    spark: SparkSession,
    path: str,
    schema: StructType,
    first_day: date | None = None,
    further: Further | None = None,
) -> DataFrame:
    """All rows of a live table, each from the highest level that holds it, or those of the days from
    ``first_day`` on."""
    parts, behind = [], -1
    for level in reversed(range(LEVELS)):
        up_to = None if level == 0 else folded_up_to(spark, path, level - 1)
        if level and up_to < 0:
            continue
        rows = _read_days(spark, level_path(path, level), schema, first_day, further)
        rows = rows.where(F.col(BATCH) > behind)
        parts.append(rows if up_to is None else rows.where(F.col(BATCH) <= up_to))
        behind = behind if up_to is None else up_to
    return reduce(DataFrame.unionByName, parts)


def fold(
    spark: SparkSession,
    path: str,
    schema: StructType,
    time: str,
    up_to: int,
    level: int = 0,
    combine: Combine | None = None,
    further: Further | None = None,
) -> None:
    """Gather the batches of ``level`` up to ``up_to`` in the next level. ``combine`` may shrink the
    rows, as summing shares does, and sees the batch each is of; nothing happens when that far was
    folded before."""
    before = folded_up_to(spark, path, level)
    if up_to <= before:
        return
    held = _read_days(spark, level_path(path, level), schema, None, further)
    rows = held.where((F.col(BATCH) > before) & (F.col(BATCH) <= up_to))
    if combine is not None:
        rows = combine(rows)
    write_batch(rows.drop(DAY, BATCH), time, level_path(path, level + 1), up_to, further)
    spark.range(1).write.mode("overwrite").parquet(f"{_marks(path, level)}/up_to={up_to}")
    _clean(spark, path, level, before)


def _clean(spark: SparkSession, path: str, level: int, before: int) -> None:
    """Delete what the fold before this one had left for readers, and marks that are passed."""
    source = level_path(path, level)
    for day in files.names(spark, source):
        for name in files.names(spark, f"{source}/{day}") if day.startswith(f"{DAY}=") else []:
            if name.startswith(f"{BATCH}=") and int(name.partition("=")[2]) <= before:
                files.delete(spark, f"{source}/{day}/{name}")
    for name in files.names(spark, _marks(path, level)):
        if int(name.partition("=")[2]) < before:
            files.delete(spark, f"{_marks(path, level)}/{name}")


def fold_when_due(
    spark: SparkSession,
    path: str,
    schema: StructType,
    time: str,
    batch_id: int,
    every: int = FOLD_BATCHES,
    again: int = FOLD_AGAIN,
    combine: Combine | None = None,
    further: Further | None = None,
) -> None:
    """Called after batch ``batch_id`` was written: fold what came before it, whenever ``every``
    batches have come together. The batch itself may be retried and stays out."""
    if batch_id == 0 or batch_id % every:
        return
    fold(spark, path, schema, time, batch_id - 1, 0, combine, further)
    if (batch_id // every) % again == 0:
        fold(spark, path, schema, time, batch_id - 1, 1, combine, further)
