"""The Parquet lake: ``year=YYYY/month=MM`` folders below its roots.

Batch jobs append to ``<lake>/raw_events``, streams to ``<lake>/raw_events_streamed``: a folder that a
stream writes has a commit log, and readers of it see the stream's files only, so the two must
not share one. Written ``by_day``, events go to roots of their own, where the months are divided by
the day of the event: a look-back prunes folders there although the months are those of the archive
time. An archive that asks a ledger writes ``<lake>/raw_events_once_daily``, a folder per batch, which a
retried batch replaces. Every scan reads all roots.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import DataType, DateType, LongType

from tidewatch.functions import clock
from tidewatch.schemas import INT, LAKE_SCHEMA, TEXT, extended
from tidewatch.sources import files
from tidewatch.sources.tables import read_table

RAW_EVENTS = "raw_events"
STREAMED_EVENTS = "raw_events_streamed"
BATCHED_EVENTS = "raw_events_once"
DAILY = "_daily"
PARTITIONS = ["year", "month"]
DAY = "event_date"
COMPRESSION = "snappy"
BATCH = "batch_id"
FILE = "file"


def _root(lake: str, name: str, by_day: bool) -> str:
    if lake.startswith("s3://"):
        lake = "s3a://" + lake.removeprefix("s3://")
    return f"{lake.rstrip('/')}/{name}{DAILY if by_day else ''}"


def events_path(lake: str, by_day: bool = False) -> str:
    """Folder of the event table. ``s3://`` is spelled ``s3a://`` for the Hadoop file system."""
    return _root(lake, RAW_EVENTS, by_day)


def streamed_path(lake: str, by_day: bool = False) -> str:
    return _root(lake, STREAMED_EVENTS, by_day)


def batched_path(lake: str) -> str:
    return _root(lake, BATCHED_EVENTS, True)


def _levels(by_day: bool) -> list[str]:
    return [*PARTITIONS, DAY] if by_day else PARTITIONS


def with_partitions(
    events: DataFrame,
    by: str = "ingest_time",
    ingest_time: clock.AsOf = None,
    by_day: bool = False,
) -> DataFrame:
    """Add ``year`` and zero-padded ``month``, of the ingest time or of the event's own time, and
    ``by_day`` the day of the event."""
    if by == "event_time":
        placed = F.timestamp_seconds("timestamp")
    elif by == "ingest_time":
        placed = clock.moment(ingest_time)
    else:
        raise ValueError(f"unknown partition time: {by}")
    columns = {
        "year": F.lpad(F.year(placed).cast("string"), 4, "0"),
        "month": F.lpad(F.month(placed).cast("string"), 2, "0"),
    }
    if by_day:
        columns[DAY] = F.to_date(F.timestamp_seconds("timestamp"))
    return events.withColumns(columns)


def _clustered(events: DataFrame, by_day: bool = False) -> DataFrame:
    """Gather each month, or day, in few files, in time order so that row-group statistics prune.

    ``rebalance`` lets adaptive execution split a month that holds most rows and merge small
    ones, where a plain repartition by month would send a hot month to a single task.
    """
    # Sorting by the partition columns too is the order the partitioned write wants, so the
    # time order survives it.
    levels = _levels(by_day)
    return events.hint("rebalance", *levels).sortWithinPartitions(*levels, "timestamp")


def write_lake(
    events: DataFrame,
    lake: str,
    by: str = "ingest_time",
    ingest_time: clock.AsOf = None,
    mode: str = "append",
    by_day: bool = False,
) -> None:
    """Append normalised events. An archive batch lands in one month and needs no shuffle; rows
    placed by event time, or by day, are gathered per folder first."""
    placed = with_partitions(events, by, ingest_time, by_day)
    if by == "event_time" or by_day:
        placed = _clustered(placed, by_day)
    (
        placed.write.mode(mode)
        .partitionBy(*_levels(by_day))
        .option("compression", COMPRESSION)
        .parquet(events_path(lake, by_day))
    )


def write_batch(events: DataFrame, lake: str, batch_id: int) -> None:
    """Store a stream's batch of normalised events, by day, in place of an earlier attempt's."""
    (
        _clustered(with_partitions(events, by_day=True), True)
        .write.mode("overwrite")
        .partitionBy(*_levels(True))
        .option("compression", COMPRESSION)
        .parquet(f"{batched_path(lake)}/{BATCH}={batch_id}")
    )


def lake_writer(
    events: DataFrame,
    lake: str,
    checkpoint: str,
    by: str = "ingest_time",
    ingest_time: clock.AsOf = None,
    by_day: bool = False,
) -> DataStreamWriter:
    """The streaming form of ``write_lake``; the file sink commits each batch exactly once."""
    return (
        with_partitions(events, by, ingest_time, by_day)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*_levels(by_day))
        .option("compression", COMPRESSION)
        .option("path", streamed_path(lake, by_day))
        .option("checkpointLocation", checkpoint)
    )


def _month_number(year: Column, month: Column) -> Column:
    return year * 100 + month


def scan_lake(
    spark: SparkSession,
    lake: str,
    days_back: int = 7,
    as_of: clock.AsOf = None,
    merge_schema: bool = False,
    by: str = "ingest_time",
) -> DataFrame:
    """Events of the last ``days_back`` days with ``timestamp`` as a timestamp; 0 or less reads
    all. See ``scan_since``."""
    if days_back <= 0:
        return scan_since(spark, lake, None, merge_schema, by)
    cutoff = clock.days_before(as_of, days_back)
    # The first whole second that is not before the cutoff.
    second = F.unix_seconds(cutoff + F.expr("INTERVAL '0.999999' SECOND"))
    return scan_since(spark, lake, second, merge_schema, by)


def scan_since(
    spark: SparkSession,
    lake: str,
    second: Column | None,
    merge_schema: bool = False,
    by: str = "ingest_time",
) -> DataFrame:
    """Events from epoch ``second`` on, or all, with ``timestamp`` as a timestamp. A lake that was
    never written gives an empty result.

    The bound is compared with the stored bigint, before the cast, so it reaches the Parquet
    scan and its row-group statistics. Roots divided by day are bounded by folder. Where all of the
    lake is placed ``by`` event time the bound holds for the months too; by ingest time it does not,
    since an event may be stamped later than it was archived. ``merge_schema`` takes the union of the
    files' own columns instead of the declared schema.
    """
    events = _stored(spark, lake, INT, second, merge_schema=merge_schema)
    if second is not None:
        if by == "event_time":
            oldest = F.timestamp_seconds(second)
            first_month = _month_number(F.year(oldest), F.month(oldest))
            events = events.filter(_month_number(F.col("year"), F.col("month")) >= first_month)
        events = events.filter(F.col("timestamp") >= second)
    return events.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def scan_files(
    spark: SparkSession, lake: str, first: int | None = None, end: int | None = None
) -> DataFrame:
    """Events with the file they are in, as ``file``: all, or those of the epoch seconds from
    ``first`` up to ``end``."""
    events = _stored(spark, lake, INT, first, end, with_file=True)
    if first is not None:
        events = events.filter(F.col("timestamp") >= first)
    if end is not None:
        events = events.filter(F.col("timestamp") < end)
    return events.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def list_files(spark: SparkSession, lake: str) -> DataFrame:
    """``file, path, size`` of the files of the lake, without opening them. ``file`` is the name a
    scan gives, ``path`` what ``read_files`` takes."""
    none = spark.createDataFrame([], "file string, path string, size long")
    listed = [
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"))
        for root, _ in _roots(lake)
        if files.names(spark, root)
    ]
    return reduce(DataFrame.unionByName, listed, none)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The events of these files and of no other, with ``file``."""
    if paths:
        events = spark.read.schema(LAKE_SCHEMA).option("recursiveFileLookup", "true").parquet(*paths)
        events = events.withColumn(FILE, F.col("_metadata.file_path"))
    else:
        events = spark.createDataFrame([], extended(LAKE_SCHEMA, {FILE: TEXT}))
    return events.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def _roots(lake: str) -> list[tuple[str, dict[str, DataType]]]:
    """All folders with events, and what divides them besides year and month."""
    day = {DAY: DateType()}
    return [
        (events_path(lake), {}),
        (streamed_path(lake), {}),
        (events_path(lake, by_day=True), day),
        (streamed_path(lake, by_day=True), day),
        (batched_path(lake), {BATCH: LongType(), **day}),
    ]


def _stored(
    spark: SparkSession,
    lake: str,
    kind: DataType,
    first: Column | int | None = None,
    end: int | None = None,
    with_file: bool = False,
    merge_schema: bool = False,
) -> DataFrame:
    """Everything below all roots, of those divided by day the days from the epoch second ``first``
    up to ``end``; a root that was never written is left out."""

    def root(path: str, levels: dict[str, DataType]) -> DataFrame:
        places = {"year": kind, "month": kind, **levels}
        if merge_schema:
            events = spark.read.option("mergeSchema", "true").parquet(path)
        else:
            events = read_table(spark, path, LAKE_SCHEMA, places)
        if with_file:
            # Where nothing was written there is no file either.
            events = events.withColumn(
                FILE, F.col("_metadata.file_path") if files.names(spark, path) else F.lit("")
            )
        if DAY in levels and first is not None:
            events = events.filter(F.col(DAY) >= _day(first))
        if DAY in levels and end is not None:
            events = events.filter(F.col(DAY) <= _day(end))
        return events.drop(*levels)

    found = [place for place in _roots(lake) if files.names(spark, place[0])]
    if not found:
        merge_schema, found = False, [(events_path(lake), {})]
    return reduce(
        lambda some, more: some.unionByName(more, allowMissingColumns=merge_schema),
        [root(*place) for place in found],
    )


def _day(second: Column | int) -> Column:
    return F.to_date(F.timestamp_seconds(second if isinstance(second, Column) else F.lit(second)))


def compact_lake(
    spark: SparkSession,
    lake: str,
    target: str,
    year: int | None = None,
    month: int | None = None,
    by_day: bool = False,
) -> None:
    """Rewrite many small archive files into few, into another lake folder: all of the lake, or
    one year or month of it, replacing what the target holds of the folders it writes. ``by_day``
    divides a lake by day that was not."""
    stored = _stored(spark, lake, TEXT)
    for name, value, width in (("year", year, 4), ("month", month, 2)):
        if value is not None:
            stored = stored.where(F.col(name) == f"{value:0{width}d}")
    if by_day:
        stored = stored.withColumn(DAY, F.to_date(F.timestamp_seconds("timestamp")))
    (
        _clustered(stored, by_day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_levels(by_day))
        .option("compression", COMPRESSION)
        .parquet(events_path(target, by_day))
    )
