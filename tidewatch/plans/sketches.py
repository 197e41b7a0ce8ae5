"""Distinct users of any look-back from stored sketches.

Exact distinct counts need a row per server and user. A table of sketches, one per hour and server,
answers for any range of whole hours from a few thousand rows, since sketches merge. Estimates are off
by about half a percent; up to some two thousand users they are exact but for colliding hashes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType

from tidewatch.functions import clock
from tidewatch.operators import rollup
from tidewatch.operators.historical import TOP_SERVERS
from tidewatch.operators.ordering import rank_top
from tidewatch.plans import incremental
from tidewatch.plans.incremental import PARTITION
from tidewatch.schemas import LONG, TEXT, TIME, struct
from tidewatch.sources import files
from tidewatch.sources.lake import read_files
from tidewatch.sources.tables import materialised, read_table

# Two to this power are the counters of a sketch, 16 kB at most.
PRECISION = 14
SKETCHES = struct(
    {
        "hour_bucket": TIME, **{key: TEXT for key in rollup.SERVERS},
        "events": LONG, "bytes": LONG, "users": BinaryType(),
    }
)


def hourly_sketches(events: DataFrame) -> DataFrame:
    """Events, bytes and a sketch of the users, per hour and server; unknown users do not count."""
    hour = clock.hour_of(clock.timestamp_of(events, "timestamp")).alias("hour_bucket")
    return events.groupBy(hour, *rollup.SERVERS).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("bytes_changed").alias("bytes"),
        F.hll_sketch_agg("user", PRECISION).alias("users"),
    )


def server_rankings(sketches: DataFrame, top_n: int = TOP_SERVERS) -> DataFrame:
    """``historical.server_rankings`` with estimated users, from sketches of any hours."""
    servers = sketches.groupBy(*rollup.SERVERS).agg(
        F.sum("events").alias("edit_count"),
        F.sum("bytes").alias("total_bytes"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("unique_users"),
    )
    return rank_top(servers, "edit_count", rollup.SERVERS, top_n)


def update_sketches(
    spark: SparkSession, lake: str, state: str, table: str, most_files: int = incremental.MOST_FILES
) -> None:
    """Bring a table of hourly sketches, by day, up to date with the files of the lake.

    Days that have got or lost files since the table's own mark are computed again, from the files
    that the ledger of ``state`` names for them and no others, some days at a time; a repeated run
    changes nothing.
    """
    incremental.update(spark, lake, state, most_files)
    mark, last = f"{table.rstrip('/')}_mark", incremental.last_wave(spark, state)
    done = incremental.marked(spark, mark)
    if done == last:
        return
    ledger = incremental.read_ledger(spark, state)
    touched = incremental.touched_days(spark, state, done)
    with materialised(touched, "touched-days") as days:
        same = ledger[PARTITION].eqNullSafe(days[PARTITION])
        holding = days.join(ledger, same, "left").groupBy(days[PARTITION].alias(PARTITION))
        counted = holding.agg(F.count("path").alias("files")).orderBy(PARTITION).collect()
    chunk, held = [], 0
    for row in counted:
        if chunk and held + row["files"] > most_files:
            _sketch_days(spark, ledger, chunk, table)
            chunk, held = [], 0
        chunk.append(row[PARTITION])
        held += row["files"]
    if chunk:
        _sketch_days(spark, ledger, chunk, table)
    incremental.set_mark(spark, mark, last)


def _sketch_days(spark: SparkSession, ledger: DataFrame, days: list, table: str) -> None:
    wanted = spark.createDataFrame([(day,) for day in days], struct({"_day": DateType()}))
    same = F.col(PARTITION).eqNullSafe(F.col("_day"))
    paths = ledger.join(wanted, same, "left_semi").select("path").distinct().collect()
    events = read_files(spark, [row.path for row in paths])
    events = events.withColumn(PARTITION, F.to_date("timestamp")).join(wanted, same, "left_semi")
    rows = hourly_sketches(events).withColumn(PARTITION, F.to_date("hour_bucket"))
    with materialised(rows, "sketches") as rows:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            PARTITION
        ).parquet(table)
        left = {row[0] for row in rows.select(PARTITION).distinct().collect()}
    for day in set(days) - left:
        files.delete(spark, f"{table.rstrip('/')}/{incremental.day_folder(day)}")


def read_sketches(
    spark: SparkSession, table: str, hours_back: int = 0, as_of: clock.AsOf = None
) -> DataFrame:
    """Sketches of the whole hours of a look-back, or of all hours for 0 or less."""
    rows = read_table(spark, table, SKETCHES, {PARTITION: DateType()})
    if hours_back > 0:
        first = clock.hour_of(clock.hours_before(as_of, hours_back))
        rows = rows.where((F.col(PARTITION) >= F.to_date(first)) & (F.col("hour_bucket") >= first))
    return rows.drop(PARTITION)
