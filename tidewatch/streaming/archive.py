"""The archive without redeliveries, however late they come.

The state of a stream recognises a copy within minutes. Behind it, a ledger holds the keys of archived
events by day of the event and slice of the key's hash, as folders of one batch each that are folded
like those of a live table. A copy that comes after the state has forgotten its event is older than that
state reaches, so a batch asks the ledger for its older events only, and only the days and slices these
fall in; while nothing is redelivered and no topic partition lags, nothing is read. The ledger is
bounded by its retention: days that expire are deleted, and later copies of their events pass.

A batch writes its folder of the lake and then its keys, each in place of what an earlier attempt has
left, and never asks its own keys: a retried batch stores the same events again. Batches are numbered
on from those of earlier checkpoints, so a stream that starts anew replaces nothing.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import clock
from tidewatch.operators import ingest
from tidewatch.operators.dedup import KEY
from tidewatch.schemas import INT, TEXT, TIME, struct
from tidewatch.sources import files, lake
from tidewatch.streaming import folding
from tidewatch.streaming.folding import BATCH, DAY

SLICE = "slice"
# Fixed value of a stored ledger.
SLICES = 4
AT = "occurred_at"
LEDGER = struct({KEY: TEXT, AT: TIME})
BY_SLICE = {SLICE: INT}
# How far a clock that stamps events may be ahead of this one.
CLOCK_AHEAD = "1 minute"
# Fixed value: the last second of the year 9999, beyond which days have no name that sorts.
LAST_SECOND = 253_402_300_799
FIRST_BATCH = "first_batch"


def _placed(keyed: DataFrame) -> DataFrame:
    """Keyed events with their place in the ledger; those without a usable time share the day of
    second 0."""
    seconds = F.col("timestamp")
    second = F.when(seconds.between(0, LAST_SECOND), seconds).otherwise(F.lit(0))
    return keyed.withColumns(
        {
            AT: F.timestamp_seconds(second),
            SLICE: F.pmod(F.xxhash64(KEY), F.lit(SLICES)).cast("int"),
        }
    )


def _remembered(within: str, now: clock.AsOf = None) -> Column:
    """Whether any earlier copy of an event has come within the last ``within``."""
    moment = clock.moment(now)
    oldest = moment - F.expr(f"INTERVAL {within}") + F.expr(f"INTERVAL {CLOCK_AHEAD}")
    return (F.col(AT) > oldest) & (F.col(AT) <= moment)


def first_batch(spark: SparkSession, lake_path: str, ledger: str, checkpoint: str) -> int:
    """The number in lake and ledger of a checkpoint's batch 0, kept with the checkpoint."""
    folder = f"{checkpoint.rstrip('/')}/{FIRST_BATCH}"
    kept = [name for name in files.names(spark, folder) if files.finished(spark, f"{folder}/{name}")]
    if kept:
        return _number(kept[0])
    batches = [*files.names(spark, lake.batched_path(lake_path)), *_level_0(spark, ledger)]
    used = [_number(name) for name in batches if name.startswith(f"{BATCH}=")]
    first = 1 + max([folding.folded_up_to(spark, ledger, 0), *used])
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/from={first}")
    return first


def _number(name: str) -> int:
    return int(name.partition("=")[2])


def _level_0(spark: SparkSession, ledger: str) -> list[str]:
    days = [name for name in files.names(spark, ledger) if name.startswith(f"{DAY}=")]
    return [name for day in days for name in files.names(spark, f"{ledger}/{day}")]


def read_ledger(spark: SparkSession, path: str, first_day: date | None = None) -> DataFrame:
    return folding.read_levels(spark, path, LEDGER, first_day, BY_SLICE)


def not_archived(
    keyed: DataFrame, ledger: str, batch_id: int, within: str | None, now: clock.AsOf = None
) -> DataFrame:
    """Events of a batch, one per ``event_key``, that no other batch has archived. Copies that came
    ``within`` an interval are known to be gone already; None asks the ledger for every event."""
    spark = keyed.sparkSession
    events = _placed(keyed).dropDuplicates([KEY])
    asked = events if within is None else events.where(~_remembered(within, now))
    # One row, no larger than the days a batch holds.
    places = asked.agg(F.collect_set(F.to_date(AT)).alias("days"), F.collect_set(SLICE).alias("slices"))
    days, slices = places.first()
    if not days:
        return events
    known = read_ledger(spark, ledger, min(days)).where(
        F.col(DAY).isin(days) & F.col(SLICE).isin(slices) & (F.col(BATCH) != batch_id)
    )
    # The batch's keys are the small side: the ledger is read, not shuffled.
    copies = known.select(KEY).join(asked.select(KEY), KEY, "left_semi").distinct()
    return events.join(copies, KEY, "left_anti")


def archive_batch(
    keyed: DataFrame,
    lake_path: str,
    ledger: str,
    batch_id: int,
    within: str | None,
    fold_every: int = folding.FOLD_BATCHES,
    fold_again: int = folding.FOLD_AGAIN,
) -> None:
    """Store the events of a batch that are new in the lake, and their keys in the ledger."""
    new = not_archived(keyed, ledger, batch_id, within).persist()
    try:
        lake.write_batch(ingest.normalize_events(new), lake_path, batch_id)
        folding.write_batch(new.select(KEY, AT, SLICE), AT, ledger, batch_id, BY_SLICE)
    finally:
        new.unpersist()
    folding.fold_when_due(
        keyed.sparkSession, ledger, LEDGER, AT, batch_id, fold_every, fold_again, further=BY_SLICE
    )
