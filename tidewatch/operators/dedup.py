"""Removal of redelivered events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import event as ev

KEY = "event_key"
ARRIVED = "arrived_at"


def _keyed(
    events: DataFrame, coordinates: list[str], identified: Column | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Events with ``event_key``, and apart from them those that have no key.

    With ``coordinates`` (columns that name a record, such as topic, partition and offset) an event
    without an id takes these as its key, so there is only one branch and the input is read once.
    So does one that is not ``identified``, where that is given. Without, the second filter names the
    stored columns, so a scan skips all row groups where every event has an id.
    """
    key = ev.event_key(F.col("meta"), F.col("id"))
    if coordinates:
        key = key if identified is None else F.when(identified, key)
        record = F.concat_ws("/", F.lit("record"), *coordinates)
        return events.withColumn(KEY, F.coalesce(key.cast("string"), record)), None
    anonymous = F.col("meta.id").isNull() & F.col("id").isNull()
    return events.withColumn(KEY, key).filter(~anonymous), events.filter(anonymous)


def with_key(events: DataFrame, coordinates: list[str], identified: Column | None = None) -> DataFrame:
    """Events with ``event_key``, their ``coordinates`` where they have no id that can be trusted."""
    return _keyed(events, coordinates, identified)[0]


def _joined(unique: DataFrame, anonymous: DataFrame | None) -> DataFrame:
    unique = unique.drop(KEY)
    return unique if anonymous is None else unique.unionByName(anonymous)


def dedup_events(events: DataFrame, coordinates: list[str] | None = None) -> DataFrame:
    """One row per event key; events without any identity are passed through. Copies are combined
    before the shuffle, so many copies of one event do not meet in one task. Which copy stays is
    not defined."""
    keyed, anonymous = _keyed(events, coordinates or [])
    return _joined(keyed.dropDuplicates([KEY]), anonymous)


def dedup_stream(
    events: DataFrame,
    delay: str,
    coordinates: list[str] | None = None,
    spread: Column | None = None,
    identified: Column | None = None,
) -> DataFrame:
    """One row per event key among copies that arrive within ``delay``; state is kept no longer.

    The clock is the time of the micro-batch that reads a row, not the event's own: it never
    goes back, so no row is late and none is dropped for its age, however far a topic partition
    lags. A copy that arrives after ``delay`` passes as a new event.

    A streaming shuffle is not preceded by a combine, so many copies of one event would meet in
    one task. ``spread`` (an expression that differs between copies, such as the topic offset)
    first removes copies per key and one of 16 slices of it. ``identified`` says where an event's own
    id can be trusted; elsewhere its ``coordinates`` are its key.
    """
    arrived = events.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, delay)
    keyed, anonymous = _keyed(arrived, coordinates or [], identified)
    if spread is not None:
        keyed = (
            keyed.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(16)))
            .dropDuplicatesWithinWatermark([KEY, "_slice"])
            .drop("_slice")
        )
    return _joined(keyed.dropDuplicatesWithinWatermark([KEY]), anonymous).drop(ARRIVED)
