"""An alarm for a feed that has fallen silent, raised while it lasts.

``operators.monitoring.silence_now`` answers when somebody asks; here the stream itself keeps the time
of the last arrival of each feed, with a timer that goes off when nothing has come for so long. It
writes a row when the silence begins to count and another one when it ends. The times are those of
arrival: an event stamped wrongly neither hides a silence nor makes one.
"""

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.operators.monitoring import SILENCE_MINUTES
from tidewatch.schemas import LONG, TEXT, TIME, struct
from tidewatch.sources.tables import read_table

ALARMS_SCHEMA = struct({"feed": TEXT, "silent_since": TIME, "silent_until": TIME, "seconds": LONG})
_STATE = "arrived long, silent boolean"


def _arrivals(records: DataFrame, feed: Column) -> DataFrame:
    """One row per feed and task: that something came is all that matters, so however much comes, few
    rows meet in the state."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[str | None] = set()
        for batch in batches:
            new = set(batch.column(0).unique().to_pylist()) - known
            known |= new
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.string())], names=["feed"])

    return records.select(feed.cast("string").alias("feed")).mapInArrow(seen, "feed string")


def silence_alarms(
    records: DataFrame, seconds: int = 60 * SILENCE_MINUTES, feed: Column | None = None
) -> DataFrame:
    """``feed, silent_since, silent_until, seconds`` of a stream: a row with an open end when nothing has
    come for ``seconds``, and a row with the end when something comes again. ``feed`` tells several
    apart, such as topic partitions; without it there is one. A feed that has never sent anything is
    not known. Start it with a processing-time trigger: timers go off at triggers."""

    def watch(
        key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        arrived, silent = state.get if state.exists else (now, False)
        if state.hasTimedOut:
            state.update((arrived, True))
            yield row(key, arrived, None, now)
            return
        for _ in parts:
            pass
        if silent:
            yield row(key, arrived, now, now)
        state.update((now, False))
        state.setTimeoutDuration(1000 * seconds)

    def row(key: tuple, since: int, until: int | None, now: int) -> pd.DataFrame:
        times = [None if ms is None else datetime.fromtimestamp(ms / 1000, timezone.utc) for ms in (since, until)]
        return pd.DataFrame(
            {
                "feed": [key[0]],
                "silent_since": pd.to_datetime([times[0]], utc=True),
                "silent_until": pd.to_datetime([times[1]], utc=True),
                "seconds": [(now - since) // 1000],
            }
        )

    return (
        _arrivals(records, F.lit("feed") if feed is None else feed)
        .groupBy("feed")
        .applyInPandasWithState(
            watch, ALARMS_SCHEMA, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
        )
    )


def alarms_writer(alarms: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        alarms.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def read_alarms(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ALARMS_SCHEMA)
