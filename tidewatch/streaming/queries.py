"""Starting streaming queries. Each query owns one stable checkpoint and resumes from it."""

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: how often a stream looks for records.
LIVE_INTERVAL = "5 seconds"


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything the source holds now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_forever(writer: DataStreamWriter, interval: str = LIVE_INTERVAL) -> StreamingQuery:
    return writer.trigger(processingTime=interval).start()


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the query's recent batches dropped for being older than the watermark.

    An aggregation counts partial groups here, not events.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
