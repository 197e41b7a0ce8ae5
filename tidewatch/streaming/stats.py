"""Ingest counters of a running stream."""

import logging

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from tidewatch.operators.ingest import ingest_counters

INGEST = "ingest"
log = logging.getLogger(__name__)


def observe_ingest(decoded: DataFrame) -> DataFrame:
    """Count seen, failed, skipped and sent events while the batch flows through."""
    return decoded.observe(INGEST, *ingest_counters())


class IngestTotals(StreamingQueryListener):
    """Adds up the observed counters of all batches."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counted = event.progress.observedMetrics.get(INGEST)
        if counted is None:
            return
        for name, value in counted.asDict().items():
            self.totals[name] = self.totals.get(name, 0) + value
        log.info("ingest totals: %s", self.totals)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
