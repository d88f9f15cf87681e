"""Counts of running streams (K7), over every micro-batch and not only the newest hundred that Spark keeps."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

COLUMNS = "query string, batch long, rows_in long, dropped long"


class BatchCounts(StreamingQueryListener):
    """Adds up rows read and rows dropped behind the watermark of every query of a session.

    A batch that is reported again, as after a restart, counts once. Totals survive as
    long as the driver; ``write`` puts the batches into a table for longer.
    """

    def __init__(self):
        self._lock = threading.Lock()
        self._batches: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        with self._lock:
            self._batches[str(p.id)][p.batchId] = (p.numInputRows, dropped)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.id))

    def wait_for(self, query, seconds: float = 30.0) -> None:
        """Until the query's end has been reported; events come a little after the query."""
        import time

        until = time.monotonic() + seconds
        while str(query.id) not in self._ended and time.monotonic() < until:
            time.sleep(0.05)

    def totals(self, query) -> dict[str, int]:
        """Batches, rows read and rows dropped of one query."""
        with self._lock:
            batches = list(self._batches[str(query.id)].values())
        return {"batches": len(batches), "rows_in": sum(b[0] for b in batches), "dropped": sum(b[1] for b in batches)}

    def table(self, spark: SparkSession) -> DataFrame:
        """(query, batch, rows_in, dropped), one row per batch so far."""
        with self._lock:
            rows = [(q, b, *counts) for q, batches in self._batches.items() for b, counts in sorted(batches.items())]
        return spark.createDataFrame(rows, COLUMNS)

    def write(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("append").parquet(path)


def counted(spark: SparkSession) -> BatchCounts:
    """A listener that is at work from now on; ``spark.streams.removeListener`` ends it."""
    listener = BatchCounts()
    spark.streams.addListener(listener)
    return listener
