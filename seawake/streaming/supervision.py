"""Supervision of streams: their progress as a table, and restarts of the query that failed."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = ("query string, run string, batch long, moment string, rows_in long, rows_per_second double, "
            "late_rows long, state_rows long, seconds double, watermark string")


class ProgressLog(StreamingQueryListener):
    """Keeps a row for every micro-batch: rows read, rows dropped because they came after the watermark, state, time.

    Late rows of one key and window that come in one micro-batch are summed up before they are dropped and count once.
    Rows wait in memory until :meth:`flush` appends them to a table; the supervising loop does that, so that no Spark
    job runs inside the listener's callback. An entry is a few hundred bytes, whatever the size of the batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        operators = p.stateOperators
        row = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond or 0.0),
               sum(s.numRowsDroppedByWatermark for s in operators), sum(s.numRowsTotal for s in operators),
               (p.durationMs or {}).get("triggerExecution", 0) / 1000.0, (p.eventTime or {}).get("watermark"))
        with self._lock:
            self._rows.append(row)

    def flush(self) -> int:
        """Appends what has come in since; returns the number of rows."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)


def supervise(start: Mapping[str, Callable[[], StreamingQuery]], *, restarts: int = 3, pause: float = 5.0,
              log: ProgressLog | None = None) -> dict[str, int]:
    """Starts every query and watches them until all have ended; returns how often each was restarted.

    A query that fails is started again by its own function, from its own checkpoint; the others run on. After
    ``restarts`` failures it is given up; when the others have ended, its error is raised.
    """
    running = {name: begin() for name, begin in start.items()}
    failures = dict.fromkeys(start, 0)
    given_up: dict[str, Exception] = {}
    if log:
        log.spark.streams.addListener(log)
    try:
        while running:
            time.sleep(pause)
            for name, query in list(running.items()):
                if query.isActive:
                    continue
                error = query.exception()
                del running[name]
                if error is None:
                    continue
                if failures[name] >= restarts:
                    given_up[name] = error
                else:
                    failures[name] += 1
                    running[name] = start[name]()
            if log:
                log.flush()
    finally:
        if log:
            time.sleep(min(pause, 1.0))  # the last events come after the query has ended
            log.spark.streams.removeListener(log)
            log.flush()
    if given_up:
        name, error = next(iter(given_up.items()))
        raise RuntimeError(f"given up after {restarts} restarts: {', '.join(given_up)}; {name}: {error}") from error
    return failures
