"""Counters of running ingest queries (F8, A4, A5): per micro-batch and in total.

What a batch holds (messages in, objects out, rows that passed and failed) is observed
inside its own jobs; a ``StreamingQueryListener`` adds the query's progress (input rows
per second, duration) to it. No job runs for a counter.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

COUNTS = ("messages_in", "objects_out", "total", "success", "failure")


def rates(counts: dict) -> dict:
    """A4, A5: success percent (one digit) and null percent (two), 0.0 of nothing."""
    n = counts["total"]
    return {"success_pct": round(counts["success"] * 100 / n, 1) if n else 0.0,
            "null_pct": round(counts["failure"] * 100 / n, 2) if n else 0.0}


class StreamCounters(StreamingQueryListener):
    """Give one to ``start_ingest(counters=...)``; it may serve several queries."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._batches: dict[tuple[str, int], dict] = {}
        self._progress: dict[tuple[str, int], dict] = {}
        self._spark: SparkSession | None = None

    def attach(self, spark: SparkSession) -> None:
        """Listen to the session's queries (once)."""
        if self._spark is None:
            self._spark = spark
            spark.streams.addListener(self)

    def detach(self) -> None:
        if self._spark is not None:
            self._spark.streams.removeListener(self)
            self._spark = None

    def add(self, query_id: str, batch_id: int, counts: dict) -> None:
        with self._lock:
            self._batches[query_id, batch_id] = {k: int(counts[k]) for k in COUNTS}

    def batches(self, query_id: str | None = None) -> list[dict]:
        """A row per batch, in order: its counts, rates, and progress as far as known."""
        with self._lock:
            return [{"query_id": q, "batch_id": b, **c, **rates(c), **self._progress.get((q, b), {})}
                    for (q, b), c in sorted(self._batches.items()) if query_id in (None, q)]

    def totals(self, query_id: str | None = None) -> dict:
        """Counts and rates over all batches so far."""
        rows = self.batches(query_id)
        sums = {k: sum(r[k] for r in rows) for k in COUNTS}
        return {"batches": len(rows), **sums, **rates(sums)}

    # ---- StreamingQueryListener -------------------------------------------
    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self._progress[str(p.id), p.batchId] = {
                "input_rows_per_second": p.inputRowsPerSecond, "processed_rows_per_second": p.processedRowsPerSecond,
                "duration_ms": int(p.durationMs.get("triggerExecution", 0))}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
