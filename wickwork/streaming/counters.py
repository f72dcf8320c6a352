"""Counters of a running stream, from the progress Spark reports."""

from __future__ import annotations

import json

from pyspark.sql.streaming import StreamingQueryListener


def _numbers(offset) -> dict[str, int]:
    """The whole numbers in an offset, by their place: files, rows or records of partitions."""
    try:
        value = json.loads(offset) if isinstance(offset, str) else offset
    except ValueError:
        return {}
    if isinstance(value, dict):
        return {f"{k}.{place}": n for k, part in value.items() for place, n in _numbers(part).items()}
    return {"": value} if isinstance(value, int) else {}


def _ahead(latest, read) -> int:
    """How far ``latest`` is ahead of ``read``; 0 where a source does not say."""
    done = _numbers(read)
    return sum(max(n - done.get(place, 0), 0) for place, n in _numbers(latest).items())


class Counters(StreamingQueryListener):
    """Adds up input rows, late rows and the observed ingest metrics."""

    def __init__(self):
        self.totals: dict[str, int] = {"input_rows": 0, "dropped_late": 0, "batches": 0}
        # Input that a source has and the query has not read, by its offsets.
        self.backlog: int = 0
        self.last_batch_ms: int | None = None
        self.rows_per_second: float | None = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        self.totals["batches"] += 1
        self.totals["input_rows"] += progress.numInputRows
        self.totals["dropped_late"] += sum(
            s.numRowsDroppedByWatermark for s in progress.stateOperators
        )
        for row in progress.observedMetrics.values():
            for name, value in row.asDict().items():
                self.totals[name] = self.totals.get(name, 0) + (value or 0)
        self.backlog = sum(_ahead(s.latestOffset, s.endOffset) for s in progress.sources)
        self.last_batch_ms = progress.durationMs.get("triggerExecution")
        self.rows_per_second = progress.processedRowsPerSecond

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
