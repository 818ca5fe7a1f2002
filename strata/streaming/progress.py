"""What streaming queries report over their whole life; Spark itself keeps the last 100 reports of each."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Totals:
    """Sums over all micro-batches of one run of a query."""

    batches: int = 0
    rows: int = 0
    late: int = 0  # rows that stateful operators dropped behind the watermark
    peak_state: int = 0  # most rows that all its state held after a batch
    ended: threading.Event = field(default_factory=threading.Event, repr=False)


_runs: dict[str, Totals] = {}
_lock = threading.Lock()


def _of(run_id: str) -> Totals:
    with _lock:
        return _runs.setdefault(run_id, Totals())


class _Listener(StreamingQueryListener):
    def onQueryStarted(self, event) -> None:
        _of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        totals = _of(str(report.runId))
        totals.batches += 1
        totals.rows += report.numInputRows
        totals.late += sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
        totals.peak_state = max(totals.peak_state, sum(s.numRowsTotal for s in report.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        _of(str(event.runId)).ended.set()


def watch(spark: SparkSession) -> None:
    """Add up what this session's queries report from now on; a second call does nothing."""
    if not getattr(spark, "_strata_watched", False):
        spark.streams.addListener(_Listener())
        spark._strata_watched = True


def totals(query: StreamingQuery, wait_seconds: float = 60.0) -> Totals:
    """The sums of a query that was started in a watched session.

    Reports come some moments after their batch. For a query that has ended this waits until all
    have come, and raises TimeoutError if they don't; of one that still runs, the latest may be missing.
    """
    found = _of(str(query.runId))
    if not query.isActive and not found.ended.wait(wait_seconds):
        raise TimeoutError(f"no end of query {query.name or query.id} was reported in {wait_seconds} seconds")
    return found
