"""Stopping rules for long-running queries (driver-side control only).

``run_all_until`` replaces the reference's flag polled from inside the callback. A
``StreamingQueryListener`` tells it when a query has finished a batch, had nothing to do or
has ended; between events it sleeps until the next idle limit can be reached. The idle clock
of a query starts when the run starts, so a stream that never receives data still stops;
while a batch is being worked on, the clock does not run.
"""

from __future__ import annotations

import threading
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class _Progress(StreamingQueryListener):
    """Non-empty batches and ends of queries by their run id, and a signal for each event."""

    def __init__(self) -> None:
        self.changed = threading.Condition()
        self.batches: dict[str, set[int]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows > 0:
            with self.changed:
                self.batches.setdefault(str(event.progress.runId), set()).add(event.progress.batchId)
                self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass  # idle time is a matter of the clock

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()


@contextmanager
def _listening(spark: SparkSession):
    progress = _Progress()
    spark.streams.addListener(progress)
    try:
        yield progress
    finally:
        spark.streams.removeListener(progress)


def non_empty_batches(query: StreamingQuery) -> set[int]:
    """Of the query's last progress reports (those from before a listener was added, too)."""
    return {p["batchId"] for p in query.recentProgress if p.get("numInputRows", 0) > 0}


def is_working(query: StreamingQuery) -> bool:
    """A trigger is running and has data: not idle, however long it takes."""
    status = query.status
    return bool(status.get("isTriggerActive") and status.get("isDataAvailable"))


def run_all_until(queries: list[StreamingQuery], max_batches: int | None = None,
                  idle_seconds: float | None = None, spark: SparkSession | None = None) -> list[int]:
    """Block until every query has run ``max_batches`` non-empty batches, has had nothing
    to do for ``idle_seconds``, or has ended. The clock of a query stands still while it
    works on a batch. Returns the counts of non-empty batches; no limit means no end."""
    if not queries:
        return []
    runs = [str(q.runId) for q in queries]
    with _listening(spark or SparkSession.builder.getOrCreate()) as progress:
        seen = [non_empty_batches(q) for q in queries]  # done before the listener was there
        since = [time.monotonic()] * len(queries)
        open_runs = set(range(len(queries)))
        while open_runs:
            for i in sorted(open_runs):
                with progress.changed:
                    done = progress.batches.get(runs[i], set())
                    if done - seen[i]:
                        since[i] = time.monotonic()
                    seen[i] |= done
                    over = runs[i] in progress.ended
                if over or not queries[i].isActive:
                    open_runs.discard(i)
                    continue
                idle = idle_seconds is not None and time.monotonic() - since[i] >= idle_seconds
                if idle and is_working(queries[i]):
                    since[i], idle = time.monotonic(), False
                if idle or max_batches is not None and len(seen[i]) >= max_batches:
                    queries[i].stop()
                    open_runs.discard(i)
            if not open_runs:
                break
            wait = None if idle_seconds is None else max(
                0.01, min(since[i] for i in open_runs) + idle_seconds - time.monotonic())
            with progress.changed:
                fresh = any(progress.batches.get(runs[i], set()) - seen[i] or runs[i] in progress.ended
                            for i in open_runs)
                if not fresh:
                    progress.changed.wait(wait)
    for i, q in enumerate(queries):
        if q.exception() is None:
            q.awaitTermination()
        seen[i] |= non_empty_batches(q)
    return [len(s) for s in seen]


def run_until(query: StreamingQuery, max_batches: int | None = None,
              idle_seconds: float | None = None) -> int:
    """``run_all_until`` for one query."""
    return run_all_until([query], max_batches, idle_seconds)[0]


def await_all(spark: SparkSession, queries: list[StreamingQuery],
              timeout_seconds: float | None = None) -> None:
    """Run several queries together (start all first, then wait on any)."""
    if timeout_seconds is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(int(timeout_seconds))
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
