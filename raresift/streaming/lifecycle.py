"""When a streaming query ends (STR4, STR5, STR7, AGG13).

The driver waits for events that Spark posts about the query, and never
polls: each micro-batch reports its rows and its observed counts of
sentinels, an idle source reports that there is nothing new, and the end of
the query is an event as well.  ``follow`` sleeps until one of them decides,
or until the run-time cap is reached, and stops the query from its own thread.
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

KIND_METRICS = "raresift_kinds"
#: Seconds to wait for the events of a query that has ended.
LAST_EVENTS_SECONDS = 10.0


def with_kind_metrics(scored: DataFrame) -> DataFrame:
    """Attach per-batch counts of sentinels and rows to the query's progress.

    The counts travel with each micro-batch's progress report
    (``observedMetrics``), so the driver can follow the stream without
    scanning the sink.
    """
    return scored.observe(
        KIND_METRICS,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("kind") == "sentinel").alias("sentinels"),
    )


@dataclass
class StreamRun:
    """Outcome of one run.

    ``finished`` is False if the run-time cap or a number of batches cut it:
    then the sink may hold part of the source only.
    """

    sink_path: str
    elapsed_seconds: float
    finished: bool
    batches: int
    input_rows: int
    batch_ms: list[int]  # read-score-commit time of each non-empty micro-batch
    batch_rows: list[int]
    end_offsets: list[str]  # where each of them ended in its first source, as JSON


class Lifecycle(StreamingQueryListener):
    """Gathers one query's batches from its events, and says when it may stop.

    A report of no rows carries the id of the batch to come, and doesn't
    count as a batch; after a sentinel it means that the source is drained.
    """

    def __init__(self, query: StreamingQuery, until_drained: bool = False, max_batches: int | None = None):
        super().__init__()
        self.run_id, self.until_drained, self.max_batches = str(query.runId), until_drained, max_batches
        self.rows: dict[int, int] = {}
        self.ms: dict[int, int] = {}
        self.ends: dict[int, str] = {}
        self.sentinels = 0
        self.drained = self.cut = False
        self.decided, self.over = threading.Event(), threading.Event()
        self._lock = threading.Lock()
        self._known: set[int] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802 (Spark's name)
        """Nothing to do: batches count, not starts."""

    def onQueryProgress(self, event) -> None:  # noqa: N802
        if str(event.progress.runId) == self.run_id:
            self.take(event.progress)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run_id:
            self._idle()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run_id:
            self.over.set()
            self.decided.set()

    def _idle(self) -> None:
        if self.until_drained and self.sentinels:
            self.drained = True
            self.decided.set()

    def take(self, progress) -> None:
        """Count one report; a report that was seen before changes nothing."""
        rows = int(progress.numInputRows or 0)
        if not rows:
            self._idle()
            return
        with self._lock:
            batch = int(progress.batchId)
            if batch in self._known:
                return
            self._known.add(batch)
            self.rows[batch] = rows
            self.ms[batch] = int((progress.durationMs or {}).get("triggerExecution", 0))
            self.ends[batch] = str(progress.sources[0].endOffset) if progress.sources else ""
            counts = (progress.observedMetrics or {}).get(KIND_METRICS)
            self.sentinels += int(counts["sentinels"]) if counts is not None else 0
        if self.max_batches is not None and len(self.rows) >= self.max_batches:
            self.cut = True
            self.decided.set()


def follow(
    query: StreamingQuery,
    sink_path: str,
    max_runtime_seconds: float | None = None,
    until_drained: bool = False,
    max_batches: int | None = None,
    spark: SparkSession | None = None,
) -> StreamRun:
    """Wait until the query ends by itself, has drained its source behind a sentinel, or is cut; then stop it.

    ``until_drained``: stop at the first report of no new rows after a batch
    that held a sentinel (STR4).  Spark posts such reports every
    ``spark.sql.streaming.noDataProgressEventInterval``.  ``max_batches``:
    stop after so many batches that brought rows.  ``max_runtime_seconds``
    (STR5): rows still unread then stay in the source for the next run.
    ``elapsed_seconds`` is the driver's clock from start to stop (AGG13).  A
    query that failed raises its error.  ``spark`` is the query's session
    (default: the active one).
    """
    started = time.time()
    manager = (spark or SparkSession.active()).streams
    events = Lifecycle(query, until_drained, max_batches)
    manager.addListener(events)
    try:
        for progress in query.recentProgress:  # reports from before the listener
            events.take(progress)
        if query.isActive:
            rest = None if max_runtime_seconds is None else max(0.0, started + max_runtime_seconds - time.time())
            events.decided.wait(rest)
        alone = not query.isActive
        if not alone:
            query.stop()
        events.over.wait(LAST_EVENTS_SECONDS)
    finally:
        if query.isActive:
            query.stop()
        manager.removeListener(events)
    query.awaitTermination()  # raises what the query failed with
    for progress in query.recentProgress:
        events.take(progress)
    order = sorted(events.rows)
    return StreamRun(
        sink_path,
        time.time() - started,
        events.drained or (alone and not events.cut),
        len(order),
        sum(events.rows.values()),
        [events.ms[b] for b in order],
        [events.rows[b] for b in order],
        [events.ends[b] for b in order],
    )
