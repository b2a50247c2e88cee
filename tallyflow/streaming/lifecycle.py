"""Starting, watching and stopping streaming queries."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..workspace import path_exists

POLL = 0.5  # seconds between looks at the queries


def start(
    writer: DataStreamWriter,
    name: str | None = None,
    every: str | None = None,
    continuous: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query. ``every`` is a processing-time interval, ``continuous`` a checkpoint interval."""
    if name:
        writer = writer.queryName(name)
    if every:
        writer = writer.trigger(processingTime=every)
    elif continuous:
        writer = writer.trigger(continuous=continuous)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def drain(*writers: DataStreamWriter, timeout: float | None = None) -> list[StreamingQuery]:
    """Process everything available now, all queries at once, and wait for the end.

    The first failure stops the other queries and is raised. There is no limit of time unless
    ``timeout`` seconds are given; then what still runs is stopped.
    """
    queries = [start(writer, available_now=True) for writer in writers]
    until = None if timeout is None else time.monotonic() + timeout
    while running := [query for query in queries if query.isActive]:
        _raise_failure(queries)
        if until is not None and time.monotonic() > until:
            _stop(running)
            raise TimeoutError(f"{len(running)} queries did not finish in {timeout} s")
        running[0].awaitTermination(POLL)
    _raise_failure(queries)
    return queries


def stop_on_marker(
    spark: SparkSession, marker: str, queries: Sequence[StreamingQuery] | None = None, interval: float = 10
) -> None:
    """Wait for the queries to end, and stop them all once the ``marker`` path exists.

    All active queries are watched together; the failure of any stops the rest and is raised.
    """
    watched = list(spark.streams.active if queries is None else queries)
    checked = 0.0
    while running := [query for query in watched if query.isActive]:
        _raise_failure(watched)
        if time.monotonic() - checked >= interval:
            checked = time.monotonic()
            if path_exists(spark, marker):
                _stop(running)
                return
        time.sleep(min(interval, POLL))
    _raise_failure(watched)


def _stop(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def _raise_failure(queries: Sequence[StreamingQuery]) -> None:
    failed = next((query for query in queries if not query.isActive and query.exception() is not None), None)
    if failed is not None:
        _stop([query for query in queries if query.isActive])
        raise failed.exception()


class ProgressLog(StreamingQueryListener):
    """Progress of every micro-batch of all queries started after ``watch``.

    A query itself remembers its last hundred reports only.
    """

    def __init__(self) -> None:
        self.reports: dict[str, list[dict]] = {}
        self.ended: set[str] = set()

    def watch(self, spark: SparkSession) -> ProgressLog:
        spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:
        self.reports.setdefault(str(event.runId), [])

    def onQueryProgress(self, event) -> None:
        self.reports.setdefault(str(event.progress.runId), []).append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery, patience: float = 30) -> list[dict]:
        """Reports of a run of a query. Events arrive late; those of an ended query are waited for."""
        until = time.monotonic() + patience
        while not query.isActive and str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return self.reports.get(str(query.runId), [])


def offset_audit(query: StreamingQuery, log: ProgressLog | None = None) -> list[dict]:
    """Offsets each finished micro-batch read, per source; all of them with a ``log``, else the last hundred."""
    return [
        {
            "batch": progress["batchId"],
            "source": source["description"],
            "start": source["startOffset"],
            "end": source["endOffset"],
            "rows": source["numInputRows"],
        }
        for progress in _reports(query, log)
        for source in progress["sources"]
    ]


def late_rows(query: StreamingQuery, log: ProgressLog | None = None) -> int:
    """Rows dropped because they were older than the watermark; of all batches with a ``log``."""
    return sum(state["numRowsDroppedByWatermark"] for progress in _reports(query, log) for state in progress["stateOperators"])


def _reports(query: StreamingQuery, log: ProgressLog | None) -> list:
    return query.recentProgress if log is None else log.of(query)
