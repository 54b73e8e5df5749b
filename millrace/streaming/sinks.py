"""Delivery of streamed changes to listeners."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.model import MAX_TS
from millrace.operators.matcher import ordered

Listener = Callable[[DataFrame, int], None]


class Closing(StreamingQueryListener):
    """Calls ``close(error)`` of those listeners that have it once their query has ended; the error is None after a stop."""

    def __init__(self, listeners: Iterable[Listener]) -> None:
        self.listeners, self.run = list(listeners), ""

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run:
            for listener in self.listeners:
                if hasattr(listener, "close"):
                    listener.close(event.exception)


def deliver(changes: DataFrame, listeners: Iterable[Listener], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start a query that hands each micro-batch, in order of commit, to every listener.

    The batch number lets a listener skip what it has seen before a restart. The query ends with the
    first error of a listener, which ``awaitTermination`` raises. Listeners with a method ``close`` get the error's
    text, or None, when the query has ended.
    """
    listeners = list(listeners)

    def each(batch: DataFrame, number: int) -> None:
        rows = ordered(batch).persist()
        try:
            for listener in listeners:
                listener(rows, number)
        finally:
            rows.unpersist()

    writer = changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    closing = Closing(listeners)
    changes.sparkSession.streams.addListener(closing)
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    closing.run = str(query.runId)
    return query


class Until:
    """A query that is stopped once the frontier it delivers has passed ``end_ts``."""

    def __init__(self, end_ts: int) -> None:
        self.end_ts, self.frontier, self.batch, self.passed = end_ts, -1, -1, threading.Event()
        self.query: StreamingQuery | None = None

    def see(self, frontier: int | None, batch: int) -> None:
        if frontier is not None and frontier > self.frontier:
            self.frontier = frontier
        if self.frontier > self.end_ts and not self.passed.is_set():
            self.batch = batch
            self.passed.set()

    def wait(self, timeout: float | None = None) -> int:
        """Wait for the frontier to pass the end, or for the query to end by itself; then stop it and return the frontier.

        The micro-batch that passed the end is committed first, so a restart doesn't deliver it again.
        """
        ends = None if timeout is None else time.monotonic() + timeout
        while self.query.isActive and (ends is None or time.monotonic() < ends):
            if self.passed.wait(0.1) and (self.query.lastProgress or {"batchId": -1})["batchId"] >= self.batch:
                break
            if self.passed.is_set():
                time.sleep(0.05)
        self.query.stop()
        return self.frontier


def deliver_until(rows: DataFrame, listeners: Iterable[Listener], checkpoint: str, end_ts: int = MAX_TS) -> Until:
    """Hand the changes of ``feed.stream_feed`` up to ``end_ts`` to every listener in commit order, until the frontier is past it."""
    listeners, until = list(listeners), Until(end_ts)

    def each(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            changes = ordered(held.where((F.col("kind") == "change") & (F.col("commit_ts") <= end_ts)).drop("kind"))
            for listener in listeners:
                listener(changes, number)
            until.see(held.where("kind = 'resolved'").agg(F.max("frontier_ts")).first()[0], number)
        finally:
            held.unpersist()

    closing = Closing(listeners)
    rows.sparkSession.streams.addListener(closing)
    until.query = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()
    closing.run = str(until.query.runId)
    return until
