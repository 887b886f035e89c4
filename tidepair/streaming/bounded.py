"""Bounded runs of live queries: until what has landed is committed, or a deadline."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class CaughtUp(StreamingQueryListener):
    """Knows when a query on a trigger has nothing left to read or to emit.

    A batch that reads rows moves the watermark, so a batch without rows follows it
    and emits what that has closed.  A query has caught up when a trigger finds
    no new data after that: it is reported as idle, or its batch read nothing.
    """

    def __init__(self, run_id: str) -> None:
        self.run_id = run_id
        self.done = threading.Event()
        self.batches = self.rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) != self.run_id:
            return
        self.batches += 1
        self.rows += event.progress.numInputRows
        if event.progress.numInputRows == 0:
            self.done.set()

    def onQueryIdle(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.done.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.done.set()


def run_until_caught_up(
    spark: SparkSession, start: Callable[[], StreamingQuery], seconds: float
) -> tuple[StreamingQuery, bool]:
    """Start a query by ``start()`` and stop it once it has caught up, at the latest after
    ``seconds``.  Returns it and whether it did.  A query that failed raises its error.

    What was committed stays: the same call on the same checkpoint goes on from there.
    """
    query = start()
    listener = CaughtUp(str(query.runId))
    spark.streams.addListener(listener)
    try:
        # a short run may be over before the listener hears of it
        seen = query.recentProgress
        caught = bool(seen and seen[-1]["numInputRows"] == 0) or listener.done.wait(seconds)
    finally:
        query.stop()
        spark.streams.removeListener(listener)
    if error := query.exception():
        raise error
    return query, caught
