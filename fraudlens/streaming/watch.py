"""What a running job tells: rows that came behind the watermark, as they are dropped."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


def _to_stderr(text: str) -> None:
    print(text, file=sys.stderr, flush=True)


class DroppedRows(StreamingQueryListener):
    """A running total of rows left out, told whenever it has grown. Attach it before the query starts.

    Spark counts what a stateful operator drops; a row that falls into several windows counts for each of them.
    """

    def __init__(self, tell: Callable[[str], None] = _to_stderr) -> None:
        self.tell, self.total = tell, 0
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if not dropped:
            return
        name = str(progress.id)
        self.by_query[name] = self.by_query.get(name, 0) + dropped
        self.total += dropped
        self.tell(f"{dropped} rows came behind the watermark in micro-batch {progress.batchId} and were left out, {self.by_query[name]} so far; see --watermark-delay")


def attach(spark: SparkSession, listener: StreamingQueryListener) -> StreamingQueryListener:
    spark.streams.addListener(listener)
    return listener


def settle(spark: SparkSession) -> None:
    """Waits until the listeners have heard of all the progress of queries that have ended."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
