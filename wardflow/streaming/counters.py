"""Delivery counters per micro-batch, observed on the stream itself and kept as rows."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sinks.tables import write_table
from .monitor import delivery_aggregates

COUNTERS_DDL = (
    "query_id STRING, batch_id BIGINT, messages_sent BIGINT, messages_failed BIGINT, bytes_sent BIGINT"
)


def observe_delivery(stream: DataFrame, name: str, good: Column | None = None) -> DataFrame:
    """The same stream, which reports sent, failed and bytes of ``value`` with every micro-batch."""
    first, *rest = delivery_aggregates(good)
    return stream.observe(name, first, *rest)


class DeliveryCounters(StreamingQueryListener):
    """Collects the counters of all queries that observe under ``name``.

    Counters wait on the driver, a row per micro-batch, until :meth:`flush` appends them to a table;
    the listener does so by itself whenever ``flush_rows`` wait.  A batch that is run again after
    a failure reports again, with the same numbers: :func:`read_counters` counts it once.
    """

    def __init__(self, spark: SparkSession, name: str, target: str, flush_rows: int = 10_000):
        self.spark, self.name, self.target, self.flush_rows = spark, name, target, flush_rows
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None:
            return
        values = [seen["messages_sent"], seen["messages_failed"], seen["bytes_sent"]]
        with self._change:
            self._rows.append((str(progress.id), progress.batchId, *values))
            full = len(self._rows) >= self.flush_rows
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def flush(self) -> None:
        with self._change:
            rows, self._rows = self._rows, []
        if rows:
            write_table(self.spark.createDataFrame(rows, COUNTERS_DDL).coalesce(1), self.target)

    def wait(self, queries: Sequence[StreamingQuery], timeout: float = 60.0) -> bool:
        """Wait until the events of ended queries have arrived (they come later than the end)."""
        runs = {str(q.runId) for q in queries}
        with self._change:
            return self._change.wait_for(lambda: runs <= self._ended, timeout)

    def __enter__(self) -> DeliveryCounters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()


def read_counters(spark: SparkSession, target: str) -> DataFrame:
    """One row per query and micro-batch."""
    return spark.read.schema(COUNTERS_DDL).parquet(target).dropDuplicates(["query_id", "batch_id"])
