"""Streaming sinks; every query is append mode with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..sources.messages import encode_json, for_ordered_topic


def trigger_args(every: str | None, available_now: bool) -> dict:
    """Trigger keywords: a processing-time interval, or drain what is there and stop."""
    if available_now:
        return {"availableNow": True}
    return {"processingTime": every} if every else {"processingTime": "0 seconds"}


def _writer(
    df: DataFrame, checkpoint: str | None, every: str | None, available_now: bool
) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").trigger(**trigger_args(every, available_now))
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """File sink (exactly once through its commit log); CSV gets a header."""
    if fmt == "csv":
        options = {"header": True, **options}
    writer = _writer(df, checkpoint, every, available_now)
    return writer.format(fmt).options(**options).option("path", path).start()


def write_console(
    df: DataFrame, every: str | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    writer = _writer(df, checkpoint, every, False)
    return writer.format("console").option("truncate", False).start()


def write_memory(df: DataFrame, name: str, available_now: bool = True) -> StreamingQuery:
    """In-memory table for interactive inspection of a small stream."""
    return _writer(df, None, None, available_now).format("memory").queryName(name).start()


def for_each_batch(
    df: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "30 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    return _writer(df, checkpoint, every, available_now).foreachBatch(handler).start()


def publish_json(
    df: DataFrame,
    key_col: str,
    target: str,
    order_col: str | None = None,
    partitions: int = 6,
    brokers: str | None = None,
) -> None:
    """Publish a batch as keyed JSON messages to a topic, or to a folder standing in for one.

    With ``order_col`` the events of one key stay together and in order, as a keyed topic
    promises.
    """
    laid_out = for_ordered_topic(df, key_col, order_col, partitions) if order_col else df
    messages = encode_json(laid_out, key_col)
    if brokers:
        options = {"kafka.bootstrap.servers": brokers, "topic": target}
        messages.write.format("kafka").options(**options).save()
    else:
        messages.write.mode("append").parquet(target)


def publish_stream(
    df: DataFrame, key_col: str, topic: str, brokers: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Publish a stream of rows as keyed JSON messages to a topic."""
    writer = _writer(encode_json(df, key_col), checkpoint, every, False).format("kafka")
    return writer.option("kafka.bootstrap.servers", brokers).option("topic", topic).start()
