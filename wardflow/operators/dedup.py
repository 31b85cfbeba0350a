"""Deduplication by key, for batch and for streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per key; NULLs in a key count as equal.

    With ``order_by`` the survivor is the first row in that order, otherwise any row.  The
    ``row_number() = 1`` form is planned with a group limit below the shuffle, and
    ``dropDuplicates`` as a partial aggregate, so each task ships at most one row of a hot key.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    return top_per_key(df, keys, order_by, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key in the given order."""
    rank = "_rank"
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.filter(F.col(rank) <= n).drop(rank)


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str],
    horizon: tuple[str, str] | None = None,
    spread: int = 0,
) -> DataFrame:
    """Streaming dedup over the whole stream, or within an event-time horizon.

    ``horizon=(event_time_column, delay)`` bounds the state: a copy that arrives later than the
    delay after its first may pass again, and rows behind the watermark are dropped, so the
    delay must exceed the disorder of the input.  The column may be text; rows whose time cannot
    be read are compared within a micro-batch.  Without it state grows with the number of
    distinct keys (use the RocksDB state store).

    ``spread`` > 0 adds a first stage keyed by (key, input partition modulo ``spread``), so that
    copies of one hot key are first thinned out in parallel.
    """
    if horizon is not None:
        column, delay = horizon
        time, kind = F.col(column), dict(df.dtypes)[column]
        if kind == "timestamp":
            return df.withWatermark(column, delay).dropDuplicatesWithinWatermark(list(keys))
        if kind == "string":
            time = F.try_to_timestamp(time)
        # A copy of the column carries the watermark, so its own type stays as it is.
        timed = df.withColumn("_event_time", time).withWatermark("_event_time", delay)
        return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")
    if spread > 0:
        lane = "_lane"
        salted = df.withColumn(lane, F.spark_partition_id() % spread)
        df = salted.dropDuplicates([*keys, lane]).drop(lane)
    return df.dropDuplicates(list(keys))
