"""Stream monitoring: one metrics row per micro-batch, with a running total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.streams import for_each_batch

METRICS_DDL = (
    "batch_id BIGINT, row_count BIGINT, total_rows BIGINT, newest_time STRING, "
    "newest_sample STRING"
)


def schema_report(df: DataFrame) -> DataFrame:
    """Columns and types of a stream (or table) as rows, before it starts."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position INT, column_name STRING, data_type STRING")


def monitor(
    stream: DataFrame,
    metrics: str,
    checkpoint: str,
    time_col: str = "charttime",
    newest: int = 3,
    every: str | None = "30 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Record id, rows, running total and the newest rows of every micro-batch.

    The batch is read once: the row count is observed below the top-n.  The total is carried
    from the previous batch's metrics instead of counting the lake again, and a repeated batch
    overwrites its own row.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation(f"batch_{batch_id}")
        counted = batch.observe(seen, F.count(F.lit(1)).alias("n"))
        top = counted.orderBy(F.col(time_col).desc_nulls_last()).limit(newest)
        rows = top.select(
            _time_text(top, time_col).alias("t"), F.to_json(F.struct("*")).alias("row")
        ).collect()
        n = seen.get["n"]
        total = _total_before(spark, metrics, batch_id) + n
        newest_time = rows[0]["t"] if rows else None
        sample = "\n".join(r["row"] for r in rows) or None
        line = spark.createDataFrame([(batch_id, n, total, newest_time, sample)], METRICS_DDL)
        line.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch={batch_id}")

    return for_each_batch(stream, record, checkpoint, every, available_now)


def _time_text(df: DataFrame, name: str) -> Column:
    """A time as text, always with six digits of the second's fraction; text stays as it is."""
    text = F.col(name).cast("string")
    if not dict(df.dtypes)[name].startswith("timestamp"):
        return text
    second, fraction = (F.split_part(text, F.lit("."), F.lit(i)) for i in (1, 2))
    return F.concat(second, F.lit("."), F.rpad(fraction, 6, "0"))


def _total_before(spark: SparkSession, metrics: str, batch_id: int) -> int:
    if batch_id == 0:
        return 0
    row = spark.read.schema(METRICS_DDL).parquet(f"{metrics}/batch={batch_id - 1}").first()
    return row["total_rows"]


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    return spark.read.schema(METRICS_DDL).parquet(metrics)


def delivery_aggregates(good: Column | None = None) -> list[Column]:
    """Messages sent, failed, and bytes of the message values sent."""
    ok = F.lit(True) if good is None else F.coalesce(good, F.lit(False))
    return [
        F.count_if(ok).alias("messages_sent"),
        F.count_if(~ok).alias("messages_failed"),
        F.coalesce(F.sum(F.when(ok, F.octet_length("value"))), F.lit(0)).alias("bytes_sent"),
    ]


def delivery_counters(messages: DataFrame, good: Column | None = None) -> DataFrame:
    """The counters of a whole batch frame; :mod:`streaming.counters` has those of a stream."""
    return messages.agg(*delivery_aggregates(good))
