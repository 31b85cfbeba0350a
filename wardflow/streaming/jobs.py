"""Streaming jobs: messages -> bronze -> silver, enrichment with load shedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import enrich_items, flag_out_of_range
from ..operators.sampling import critical_sample
from ..schemas import column_names
from ..session import STATE_STORE_CONF, scoped_conf
from ..sinks.committed import CommittedTable
from ..sinks.streams import for_each_batch, write_stream
from ..sources.messages import decode_json
from ..sources.readers import read_stream
from ..specs import FactSpec

# First-stage lanes of the streaming dedup; see operators.dedup.dedup_stream.
DEDUP_LANES = 8


def ingest_bronze(
    messages: DataFrame,
    spec: FactSpec,
    bronze: str,
    checkpoint: str,
    quarantine: str,
    every: str | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Land keyed JSON messages as typed rows stamped with ``ingest_ts``.

    Malformed messages are left out of bronze; a second query keeps their raw text in
    ``quarantine``, so no message is lost.
    """
    split = decode_json(messages, spec.source_ddl)
    stamped = split.good.withColumn("ingest_ts", F.current_timestamp())
    run = {"every": every, "available_now": available_now}
    bad = split.bad.withColumn("ingest_ts", F.current_timestamp())
    return [
        write_stream(stamped, bronze, f"{checkpoint}/bronze", **run),
        write_stream(bad, quarantine, f"{checkpoint}/quarantine", **run),
    ]


def bronze_to_silver(
    spark: SparkSession,
    spec: FactSpec,
    bronze: str,
    silver: str,
    checkpoint: str,
    horizon: tuple[str, str] | None,
    max_files: int | None = 10,
    every: str | None = "1 minute",
    available_now: bool = False,
    lanes: int = DEDUP_LANES,
) -> StreamingQuery:
    """Clean, dedup and type bronze rows into silver, each bronze file once.

    ``horizon`` bounds the dedup state and has no default: an event-time column with the longest
    delay of a copy, or None to keep every key for good (see :func:`operators.dedup.dedup_stream`).
    The query starts with its dedup state in RocksDB, whatever the session's default is.
    """
    rows = read_stream(spark, bronze, spec.source_ddl, max_files=max_files)
    cleaned = spec.clean(rows, spread=lanes, horizon=horizon)
    silver_rows = cleaned.select(*column_names(spec.source_ddl), "processed_timestamp")
    with scoped_conf(spark, STATE_STORE_CONF):
        return write_stream(
            silver_rows, silver, checkpoint, every=every, available_now=available_now
        )


def exact_silver_table(spec: FactSpec, path: str) -> CommittedTable:
    """The silver table of :func:`bronze_to_silver_exact`, partitioned by month of the event."""
    types = {f.name: f.dataType.simpleString() for f in _cleaned_schema(spec)}
    columns = [*column_names(spec.source_ddl), "processed_timestamp"]
    return CommittedTable(path, ", ".join(f"{c} {types[c]}" for c in columns), ["month"])


def _cleaned_schema(spec: FactSpec):
    spark = SparkSession.active()
    return spec.clean(spark.createDataFrame([], spec.source_ddl)).schema


def bronze_to_silver_exact(
    spark: SparkSession,
    spec: FactSpec,
    bronze: str,
    silver: CommittedTable,
    checkpoint: str,
    name: str,
    recent: str = "1 hour",
    max_files: int | None = 10,
    every: str | None = "1 minute",
    available_now: bool = False,
) -> StreamingQuery:
    """Clean and type bronze rows into silver, each key once for good, with bounded state.

    Two steps find copies.  The state store holds the keys of the last ``recent`` of arrival time,
    which never runs behind its own watermark, so no row is dropped as late, however old its event
    is.  What passes is held against the key hashes that silver stores for the months concerned, and
    on a match against the keys.  Copies must have the event time of their first, as the keys that
    the specs name do; rows whose time cannot be read share month 0.

    ``name`` tells this stream's batches from those of others in the log of ``silver``.
    """
    rows = read_stream(spark, bronze, spec.source_ddl, max_files=max_files)
    arriving = rows.withColumn("_arrival", F.current_timestamp())
    cleaned = spec.clean(arriving, horizon=("_arrival", recent))
    month = F.coalesce(F.date_format(spec.event_time, "yyyyMM"), F.lit("0"))
    cleaned = cleaned.select(
        *column_names(spec.source_ddl), "processed_timestamp", month.alias("month")
    )

    # Rows of one batch arrive at one time, so the state passes one row per key, however short
    # ``recent`` is.
    def add(batch: DataFrame, batch_id: int) -> None:
        silver.append_new(batch, spec.keys, f"{name}-{batch_id}", unique=True)

    with scoped_conf(spark, STATE_STORE_CONF):
        return for_each_batch(cleaned, add, checkpoint, every, available_now)


def enrich_stream(
    events: DataFrame, items: DataFrame, rate: float = 0.1, keys: list[str] | None = None
) -> DataFrame:
    """Join the stream to the item dictionary and shed load, keeping every critical event."""
    flagged = flag_out_of_range(enrich_items(events, items))
    return critical_sample(flagged, F.col("is_critical"), rate, keys)


def drain(queries: list[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait for queries that end by themselves; re-raises their errors, False on a timeout."""
    done = True
    for query in queries:
        if timeout is None:
            query.awaitTermination()
        else:
            done = bool(query.awaitTermination(timeout)) and done
    return done


def drain_source(query: StreamingQuery) -> None:
    """Process what a source without an end of its own has now, then stop; re-raises errors."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_until_any_stops(spark: SparkSession, timeout: float | None = None) -> None:
    """Block a driver that hosts several continuous queries."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)
