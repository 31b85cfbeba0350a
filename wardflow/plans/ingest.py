"""Queries on streaming ingest: counters per batch, exact dedup, committed appends, compaction."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.clean import clean_chart_events
from ..operators.star import project
from ..schemas import WAREHOUSE_DDL
from ..session import materialise, work_path
from ..sinks.committed import CommittedTable
from ..sinks.streams import for_each_batch, publish_json, write_stream
from ..sinks.tables import create_tables, drop_tables, write_table
from ..sources import generators, messages, replay
from ..sources.readers import read_stream, read_table
from ..specs import register_query
from ..streaming import counters, jobs, monitor
from .catalog import EVENT_SPEC, MESSAGE_DDL, STAMP
from .views import ClinicalViews as Views

STAY_DDL = "stay_id BIGINT, subject_id BIGINT, intime_date INT"


def event_rows(v: Views) -> DataFrame:
    """Events in the columns of the message schema, as bronze holds them."""
    return v.chart_events.select(
        "event_id",
        "subject_id",
        "hadm_id",
        "stay_id",
        F.date_format("charttime", STAMP).alias("charttime"),
        F.lit("NaT").alias("storetime"),
        "itemid",
        "value",
        "valuenum",
        F.lit(" unit ").alias("valueuom"),
        F.when(F.col("warning") == 1, "1.0").otherwise("0.0").alias("warning"),
    )


def _weeks(rows: DataFrame) -> list[DataFrame]:
    """Events of the first to fourth week of January 2024 and of the days after."""
    week = F.least(F.floor((F.dayofmonth("charttime") - 1) / 7), F.lit(4))
    return [rows.filter(week == k) for k in range(5)]


@register_query("stream_delivery_counters")
def stream_delivery_counters(spark: SparkSession, path: str) -> DataFrame:
    """Sent, failed and bytes of every micro-batch of a stream that is stopped and started again.

    A week of messages arrives before each run, so that each run is one micro-batch.
    """
    root = work_path(spark, "delivery")
    broken = F.col("value").contains('"itemid":"error"')
    for week in _weeks(event_rows(Views(spark, path))):
        write_table(messages.encode_json(week, "stay_id"), f"{root}/topic")
        stream = read_stream(spark, f"{root}/topic", "key STRING, value STRING", max_files=1000)
        observed = counters.observe_delivery(stream, "delivery", ~broken)
        with counters.DeliveryCounters(spark, "delivery", f"{root}/counters") as listener:
            query = write_stream(observed, f"{root}/out", f"{root}/ck", available_now=True)
            jobs.drain([query])
            listener.wait([query])
    return counters.read_counters(spark, f"{root}/counters").drop("query_id")


@register_query("idempotent_append")
def idempotent_append(spark: SparkSession, path: str) -> DataFrame:
    """A table after two batches of which the second holds rows of the first and is sent twice."""
    stays = Views(spark, path).stays.select("stay_id", "subject_id", "intime_date")
    table = CommittedTable(f"{work_path(spark, 'committed')}/stays", STAY_DDL)
    table.append_new(stays.filter(F.col("intime_date") < 19980101), ["stay_id"], "load-0")
    for _ in range(2):
        table.append_new(stays, ["stay_id"], "load-1")
    return table.read(spark)


@register_query("stream_exact_dedup")
def stream_exact_dedup(spark: SparkSession, path: str) -> DataFrame:
    """Silver after three runs whose last one brings all messages of the first once more.

    State keeps no key longer than its run, so these copies are later than its horizon.
    """
    root = work_path(spark, "exact")
    silver = jobs.exact_silver_table(EVENT_SPEC, f"{root}/silver")
    rows = event_rows(Views(spark, path))
    early = F.col("charttime") < "2024-01-16"
    for part in (rows.filter(early), rows.filter(~early), rows.filter(early)):
        write_table(part.unionByName(part), f"{root}/bronze")
        query = jobs.bronze_to_silver_exact(
            spark, EVENT_SPEC, f"{root}/bronze", silver, f"{root}/ck", "events",
            recent="0 seconds", max_files=1000, available_now=True,
        )
        jobs.drain([query])
    return silver.read(spark).select(
        "event_id",
        "stay_id",
        F.col("charttime").cast("timestamp_ntz").alias("charttime"),
        "itemid",
        "valuenum",
        "valueuom",
        "warning",
    )


EVENT_DDL = "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE"


@register_query("replay_restart")
def replay_restart(spark: SparkSession, path: str) -> DataFrame:
    """Events replayed in order from CSV, through a failure in the middle of the third batch.

    The failing batch has handed on a part of its rows when it fails; the stream is started again
    and the table holds each row once.  ``in_order`` tells whether a batch never holds an event older
    than one of the batch before it.
    """
    root = work_path(spark, "replay")
    events = Views(spark, path).table("events").select("event_id", "user_id", "ts", "event_type", "value")
    ordered = events.repartitionByRange(3, "ts", "event_id").sortWithinPartitions("ts", "event_id")
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ordered.write.option("header", True).option("timestampNTZFormat", stamp).csv(f"{root}/csv")
    files = spark.read.format("binaryFile").load(f"{root}/csv/*.csv")
    size = files.agg(F.sum("length")).first()[0]
    ddl = f"{EVENT_DDL}, replay_file STRING, replay_byte BIGINT, batch BIGINT"
    table, failed = CommittedTable(f"{root}/events", ddl), []

    def add(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            write_table(rows.limit(5), f"{root}/handed-on")
            raise RuntimeError("lost in the middle of a batch")
        table.append(rows, f"replay-{batch_id}")

    for _ in range(2):
        lines = replay.replay_lines(spark, f"{root}/csv", f"{root}/positions", size // 7 + 1, size // 20 + 1)
        rows = replay.replay_csv(lines, EVENT_DDL, timestampNTZFormat=stamp)
        query = for_each_batch(rows, add, f"{root}/ck", every=None)
        try:
            jobs.drain_source(query)
        except StreamingQueryException as error:
            if "middle of a batch" not in str(error):
                raise
            spark.streams.resetTerminated()  # the failure is dealt with
    stored = table.read(spark)
    spans = stored.groupBy("batch").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    before = F.lag("last").over(Window.orderBy("batch"))
    spans = spans.select("batch", (F.coalesce(before <= F.col("first"), F.lit(True))).cast("int").alias("in_order"))
    return stored.join(spans, "batch").drop("batch", "replay_file", "replay_byte")


@register_query("compacted_events")
def compacted_events(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a month-partitioned table written in many small files, after compaction.

    ``files_left`` says whether the files are as many as packing to the target size allows at most.
    """
    month = F.date_format("charttime", "yyyyMM")
    rows = event_rows(Views(spark, path)).withColumn("month", month)
    table = CommittedTable(f"{work_path(spark, 'compact')}/events", MESSAGE_DDL, ["month"])
    for k, week in enumerate(_weeks(rows)):
        table.append(week.repartition(6), f"week-{k}")
    before = table.version(spark)
    size = table.files(spark).agg(F.sum("length")).first()[0]
    target = max(size // 3, 1)
    table.compact(spark, target)
    n_before = table.files(spark, before.folders).count()
    n_after, places = table.files(spark).agg(F.count("*"), F.count_distinct("place")).first()
    # Rewritten rows take about the bytes they took; each partition may add one file.
    fewer = n_after <= 4 + places and n_after < n_before
    counted = table.read(spark).groupBy("itemid", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("event_id").alias("ids"),
        F.round(F.sum("valuenum"), 4).alias("total"),
    )
    return counted.withColumn("files_left", F.lit("few" if fewer else f"{n_after} of {n_before}"))


def _event_files(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Events in four files by week of their month; their schema is that of the frame."""
    events = Views(spark, path).table("events")
    week = F.least(F.floor((F.dayofmonth("ts") - 1) / 7), F.lit(3))
    for k in range(4):
        write_table(events.filter(week == k).coalesce(1), f"{root}/events")
    return events


@register_query("stream_csv_rate")
def stream_csv_rate(spark: SparkSession, path: str) -> DataFrame:
    """Events through a CSV sink at one file a trigger; ``batches`` counts the triggers."""
    root = work_path(spark, "csv-sink")
    schema = _event_files(spark, path, root).schema
    stream = read_stream(spark, f"{root}/events", schema, max_files=1)
    query = write_stream(
        stream.drop("props"), f"{root}/out", f"{root}/ck", fmt="csv", every="0 seconds",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )
    jobs.drain_source(query)
    batches = sum(1 for p in query.recentProgress if p.numInputRows)
    ddl = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
    rows = read_table(spark, f"{root}/out", "csv", ddl)
    return rows.withColumn("batches", F.lit(batches).cast("long"))


@register_query("stream_two_queries")
def stream_two_queries(spark: SparkSession, path: str) -> DataFrame:
    """Two streams in one session until one of them ends; the other is then awaited in bounded time."""
    root = work_path(spark, "two")
    schema = _event_files(spark, path, root).schema
    queries = []
    spark.streams.resetTerminated()  # what ended before this job is not its concern
    for kind in ("click", "view"):
        stream = read_stream(spark, f"{root}/events", schema, max_files=2)
        picked = stream.filter(F.col("event_type") == kind)
        queries.append(write_stream(picked, f"{root}/{kind}", f"{root}/ck-{kind}", available_now=True))
    jobs.run_until_any_stops(spark, 600)
    if not jobs.drain(queries, 600):
        raise TimeoutError("a stream did not end")
    spark.streams.resetTerminated()
    both = spark.read.parquet(f"{root}/click").unionByName(spark.read.parquet(f"{root}/view"))
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register_query("stream_stamps")
def stream_stamps(spark: SparkSession, path: str) -> DataFrame:
    """Rows per item whose ingest stamp lies in their run, before their processing stamp."""
    root = work_path(spark, "stamps")
    write_table(messages.encode_json(event_rows(Views(spark, path)), "stay_id"), f"{root}/topic")
    started = datetime.now(UTC)
    stream = read_stream(spark, f"{root}/topic", "key STRING, value STRING", max_files=1000)
    jobs.drain(
        jobs.ingest_bronze(stream, EVENT_SPEC, f"{root}/bronze", f"{root}/ck", f"{root}/bad", available_now=True)
    )
    bronze = spark.read.parquet(f"{root}/bronze")
    cleaned = clean_chart_events(bronze)
    at = F.timestamp_millis(F.lit(int(started.timestamp() * 1000)))
    inside = (F.col("ingest_ts") >= at) & (F.col("ingest_ts") <= F.col("processed_timestamp"))
    return cleaned.groupBy("itemid").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("stamped_in_order")
    )


@register_query("keyed_topic")
def keyed_topic(spark: SparkSession, path: str) -> DataFrame:
    """A topic laid out by key: partitions per key, and messages that follow an older one of their key."""
    target = f"{work_path(spark, 'topic')}/messages"
    publish_json(event_rows(Views(spark, path)), "stay_id", target, order_col="charttime", partitions=6)
    stored = spark.read.parquet(target).select(
        "key", "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    time = F.get_json_object("value", "$.charttime")
    by_key = Window.partitionBy("key", "file").orderBy("place")
    late = stored.withColumn("late", (time < F.lag(time).over(by_key)).cast("int"))
    return late.groupBy("key").agg(
        F.count_distinct("file").alias("partitions"),
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"),
    )


@register_query("typed_tables")
def typed_tables(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a created table of the registered columns, filled and read by name, then dropped."""
    v, database = Views(spark, path), f"wardflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{work_path(spark, 'database')}'")
    ddl = WAREHOUSE_DDL["fact_icustays"]
    create_tables(spark, {f"{database}.fact_icustays": ddl})
    create_tables(spark, {f"{database}.fact_icustays": ddl})
    rows = project(v.stays, ddl)
    rows.write.insertInto(f"{database}.fact_icustays")
    kept = materialise(spark.table(f"{database}.fact_icustays"), "typed")
    drop_tables(spark, [f"{database}.fact_icustays"])
    # The list also has the session's views, whatever the database.
    left = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    spark.sql(f"DROP DATABASE {database}")
    return kept.withColumn("tables_left", F.lit(len(left)))


@register_query("source_schema")
def source_schema(spark: SparkSession, path: str) -> DataFrame:
    """Columns and types that a stream of the event table will have."""
    return monitor.schema_report(read_stream(spark, path, Views(spark, path).table("events").schema))


@register_query("literal_items")
def literal_items(spark: SparkSession, path: str) -> DataFrame:
    """Events per label of a small table of literal rows; items that it lacks are left out."""
    labels = generators.from_rows(spark, [("click", "Heart rate"), ("view", "SpO2"), ("none", "Unused")], "itemid STRING, label STRING")
    events = Views(spark, path).chart_events.groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    return events.join(labels, "itemid").select("label", "n")
