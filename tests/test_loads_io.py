"""Readers, writers, incremental and dimension loads, streams."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from wardflow import session
from wardflow.operators import incremental
from wardflow.operators.star import key_clean
from wardflow.plans import loads
from wardflow.schemas import SOURCE_DDL, WAREHOUSE_DDL, column_names
from wardflow.sinks import streams, tables
from wardflow.sources import generators, readers
from wardflow.specs import DIMS, FACTS, FactSpec, register_query, QUERIES
from wardflow.streaming import jobs, monitor

CHART = SOURCE_DDL["chartevents"]
SPEC = FACTS["icu_chartevents"]


def chart_rows(spark, n, start=0, minutes=1):
    t0 = dt.datetime(2150, 1, 1)
    data = [
        (i % 5, 1, i % 5, None, (t0 + dt.timedelta(minutes=minutes * i)).isoformat(), "NaT",
         220045, f" {i} ", float(i), "bpm", "0.0")
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(data, CHART)


def silver_rows(spark, n, start, stamp):
    df = SPEC.clean(chart_rows(spark, n, start), stamp=F.lit(stamp).cast("timestamp"))
    return df


def test_csv_by_header_and_wrong_order_fails(spark, tmp_path, rows):
    path = str(tmp_path / "d.csv")
    with open(path, "w") as f:
        f.write("icd_code,icd_version,long_title\nA,9,alpha\n")
    ddl = SOURCE_DDL["d_icd_diagnoses"]
    assert rows(readers.read_table(spark, path, "csv", ddl)) == [("A", 9, "alpha")]
    with pytest.raises(Exception, match="header"):
        readers.read_table(spark, path, "csv", "icd_version INT, icd_code STRING, long_title STRING").collect()


def test_profile_and_preview(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x INT, y STRING")
    got = {r["column_name"]: tuple(r)[1:] for r in readers.profile(df).collect()}
    assert got == {"x": ("int", 1, "1", "1"), "y": ("string", 2, "a", "b")}
    path = str(tmp_path / "p")
    df.coalesce(1).write.option("header", True).csv(path)
    assert readers.preview(spark, path, 1, 1.0).count() == 1


def test_profile_tells_the_zeros_apart(spark):
    for order in ([0.0, -0.0, None], [None, -0.0, 0.0]):
        df = spark.createDataFrame([(x, x) for x in order], "x DOUBLE, y FLOAT").coalesce(1)
        assert [tuple(r)[2:] for r in readers.profile(df).collect()] == [(2, "-0.0", "0.0")] * 2
    ends = readers.profile(spark.createDataFrame([(2.5, None), (float("nan"), None)], "x DOUBLE, y DOUBLE"))
    assert [tuple(r)[2:] for r in ends.collect()] == [(2, "2.5", "NaN"), (0, None, None)]


def test_null_normalised(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x DOUBLE, y STRING")
    assert [r["x"] for r in readers.null_normalised(df).collect()] == [None, 1.0]


def test_query_with_parameters(spark):
    spark.range(10).createOrReplaceTempView("ten")
    got = readers.read_query(spark, "SELECT id FROM ten WHERE id > :n", args={"n": 7})
    assert got.count() == 2


def test_connector_options():
    batch = readers.kafka_options("b:9092", "t", "earliest", "latest")
    assert batch["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in batch
    capped = readers.kafka_options("b:9092", "t", max_per_trigger=50)
    assert capped["maxOffsetsPerTrigger"] == "50" and capped["startingOffsets"] == "earliest"
    jdbc = tables.jdbc_options("jdbc:x", "t", "u", "p", "d")
    assert jdbc["batchsize"] == "1000" and int(jdbc["numPartitions"]) > 1


def test_write_table_refuses_streams(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="write_stream"):
        tables.write_table(stream, "/nowhere")


def test_table_registry(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ward_test")
    spark.catalog.setCurrentDatabase("ward_test")
    try:
        some = {n: WAREHOUSE_DDL[n] for n in ("dim_time", "fact_icustays")}
        tables.create_tables(spark, some)
        tables.create_tables(spark, some)
        found = {r["table_name"]: r["column_count"] for r in
                 tables.catalog_inventory(spark, "ward_test").collect()}
        assert found == {"dim_time": 5, "fact_icustays": 10}
        spark.sql("INSERT INTO ward_test.dim_time VALUES (0, '00:00:00', 0, 0, 0)")
        sizes = {r["table_name"]: r["size_bytes"] for r in
                 tables.catalog_inventory(spark, "ward_test").collect()}
        assert sizes["dim_time"] > 0 and sizes["fact_icustays"] == 0
        tables.drop_tables(spark, list(some))
        assert tables.catalog_inventory(spark, "ward_test").count() == 0
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE ward_test CASCADE")


def test_window_is_half_open_and_tiles(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(x,) for x in t], "ts timestamp_ntz")
    first = incremental.read_since(df, "ts", t[0], t[1])
    second = incremental.read_since(df, "ts", first.hi)
    assert [r["ts"] for r in first.rows.collect()] == [t[1]]
    assert [r["ts"] for r in second.rows.collect()] == [t[2]] and second.hi == t[2]
    third = incremental.read_since(df, "ts", second.hi)
    assert third.hi == second.hi and third.rows.count() == 0


def test_marks_are_versioned(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert incremental.load_mark(spark, path, "a") == (incremental.FIRST_MARK, 0)
    incremental.save_mark(spark, path, "a", dt.datetime(2024, 1, 1))
    incremental.save_mark(spark, path, "b", dt.datetime(2023, 1, 1))
    incremental.save_mark(spark, path, "a", dt.datetime(2024, 2, 1))
    assert incremental.load_mark(spark, path, "a") == (dt.datetime(2024, 2, 1), 2)


def test_fact_load_is_incremental_and_repeatable(spark, tmp_path):
    silver, target, marks = (str(tmp_path / n) for n in ("silver", "fact", "marks"))
    tables.write_table(silver_rows(spark, 10, 0, "2024-01-01 10:00:00"), silver)
    report = loads.load_fact(spark, SPEC, silver, target, marks).first()
    assert (report["status"], report["rows_read"], report["rows_written"]) == ("loaded", 10, 10)
    assert loads.last_mark(spark, marks, SPEC) == dt.datetime(2024, 1, 1, 10)
    assert loads.load_fact(spark, SPEC, silver, target, marks).first()["status"] == "empty"
    tables.write_table(silver_rows(spark, 5, 10, "2024-01-02 10:00:00"), silver)
    # A run that wrote its rows and crashed before saving its mark.
    shutil.copytree(marks, tmp_path / "unsaved")
    loads.load_fact(spark, SPEC, silver, target, str(tmp_path / "unsaved"))
    loads.load_fact(spark, SPEC, silver, target, marks)
    facts = spark.read.parquet(target).drop("load_id")
    assert facts.columns == column_names(WAREHOUSE_DDL["fact_chartevents"])
    assert facts.filter("valuenum >= 10").count() == 5


def test_crashed_run_is_replaced(spark, tmp_path):
    silver, target = str(tmp_path / "silver"), str(tmp_path / "fact")
    tables.write_table(silver_rows(spark, 10, 0, "2024-01-01 10:00:00"), silver)
    loads.load_fact(spark, SPEC, silver, target, str(tmp_path / "m1"))
    tables.write_table(silver_rows(spark, 3, 10, "2024-01-01 11:00:00"), silver)
    loads.load_fact(spark, SPEC, silver, target, str(tmp_path / "m2"))
    assert spark.read.parquet(target).count() == 13


def test_fact_load_gate_and_sampling(spark, tmp_path):
    silver, target, marks = (str(tmp_path / n) for n in ("silver", "fact", "marks"))
    rows = silver_rows(spark, 100, 0, "2024-01-01 10:00:00")
    bad = rows.withColumn("charttime", F.when(F.col("valuenum") >= 10, F.col("charttime")))
    tables.write_table(bad, silver)
    report = loads.load_fact(spark, SPEC, silver, target, marks).first()
    assert (report["rows_written"], report["rows_rejected"]) == (90, 10)
    for method, order in (("stratified_time", None), ("systematic", ["valuenum"]), ("random", None)):
        kw = {"order": order} if order else {}
        r = loads.load_fact(spark, SPEC, silver, str(tmp_path / method), str(tmp_path / f"m{method}"),
                            method=method, rate=0.5, **kw).first()
        assert r["rows_read"] == 100 and 25 <= r["rows_sampled"] <= 75
        if method == "systematic":
            assert r["rows_sampled"] == 50


def test_fact_load_by_month_prunes(spark, tmp_path, plan_of):
    silver, target, marks = (str(tmp_path / n) for n in ("silver", "fact", "marks"))
    rows = SPEC.clean(chart_rows(spark, 60, minutes=1440), stamp=F.lit("2024-01-01").cast("timestamp"))
    tables.write_table(rows, silver)
    report = loads.load_fact(spark, SPEC, silver, target, marks, month_of="charttime_date").first()
    assert report["rows_written"] == 60
    facts = spark.read.parquet(target)
    january = facts.filter("month = 215001")
    assert january.count() == 31 and facts.count() == 60
    assert "PartitionFilters: [isnotnull(month" in plan_of(january)


def test_key_clean_is_deterministic(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (None, "x")], "k INT, v STRING")
    assert rows(key_clean(df, ["k"])) == [(1, "a")]


def test_dimension_loads_isolate_failures(spark, tmp_path):
    def csv(name, text):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        return str(path)

    stay_head = ",".join(column_names(SOURCE_DDL["icustays"]))
    paths = {
        "d_items": csv("d_items", ",".join(column_names(SOURCE_DDL["d_items"])) +
                       "\n1,HR,HR,c,V,bpm,N,60,100\n1,HR,HR,c,V,bpm,N,60,100\n,x,x,c,V,b,N,,\n"),
        "icustays": csv("icustays", stay_head +
                        "\n1,2,3,A,B,2150-01-01 01:00:00,2150-01-02 00:00:10,1.0\n"),
        "diagnoses_icd": csv("dx", "subject_id,hadm_id,seq_num,icd_code,icd_version\n"
                             "1,2,3,A,9\n1,3,1,A,9\n"),
        "d_icd_diagnoses": csv("dd", "icd_code,icd_version,long_title\nA,9,alpha\nB,9,beta\n"),
        "patients": str(tmp_path / "missing.csv"),
    }
    names = ("d_items", "icustays", "patients")
    wanted = {"dim_d_items", "fact_icustays", "dim_patients", "dim_diagnoses_icd"}
    specs = {n: s for n, s in DIMS.items() if n in wanted}
    assert names and set(specs) == wanted
    report = {r["table_name"]: r for r in
              loads.load_dims(spark, specs, paths, str(tmp_path / "wh")).collect()}
    assert report["dim_patients"]["status"] == "failed" and report["dim_patients"]["error"]
    assert (report["dim_d_items"]["rows_read"], report["dim_d_items"]["rows_written"]) == (3, 1)
    stay = spark.read.parquet(str(tmp_path / "wh/fact_icustays")).first()
    assert (stay["intime_date"], stay["intime_time"], stay["outtime_time"]) == (21500101, 3600, 10)
    dx = spark.read.parquet(str(tmp_path / "wh/dim_diagnoses_icd")).collect()
    assert [(r["icd_code"], r["seq_num"], r["long_title"]) for r in dx] == [("A", 1, "alpha")]


def test_every_dimension_spec_builds_its_columns(spark):
    for spec in DIMS.values():
        sources = {n: spark.createDataFrame([], ddl) for n, ddl in spec.sources.items()}
        built = loads.dim_rows(spec, sources)
        assert built.columns == column_names(spec.target_ddl)


def test_fact_specs_cover_their_columns(spark):
    for spec in FACTS.values():
        silver = spec.clean(spark.createDataFrame([], spec.source_ddl))
        assert loads.fact_rows(silver, spec).columns == column_names(spec.target_ddl)
        assert isinstance(spec, FactSpec)


def test_register_query_decorator(spark):
    @register_query("_probe")
    def probe(spark, path):
        return spark.range(1)

    assert QUERIES.pop("_probe") is probe


def test_shared_root_honours_session(spark):
    root = session.shared_root(spark)
    assert session.work_path(spark, "x").startswith(root)
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


# --- streams -----------------------------------------------------------------------------


def _publish(spark, df, topic):
    streams.publish_json(df, "stay_id", topic, "charttime", partitions=3)


def _messages(spark, topic, cap=1):
    return readers.read_stream(spark, topic, "key STRING, value STRING", max_files=cap)


def test_stream_equals_batch_across_restart(spark, tmp_path, rows):
    topic, bronze, silver, ck = (str(tmp_path / n) for n in ("topic", "bronze", "silver", "ck"))

    def run():
        jobs.drain(jobs.ingest_bronze(_messages(spark, topic), SPEC, bronze, ck, f"{ck}-bad", available_now=True))
        jobs.drain([jobs.bronze_to_silver(spark, SPEC, bronze, silver, f"{ck}/s", HORIZON, available_now=True)])

    _publish(spark, chart_rows(spark, 30), topic)
    run()
    # Redelivery of old rows, within and across files, plus new ones.
    _publish(spark, chart_rows(spark, 40).unionByName(chart_rows(spark, 40)), topic)
    run()
    got = spark.read.parquet(silver)
    assert got.count() == 40
    with open(f"{ck}/s/offsets/0") as f:
        assert "RocksDB" in f.read()
    assert "RocksDB" not in (spark.conf.get(
        "spark.sql.streaming.stateStore.providerClass", None) or "")
    batch = SPEC.clean(chart_rows(spark, 40))
    columns = column_names(CHART)
    assert rows(got.select(columns)) == rows(batch.select(columns))


HORIZON = ("charttime", "1 day")


def test_stream_dedup_horizon_on_registered_spec(spark, tmp_path):
    """The event time is text in the source; unreadable times are kept."""
    path = str(tmp_path / "in")
    unread = chart_rows(spark, 1).withColumn("charttime", F.lit("NaT"))
    stamped = chart_rows(spark, 20)
    stamped.unionByName(stamped).unionByName(unread).write.parquet(path)
    stream = readers.read_stream(spark, path, CHART)
    query = streams.write_memory(SPEC.clean(stream, horizon=("charttime", "1 hour")), "horizon_out")
    query.awaitTermination()
    assert spark.table("horizon_out").count() == 21


def test_stream_dedup_moves_the_time_of_micro_events_once(spark, tmp_path):
    spec = FACTS["hosp_microbiologyevents"]
    spark.createDataFrame([], spec.source_ddl).write.parquet(str(tmp_path / "in"))
    stream = readers.read_stream(spark, str(tmp_path / "in"), spec.source_ddl)
    plan = spec.clean(stream, horizon=HORIZON)._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan and "_event_time" not in plan


def test_micro_stream(spark, tmp_path):
    spec = FACTS["hosp_microbiologyevents"]
    names = column_names(spec.source_ddl)
    row = {"microevent_id": 1, "subject_id": 2, "charttime": dt.datetime(2150, 1, 1, 10)}
    rows = [tuple(({**row, "microevent_id": i}).get(n) for n in names) for i in (1, 1, 2, None)]
    path, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    spark.createDataFrame(rows, spec.source_ddl).write.parquet(path)
    jobs.drain([jobs.bronze_to_silver(spark, spec, path, silver, str(tmp_path / "ck"), HORIZON, available_now=True)])
    got = spark.read.parquet(silver)
    assert sorted(r["microevent_id"] for r in got.collect()) == [1, 2]
    assert dict(got.dtypes)["charttime"] == "timestamp"


def test_marks_are_instants(spark, tmp_path):
    """Over the hour that autumn repeats, every row is read once."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = 1730613000  # 01:50 in summer time, ten minutes before the clock goes back
        rows = spark.createDataFrame([(i, base + i * 1200) for i in range(5)], "id INT, s BIGINT")
        df = rows.select("id", F.timestamp_seconds("s").alias("ts"))
        path, seen = str(tmp_path / "marks"), []
        for upto in (2, 2, 5):
            lo, _ = incremental.load_mark(spark, path, "t")
            window = incremental.read_since(df.filter(F.col("id") < upto), "ts", lo)
            seen += sorted(r["id"] for r in window.rows.collect())
            incremental.save_mark(spark, path, "t", window.hi)
        assert seen == [0, 1, 2, 3, 4]
        with pytest.raises(ValueError):
            incremental.save_mark(spark, path, "t", incremental.FIRST_MARK)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_broken_marks_are_no_first_run(spark, tmp_path):
    (tmp_path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        incremental.load_mark(spark, str(tmp_path), "t")


def test_stream_quarantine(spark, tmp_path):
    topic = str(tmp_path / "topic")
    good = chart_rows(spark, 5)
    _publish(spark, good, topic)
    spark.createDataFrame([("1", "{broken")], "key STRING, value STRING").write.mode("append").parquet(topic)
    bad = str(tmp_path / "bad")
    jobs.drain(jobs.ingest_bronze(_messages(spark, topic, None), SPEC, str(tmp_path / "b"),
                                  str(tmp_path / "ck"), bad, available_now=True))
    assert [r["raw"] for r in spark.read.parquet(bad).collect()] == ["{broken"]
    assert spark.read.parquet(str(tmp_path / "b")).count() == 5


def test_enrich_stream_keeps_critical(spark, tmp_path):
    path = str(tmp_path / "events")
    events = spark.range(1000).select(
        F.col("id").alias("event_id"), (F.col("id") % 3).cast("int").alias("itemid"),
        (F.col("id") % 200).cast("double").alias("valuenum"))
    events.write.parquet(path)
    items = spark.createDataFrame(
        [(0, "HR", 60.0, 100.0), (1, "RR", None, None)],
        "itemid INT, label STRING, lownormalvalue DOUBLE, highnormalvalue DOUBLE")
    stream = readers.read_stream(spark, path, events.schema)
    out = jobs.enrich_stream(stream, items, 0.1, ["event_id"])
    q = streams.write_stream(out, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    jobs.drain([q])
    got = spark.read.parquet(str(tmp_path / "out"))
    critical = events.filter("itemid = 0 and (valuenum < 60 or valuenum > 100)").count()
    assert got.filter("is_critical").count() == critical
    assert got.filter("itemid = 2 and label is not null").count() == 0
    assert got.count() < 1000


def test_csv_and_console_sinks(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(5).write.parquet(path)
    stream = readers.read_stream(spark, path, "id BIGINT")
    q = streams.write_stream(stream, str(tmp_path / "csv"), str(tmp_path / "ck"), "csv",
                             available_now=True)
    jobs.drain([q])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 5
    shown = streams.write_console(stream, "1 second", str(tmp_path / "ck2"))
    shown.processAllAvailable()
    assert not jobs.drain([shown], timeout=1)
    shown.stop()
    assert streams.trigger_args("10 seconds", False) == {"processingTime": "10 seconds"}


def test_monitor_totals(spark, tmp_path):
    src, metrics, ck = (str(tmp_path / n) for n in ("in", "metrics", "ck"))
    ddl = CHART
    chart_rows(spark, 10).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = readers.read_stream(spark, src, ddl, max_files=1)
        jobs.drain([monitor.monitor(stream, metrics, ck, available_now=True)])

    run()
    chart_rows(spark, 7, start=10).coalesce(1).write.mode("append").parquet(src)
    run()
    got = [tuple(r) for r in monitor.read_metrics(spark, metrics)
           .select("batch_id", "row_count", "total_rows").orderBy("batch_id").collect()]
    assert got == [(0, 10, 10), (1, 7, 17)]
    last = monitor.read_metrics(spark, metrics).filter("batch_id = 1").first()
    assert last["newest_time"] == "2150-01-01T00:16:00" and last["newest_sample"].count("\n") == 2


def test_monitor_writes_times_of_one_width(spark, tmp_path):
    metrics, times = str(tmp_path / "metrics"), ["2024-01-01 00:00:05", "2024-01-01 00:00:05.26"]
    for batch, time in enumerate(times):
        df = spark.range(1).select(F.lit(time).cast("timestamp_ntz").alias("ts"))
        tables.write_table(df, str(tmp_path / "in"))
        stream = readers.read_stream(spark, str(tmp_path / "in"), "ts TIMESTAMP_NTZ")
        query = monitor.monitor(stream, metrics, str(tmp_path / "ck"), time_col="ts", available_now=True)
        jobs.drain([query])
    found = monitor.read_metrics(spark, metrics).orderBy("batch_id").collect()
    assert [r["newest_time"] for r in found] == ["2024-01-01 00:00:05.000000", "2024-01-01 00:00:05.260000"]


def test_schema_report_and_delivery(spark, tmp_path):
    report = monitor.schema_report(spark.createDataFrame([], CHART))
    assert report.count() == 11
    df = spark.createDataFrame([("é", True), ("ab", None)], "value STRING, ok BOOLEAN")
    assert tuple(monitor.delivery_counters(df, F.col("ok")).first()) == (1, 1, 2)


def test_literal_rows(spark):
    assert generators.from_rows(spark, [(1, "a")], "x INT, y STRING").count() == 1


def test_dim_counters_and_swap(spark, tmp_path):
    """Grouped rows are not refused ones; every source counts; a failed load keeps the old table."""
    spec, root = DIMS["dim_diagnoses_icd"], str(tmp_path)
    files = {
        "diagnoses_icd": [(1, 1, 1, "A", 9), (1, 1, 2, "A", 9), (2, 2, 1, "B", 9), (3, 3, 4, "B", 9)],
        "d_icd_diagnoses": [("A", 9, "x"), ("B", 9, "y"), ("C", 9, "z")],
    }
    paths = {n: f"{root}/{n}" for n in files}
    for n, data in files.items():
        spark.createDataFrame(data, SOURCE_DDL[n]).write.option("header", True).csv(paths[n])
    for _ in range(2):
        report = loads.load_dims(spark, {spec.table: spec}, paths, f"{root}/wh").first()
        assert (report["rows_read"], report["rows_written"], report["rows_rejected"]) == (7, 2, 0)
    bad = loads.load_dims(spark, {spec.table: spec}, {**paths, "d_icd_diagnoses": "/none"}, f"{root}/wh").first()
    assert bad["status"] == "failed" and len(bad["error"]) > 10
    assert spark.read.parquet(f"{root}/wh/{spec.table}").count() == 2


def test_several_queries_wait_for_any(spark, tmp_path):
    src = str(tmp_path / "src")
    chart_rows(spark, 5).write.parquet(src)
    stream = readers.read_stream(spark, src, CHART)
    for name in ("a", "b"):
        streams.write_stream(stream, str(tmp_path / name), str(tmp_path / f"ck-{name}"), available_now=True)
    jobs.run_until_any_stops(spark, 60)
    for query in spark.streams.active:
        query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 5


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="shared folder"):
        session.shared_root(Session())
