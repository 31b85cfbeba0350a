"""Physical plans: pruned scans, pushed filters, JVM-only work, no joins without keys."""

import os
import re

import pytest
from conftest import TESTDATA
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardflow.plans import warehouse
from wardflow.plans.views import ClinicalViews
from wardflow.specs import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")

# These run jobs of their own while they are built; the rest is lazy.
EAGER = {"incremental_load", "trained_risk", "table_profile", "sample_systematic", "insert_absent"}
EAGER |= {"trained_stay_class", "boosted_stay_class", "compacted_events", "idempotent_append", "replay_restart"}
EAGER |= {n for n in QUERIES if n.startswith("load_") and n != "load_report"}
LAZY = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in EAGER)


@pytest.fixture
def no_auto_broadcast(spark):
    """As if every table were large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_plan_scales(no_auto_broadcast, plan_of, name):
    plan = plan_of(entry.queries()[name](no_auto_broadcast, TESTDATA))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan, node
    # Without a size that allows it, only the calendars are broadcast.
    if "BroadcastHashJoin" in plan:
        for side in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan):
            assert re.search("intime_date|charttime_date|charttime_time", side), side


@pytest.mark.parametrize(
    "name, columns",
    [
        ("stays_by_year", {"o_orderkey", "o_orderdate"}),
        ("stays_by_unit", {"o_orderkey", "o_orderpriority"}),
        ("demographics", {"c_acctbal", "c_mktsegment"}),
        ("sample_hash", {"event_id", "ts", "user_id", "event_type", "value"}),
    ],
)
def test_scans_read_needed_columns_only(spark, plan_of, name, columns):
    plan = plan_of(entry.queries()[name](spark, TESTDATA))
    read = set()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        read |= {field.split(":")[0] for field in schema.split(",")}
    assert read == columns


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("hourly_vitals", "EqualTo(event_type,click)"),
        ("incremental_window", "GreaterThan(ts,"),
        ("stays_by_unit", "IsNotNull(o_orderpriority)"),
        ("fluid_balance", "Not(EqualTo(l_returnflag,N))"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    df = entry.queries()[name](spark, TESTDATA)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert pushed in text


def test_hot_key_joins_shuffle_on_a_lane(no_auto_broadcast, plan_of):
    plan = plan_of(entry.queries()["stay_features"](no_auto_broadcast, TESTDATA))
    assert re.search(r"hashpartitioning\(coalesce\(stay_id#\d+L?, 0\), isnull\(stay_id#\d+L?\), _lane", plan)


def test_views_read_no_data(spark):
    views = ClinicalViews(spark, TESTDATA)
    views.register()
    assert spark.table("clinical_stays").columns == views.stays.columns


def test_micro_source_shuffles_and_sorts_its_lines_once(no_auto_broadcast, plan_of):
    plan = plan_of(warehouse.micro(ClinicalViews(no_auto_broadcast, TESTDATA)))
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert plan.count("Sort [l_orderkey") == 1


def test_silver_computes_its_source_once(spark):
    source = warehouse.micro(ClinicalViews(spark, TESTDATA)).limit(50)
    seen = Observation("micro-source")
    folder = warehouse.silver(
        spark, "hosp_microbiologyevents", source.observe(seen, F.count(F.lit(1)).alias("n")), "charttime", copies=2
    )
    bronze = spark.read.parquet(folder.removesuffix("silver") + "bronze")
    assert seen.get["n"] == 50 and bronze.count() == 100
    assert spark.read.parquet(folder).count() == bronze.select("microevent_id").dropna().distinct().count()


def test_typed_tables_counts_no_views_of_the_session(spark):
    spark.range(1).createOrReplaceTempView("view_of_the_session")
    try:
        left = entry.queries()["typed_tables"](spark, TESTDATA).select("tables_left").distinct().collect()
    finally:
        spark.catalog.dropTempView("view_of_the_session")
    assert [r["tables_left"] for r in left] == [0]
