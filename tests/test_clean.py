"""Messages, cleaning and dedup."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wardflow.operators.clean import clean_chart_events, clean_micro_events
from wardflow.operators.dedup import dedup, top_per_key
from wardflow.schemas import SOURCE_DDL, WAREHOUSE_DDL, column_names, split_ddl
from wardflow.sources import messages

CHART = SOURCE_DDL["chartevents"]


def chart(**kw):
    base = dict(subject_id=1, hadm_id=10, stay_id=100, caregiver_id=7,
                charttime="2150-01-01T08:00:00", storetime="NaT", itemid=220045, value=" 80 ",
                valuenum=80.0, valueuom="bpm", warning="0.0")
    base.update(kw)
    return tuple(base[c] for c in column_names(CHART))


def test_ddl_helpers():
    for ddl in [*SOURCE_DDL.values(), *WAREHOUSE_DDL.values()]:
        assert ", ".join(f"{n} {t}" for n, t in split_ddl(ddl)) == ddl


def test_decode_keeps_bad_messages(spark, rows):
    good = json.dumps(dict(zip(column_names(CHART), chart())))
    nan = '{"subject_id": 2, "stay_id": 3, "itemid": 4, "charttime": "x", "valuenum": NaN}'
    wrong = '{"subject_id": "abc", "stay_id": 3}'
    cut = good[:-1]
    df = spark.createDataFrame([(good,), (nan,), (wrong,), (cut,), (None,)], "value STRING")
    split = messages.decode_json(df, CHART)
    assert [r["subject_id"] for r in split.good.orderBy("subject_id").collect()] == [1, 2]
    assert {r["raw"] for r in split.bad.collect()} == {wrong, cut, None}


def test_encode_decode_roundtrip(spark, rows):
    df = spark.createDataFrame([chart(), chart(stay_id=None, value=None)], CHART)
    encoded = messages.encode_json(df, "stay_id")
    assert {r["key"] for r in encoded.collect()} == {"100", None}
    assert rows(messages.decode_json(encoded, CHART).good) == rows(df)


def test_normalise_rows(spark):
    df = spark.createDataFrame(
        [("12.0", "NaN", "NaT", "2150-01-01 01:02:03"), ("x", "1.5", "ok", "soon")],
        "itemid STRING, valuenum STRING, valueuom STRING, charttime STRING",
    )
    ddl = "itemid INT, valuenum DOUBLE, valueuom STRING, charttime STRING, warning INT"
    out = [tuple(r) for r in messages.normalise_rows(df, ddl, ("charttime",)).collect()]
    assert out == [
        (12, None, None, "2150-01-01T01:02:03", None),
        (None, 1.5, "ok", "soon", None),
    ]


def test_validation_routes_null_to_bad(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x INT")
    split = messages.validate_rows(df, F.col("x") > 0)
    assert split.good.count() == 1 and split.bad.count() == 2


@pytest.mark.parametrize("gap", ["subject_id", "stay_id", "itemid", "charttime"])
def test_clean_drops_incomplete_keys(spark, gap):
    df = spark.createDataFrame([chart(), chart(**{gap: None})], CHART)
    assert clean_chart_events(df).count() == 1


def test_clean_types_and_trims(spark):
    df = spark.createDataFrame(
        [
            chart(itemid=1, warning="1.0"),
            chart(itemid=2, value="   ", valueuom="", warning="NaN", valuenum=float("nan")),
            chart(itemid=3, charttime="NaT", warning=None),
        ],
        CHART,
    )
    out = {r["itemid"]: r for r in clean_chart_events(df).collect()}
    assert out[1]["charttime"] == dt.datetime(2150, 1, 1, 8)
    assert (out[1]["value"], out[1]["warning"]) == ("80", 1)
    assert (out[2]["value"], out[2]["valueuom"], out[2]["valuenum"], out[2]["warning"]) == (
        None, None, None, None)
    assert out[3]["charttime"] is None
    assert out[1]["processed_timestamp"] is not None


def test_clean_dedups_on_null_hadm_and_is_idempotent(spark, rows):
    df = spark.createDataFrame(
        [chart(hadm_id=None), chart(hadm_id=None, value="other"), chart(hadm_id=9)], CHART
    )
    once = clean_chart_events(df, order_by=[F.col("value")])
    assert once.count() == 2
    again = clean_chart_events(once.drop("processed_timestamp"), order_by=[F.col("value")])
    assert rows(again.drop("processed_timestamp")) == rows(once.drop("processed_timestamp"))


def test_clean_empty(spark):
    assert clean_chart_events(spark.createDataFrame([], CHART)).count() == 0


def test_clean_micro(spark):
    ddl = "microevent_id INT, charttime TIMESTAMP, org_name STRING"
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (None, None, "c")], ddl)
    assert [r["org_name"] for r in clean_micro_events(df, [F.col("org_name")]).collect()] == ["a"]


def test_dedup_hot_key_is_reduced_before_the_shuffle(spark, plan_of):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = dedup(df, ["k"], [F.col("v").desc()])
    assert {tuple(r) for r in out.collect()} == {(0, 9999), (1, 9997), (2, 9998)}
    assert "Partial" in plan_of(out) and "WindowGroupLimit" in plan_of(out)
    assert "WindowGroupLimit" in plan_of(top_per_key(df, ["k"], [F.col("v")], 3))


def test_topic_layout_keeps_keys_together(spark):
    df = spark.range(1000).select((F.col("id") % 17).alias("k"), (-F.col("id")).alias("ts"))
    laid = messages.for_ordered_topic(df, "k", "ts", 6)
    assert laid.rdd.getNumPartitions() == 6
    seen = laid.select("k", F.spark_partition_id().alias("p")).distinct()
    assert seen.count() == 17
