"""Sampling methods: sizes, guarantees and independence of the partitioning."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardflow.operators import sampling


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(20000).select(
        F.col("id"),
        (F.col("id") % 40).alias("stay_id"),
        F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.col("id") % 50 == 0).alias("hot"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("day"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 977).cast("timestamp_ntz").alias("ts"),
    )


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


@pytest.mark.parametrize("method", ["uniform", "random", "stratified"])
def test_share_and_stability(events, method):
    kw = {"keys": ["id"], "stratum": F.col("day")}
    once = ids(sampling.sample(events, method, 0.1, **kw))
    again = ids(sampling.sample(events.repartition(13), method, 0.1, **kw))
    other = ids(sampling.sample(events, method, 0.1, seed=1, **kw))
    assert once == again and once != other
    assert abs(len(once) / 20000 - 0.1) < 0.01


def test_rate_bounds(events):
    assert sampling.uniform_sample(events, 0.0, ["id"]).count() == 0
    assert sampling.uniform_sample(events, 1.0, ["id"]).count() == 20000


def test_random_without_keys(events):
    assert 0 < sampling.random_sample(events, 0.1).count() < 20000


def test_critical_rows_all_stay(events):
    kept = sampling.critical_sample(events, F.col("hot"), 0.1, ["id"])
    critical = events.filter("hot")
    assert ids(critical) <= ids(kept)
    rest = kept.filter("not coalesce(hot, false)").count()
    assert abs(rest / (20000 - critical.count()) - 0.1) < 0.01


def test_hash_keeps_whole_entities(events):
    kept = sampling.hash_sample(events, "stay_id", 4)
    assert 0 < kept.count() < 20000
    per = kept.groupBy("stay_id").count().collect()
    assert all(r["count"] == 500 for r in per)
    fast = F.abs(F.hash("stay_id").cast("bigint")) % 4 == 0
    assert ids(events.filter(fast)) == ids(kept)


def test_strata_have_equal_shares(events):
    kept = sampling.stratified_sample(events, F.col("day"), 0.2, ["id"])
    for r in kept.groupBy("day").count().collect():
        assert abs(r["count"] / (20000 / 7) - 0.2) < 0.04


def test_strata_with_named_shares_and_null_stratum(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("s"))
    kept = sampling.stratified_sample(df, F.col("s"), {1: 1.0, 2: 0.5}, ["id"])
    n = {r["s"]: r["count"] for r in kept.groupBy("s").count().collect()}
    assert n[1] == 1000 and 400 < n[2] < 600 and None not in n
    assert sampling.stratified_sample(df, F.col("s"), 1.0, ["id"]).count() == 3000


@settings(max_examples=4, deadline=None)
@given(st.integers(1, 400), st.integers(1, 25), st.integers(1, 9))
def test_systematic_equals_global_order(spark, n, step, partitions):
    df = spark.range(n).select(
        "id", F.pmod(F.hash("id"), F.lit(9)).alias("t"), F.lit("x").alias("payload")
    )
    got = ids(sampling.systematic_sample(df, 1 / step, ["t", "id"], partitions))
    rn = F.row_number().over(Window.orderBy("t", "id"))
    actual_step = int(1 / (1 / step))
    want = ids(df.withColumn("rn", rn).filter(F.col("rn") % actual_step == 0))
    assert got == want and len(got) == n // actual_step


def test_systematic_with_one_timestamp_for_most_rows(spark, events):
    """A time stamp shared by most rows is split by the second order column."""
    skewed = events.withColumn("ts", F.when(F.col("id") < 15000, F.lit("2024-01-01")).otherwise(
        F.lit("2024-01-02")).cast("timestamp_ntz"))
    numbered = sampling.number_rows(skewed, ["ts", "id"], "n", partitions=8)
    assert {r["id"] + 1 == r["n"] for r in numbered.collect()} == {True}
    assert numbered.rdd.getNumPartitions() > 1


def test_systematic_empty_and_bad_rate(spark, events):
    assert sampling.systematic_sample(events.limit(0), 0.1, ["id"]).count() == 0
    with pytest.raises(ValueError):
        sampling.systematic_sample(events, 0, ["id"])


def test_unknown_method_keeps_everything(events):
    assert sampling.sample(events, "none").count() == 20000
    assert sampling.sample(events, "whatever").count() == 20000
