"""Percentiles, joins, star building and quality gates."""

import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.operators import quality, star
from wardflow.operators.joins import heavy_keys, spread_join
from wardflow.operators.quantiles import exact_percentile
from wardflow.sinks.tables import insert_absent


@pytest.mark.parametrize("cells", [1, 1000])
@settings(max_examples=4, deadline=None)
@given(
    pairs=st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.integers(-50, 50).map(lambda i: i / 4)),
        ),
        min_size=1,
        max_size=200,
    )
)
def test_median_is_exact(spark, cells, pairs):
    df = spark.createDataFrame(pairs, "k STRING, v DOUBLE")
    got = {r["k"]: r["m"] for r in exact_percentile(df, ["k"], "v", 0.5, "m", cells).collect()}
    want = {}
    for key in {k for k, v in pairs if v is not None}:
        want[key] = statistics.median([v for k, v in pairs if k == key and v is not None])
    assert got == want


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.9, 1.0])
def test_percentiles_match_builtin_on_skewed_group(spark, p):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 7).alias("k"),
        (F.pmod(F.hash("id"), F.lit(1000)) / 8).alias("v"),
    )
    got = {r["k"]: r["m"] for r in exact_percentile(df, ["k"], "v", p, "m", cell_values=16).collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.percentile("v", p).alias("m")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.77, 1.0])
def test_percentiles_of_outliers_infinities_and_nan(spark, p):
    """Values that lie apart do not share a cell with all others; Spark's own result is the measure."""
    inf, nan = float("inf"), float("nan")
    rows = [("far", float(i)) for i in range(1001)] + [("far", 1e12)]
    rows += [("ends", x) for x in [-inf, -inf, *map(float, range(300)), inf, inf, inf]]
    rows += [("nan", x) for x in [nan, 1.0]] + [("many nan", x) for x in [nan] * 50 + [1.0, 2.0, 3.0]]
    rows += [("all nan", nan), ("one", 5.0), ("null", None), (None, 2.5), (None, 3.5)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(3)

    def text(found):
        return {r["k"]: f"{r['m']:.9g}" for r in found if r["m"] is not None}

    want = text(df.groupBy("k").agg(F.percentile("v", p).alias("m")).collect())
    for cell_values in (4, 50, 1_000_000):
        got = exact_percentile(df, ["k"], "v", p, "m", cell_values).collect()
        assert text(got) == want


def test_cells_are_bounded_however_values_lie(spark):
    from wardflow.operators.quantiles import _refined, value_counts

    # Nearly all values close together, a few far away.
    df = spark.range(20_000).select(F.lit("k").alias("k"), F.pow(F.lit(1.002), F.col("id") % 7000 + 1).alias("v"))
    df = df.unionByName(spark.createDataFrame([("k", 1e300), ("k", -1e300)], "k STRING, v DOUBLE"))
    counts = value_counts(df, ["k"], "v").cache()
    for low in (0, 3333, 20_001):
        place = spark.createDataFrame([("k", low, low)], "k STRING, _low LONG, _high LONG")
        kept, start = _refined(counts, ["k"], place)
        assert kept.count() <= 7002 / 100 * 1.2
        skip = start.first()["_skip"]
        assert skip <= low < skip + kept.agg(F.sum("_n")).first()[0]
    counts.unpersist()


def test_heavy_keys(spark):
    skewed = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    (hot,) = heavy_keys(skewed, ["k"], 30).collect()
    key = spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]
    assert hot["hot"] == {key: 11}  # a third of 30 parts, rounded up
    assert heavy_keys(skewed, ["k"], 5).first()["hot"] == {}
    assert heavy_keys(spark.range(1000), ["id"], 30).first()["hot"] == {}
    assert heavy_keys(spark.range(0), ["id"], 30).first()["hot"] == {}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join_and_spreads(spark, rows, how):
    fact = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("k"),
        "id",
    )
    dim = spark.createDataFrame([(1, "x"), (None, "n"), (1501, "y"), (7, "z")], "k INT, name STRING")
    renamed = dim.withColumnRenamed("k", "k2")
    plain = rows(fact.join(renamed, F.col("k").eqNullSafe(F.col("k2")), how).select("k", "id", "name"))
    for parts in (None, 4, 200):
        assert rows(spread_join(fact, dim, ["k"], how, parts=parts)) == plain
    assert rows(spread_join(fact, dim, ["k"], how, parts=50, keys_of=fact.select("k"))) == plain


def test_only_heavy_keys_are_repeated(spark):
    """The one side has one row per key, and more of the heavy ones only."""
    fact = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1).alias("k"))
    dim = spark.range(1001).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    joined = spread_join(fact, dim, ["k"], parts=30)
    assert joined.count() == 9000
    lanes = heavy_keys(fact, ["k"], 30).select(F.explode("hot")).collect()
    assert [r["value"] for r in lanes] == [10]


def test_project_casts_leniently(spark):
    df = spark.createDataFrame([("7", "x")], "a STRING, b STRING")
    assert tuple(star.project(df, "a INT, b INT").first()) == (7, None)


def test_diagnosis_dim_and_key(spark, rows):
    dx = spark.createDataFrame(
        [(1, 10, 2, "A", 9), (1, 10, 1, "B", 10), (1, 11, 1, "A", 9), (2, 12, 1, "Z", 9)],
        "subject_id INT, hadm_id INT, seq_num INT, icd_code STRING, icd_version INT",
    )
    names = spark.createDataFrame(
        [("A", 9, "alpha"), ("B", 10, None), ("C", 9, "never used")],
        "icd_code STRING, icd_version INT, long_title STRING",
    )
    dim = star.diagnosis_dim(dx, names)
    assert rows(dim.drop("diagnoses_icd_key")) == [(1, "A", 9, "alpha"), (1, "B", 10, None)]
    assert dim.select("diagnoses_icd_key").distinct().count() == 2
    stays = spark.createDataFrame(
        [(100, 1, 10), (101, 1, 11), (102, 2, 12), (103, 3, 13)],
        "stay_id INT, subject_id INT, hadm_id INT",
    )
    out = star.resolve_diagnosis_key(stays, dx, dim)
    got = {r["stay_id"]: (r["icd_code"], r["diagnoses_icd_key"] is not None) for r in out.collect()}
    # 102 has a code the dictionary lacks, 103 no diagnosis at all.
    assert got == {100: ("B", True), 101: ("A", True), 102: ("Z", False), 103: (None, False)}


def test_not_null_gate(spark, rows):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None)], "a INT, b INT")
    gate = quality.require_not_null(df, ["a", "b"])
    assert rows(gate.good) == [(1, 2)]
    assert {r["missing"] for r in gate.bad.collect()} == {"a", "a,b"}


def test_pk_violations(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    assert rows(quality.pk_violations(df, ["k"])) == [(1, 2), (None, 1)]


def test_fk_checks(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k INT, v STRING")
    dim = spark.createDataFrame([(1,)], "pk INT")
    assert rows(quality.fk_violations(fact, dim, "k", "pk")) == [(2, "b"), (2, "c")]
    assert rows(quality.fk_violation_counts(fact, dim, "k", "pk")) == [(2, 2)]
    assert rows(quality.fk_valid(fact, dim, "k", "pk")) == [(1, "a")]


def test_load_counters(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k INT")
    assert tuple(quality.load_counters(df, "t", ["k"]).first()) == ("t", 5, 2, 1, 2, 40.0)
    empty = quality.load_counters(df.limit(0), "t", ["k"]).first()
    assert tuple(empty) == ("t", 0, 0, 0, 0, None)


def test_insert_absent_first_write_wins(spark, rows):
    old = spark.createDataFrame([(1, "old")], "k INT, v STRING")
    new = spark.createDataFrame([(1, "new"), (2, "x"), (2, "x"), (None, "n")], "k INT, v STRING")
    assert rows(insert_absent(new, old, ["k"])) == [(2, "x")]
    assert insert_absent(old, old, ["k"]).count() == 0


def test_row_counts(spark, rows):
    a = spark.range(3)
    assert rows(quality.row_counts({"a": a, "b": a.limit(0)})) == [("a", 3), ("b", 0)]


def test_adapt_columns(spark):
    df = spark.createDataFrame([(1, 2)], "chartdate INT, charttime INT")
    assert star.adapt_columns(df, "fact_chartevents").columns == ["charttime_date", "charttime_time"]
    assert star.adapt_columns(df, "dim_time").columns == df.columns
