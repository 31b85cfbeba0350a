"""Distinct counts from stored sketches."""

import pytest
from pyspark.sql import functions as F

from wardflow.operators.distinct import distinct_sketches, relative_error, roll_up


def test_roll_up_of_stored_sketches(spark, tmp_path):
    df = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 7).cast("string"))).alias("unit"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 23_000).alias("v"),
    )
    path = str(tmp_path / "sketches")
    early = F.col("day") < 12
    # New days are appended; one day comes in two parts.
    for part in (df.filter(early & (F.col("day") > 0)), df.filter(~early), df.filter("day = 0 AND id < 900"), df.filter("day = 0 AND id >= 900")):
        distinct_sketches(part, ["day", "unit"], "v").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    for keys in (["unit"], [], ["day"]):
        got = {tuple(r[k] for k in keys): r for r in roll_up(stored, keys, "n").collect()}
        for r in df.groupBy(*keys).agg(F.count_distinct("v").alias("n"), F.count("*").alias("rows")).collect():
            found = got[tuple(r[k] for k in keys)]
            assert found["rows"] == r["rows"]
            assert found["n"] == pytest.approx(r["n"], rel=found["relative_error"])
    assert relative_error() < 0.03 < relative_error(10)


def test_empty_and_null(spark):
    df = spark.createDataFrame([("a", None), ("b", 1)], "k STRING, v INT")
    got = {r["k"]: (r["rows"], r["n"]) for r in roll_up(distinct_sketches(df, ["k"], "v"), ["k"], "n").collect()}
    assert got == {"a": (1, 0), "b": (1, 1)}
    assert roll_up(distinct_sketches(df.limit(0), ["k"], "v"), ["k"], "n").count() == 0
