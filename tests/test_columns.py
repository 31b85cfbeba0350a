"""Calendar, text and clinical column functions, with every NULL branch."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.functions import calendar as cal
from wardflow.functions import clinical, text
from wardflow.sources import generators


def one(spark, column, *cells, ddl):
    return spark.createDataFrame([tuple(cells)], ddl).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "stamp, d, t",
    [
        (dt.datetime(2024, 2, 29, 0, 0, 0), 20240229, 0),
        (dt.datetime(2100, 1, 1, 23, 59, 59, 999999), 21000101, 86399),
        (dt.datetime(1999, 12, 31, 8, 5, 7), 19991231, 29107),
        (None, None, None),
    ],
)
def test_keys(spark, stamp, d, t):
    df = spark.createDataFrame([(stamp,)], "ts timestamp_ntz")
    out = df.select(cal.date_key(F.col("ts")), cal.time_key(F.col("ts"))).first()
    assert tuple(out) == (d, t)


def test_add_keys_keeps_or_drops_sources(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 1), None)], "id INT, a timestamp_ntz, b timestamp_ntz"
    )
    maps = [cal.KeyMapping.of("a"), cal.KeyMapping.of("b")]
    kept = cal.add_calendar_keys(df, maps)
    dropped = cal.add_calendar_keys(df, maps, drop_source=True)
    assert kept.columns == ["id", "a", "b", "a_date", "a_time", "b_date", "b_time"]
    assert dropped.columns == ["id", "a_date", "a_time", "b_date", "b_time"]
    assert tuple(dropped.first()) == (1, 20240101, 3600, None, None)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2299, 1, 1)), min_size=1,
                max_size=200))
def test_keys_roundtrip(spark, stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    back = cal.keys_to_timestamp(cal.date_key(F.col("ts")), cal.time_key(F.col("ts")))
    for r in df.select("ts", back.alias("b")).collect():
        assert r["b"] == r["ts"].replace(microsecond=0)


def test_bad_key_has_no_timestamp(spark):
    bad = cal.keys_to_timestamp(F.col("d"), F.col("t"))
    assert one(spark, bad, 20240231, 5, ddl="d INT, t INT") is None


def test_interval_crosses_leap_day(spark):
    seconds = cal.interval_seconds(*[F.col(c) for c in "abcd"])
    assert one(spark, seconds, 20240228, 86399, 20240301, 1, ddl="a INT, b INT, c INT, d INT") == (
        86400 + 2
    )
    assert one(spark, seconds, 20240228, 0, None, None, ddl="a INT, b INT, c INT, d INT") is None


def test_date_dim_default_range(spark):
    dates = generators.date_dim(spark)
    assert dates.count() == 73048
    first = dates.orderBy("date_key").first()
    # The first day of 2100 belongs to ISO week 53 of the year before.
    assert tuple(first) == (21000101, dt.date(2100, 1, 1), 1, 53, 1, 1, 2100)


def test_time_dim(spark):
    times = generators.time_dim(spark)
    assert times.count() == 86400
    assert tuple(times.filter("time_key = 86399").first()) == (86399, "23:59:59", 23, 59, 59)


@pytest.mark.parametrize("value, want", [("  a ", "a"), ("   ", None), ("", None), (None, None)])
def test_blank_to_null(spark, value, want):
    assert one(spark, text.blank_to_null(F.col("v")), value, ddl="v STRING") == want


@pytest.mark.parametrize(
    "value, want", [("Severe SEPSIS", "yes"), ("flu", "no"), (None, "no")]
)
def test_keyword_class(spark, value, want):
    assert one(spark, text.keyword_class(F.col("v"), "sepsis", "yes", "no"), value,
               ddl="v STRING") == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("2150-03-01 08:00:00", "2150-03-01T08:00:00"),
        ("2150-03-01 08:00:00.25", "2150-03-01T08:00:00.250000"),
        ("2180-01-01T00:00:00+07:00", "2180-01-01T00:00:00+07:00"),
        ("2180-01-01 00:00:00.5Z", "2180-01-01T00:00:00.500000Z"),
        ("2180-01-01", "2180-01-01T00:00:00"),
        ("tomorrow", "tomorrow"),
        (None, None),
    ],
)
def test_iso_timestamp(spark, value, want):
    assert one(spark, text.iso_timestamp(F.col("v")), value, ddl="v STRING") == want


@pytest.mark.parametrize(
    "v, lo, hi, want",
    [(50.0, 60.0, 100.0, True), (60.0, 60.0, 100.0, False), (100.0, 60.0, 100.0, False),
     (101.0, None, 100.0, True), (50.0, None, None, None), (99.0, None, 100.0, None),
     (None, 1.0, 2.0, None)],
)
def test_out_of_range_is_three_valued(spark, v, lo, hi, want):
    flag = clinical.out_of_range(F.col("v"), F.col("lo"), F.col("hi"))
    assert one(spark, flag, v, lo, hi, ddl="v DOUBLE, lo DOUBLE, hi DOUBLE") is want


@pytest.mark.parametrize(
    "age, band",
    [(17, "Under 18"), (18, "18–39"), (39, "18–39"), (40, "40–64"), (64, "40–64"),
     (65, "65–89"), (89, "65–89"), (90, "90+"), (None, "90+")],
)
def test_age_band(spark, age, band):
    assert one(spark, clinical.age_band(F.col("a")), age, ddl="a INT") == band


def test_balance_and_mortality(spark):
    assert one(spark, clinical.balance_group(F.col("x")), 0.0, ddl="x DOUBLE") == "Negative"
    assert one(spark, clinical.balance_group(F.col("x")), None, ddl="x DOUBLE") == "Negative"
    assert one(spark, clinical.balance_group(F.col("x")), 0.1, ddl="x DOUBLE") == "Positive"
    assert one(spark, clinical.mortality_label(F.col("x")), None, ddl="x DATE") == "Alive"
    both = F.col("a"), F.col("b")
    assert one(spark, clinical.net_balance(*both), 5.0, None, ddl="a DOUBLE, b DOUBLE") == 5.0
    strict = clinical.net_balance(*both, null_as_zero=False)
    assert one(spark, strict, 5.0, None, ddl="a DOUBLE, b DOUBLE") is None


@pytest.mark.parametrize(
    "p, three, two",
    [(0.2, "low", "low"), (0.21, "medium", "low"), (0.5, "medium", "low"), (0.51, "high", "high"),
     (None, None, None)],
)
def test_risk_tier_thresholds_are_strict(spark, p, three, two):
    assert one(spark, clinical.risk_tier(F.col("p")), p, ddl="p DOUBLE") == three
    assert one(spark, clinical.risk_tier(F.col("p"), medium=None), p, ddl="p DOUBLE") == two


def test_shock_index_without_pressure(spark):
    index = clinical.shock_index(F.col("h"), F.col("s"))
    assert one(spark, index, 80.0, 0.0, ddl="h DOUBLE, s DOUBLE") == 0.0
    assert one(spark, index, 80.0, None, ddl="h DOUBLE, s DOUBLE") == 0.0
    assert one(spark, index, 90.0, 100.0, ddl="h DOUBLE, s DOUBLE") == 0.9


def test_reasons(spark):
    reasons = clinical.risk_reasons(*[F.col(c) for c in "abcd"])
    ddl = "a INT, b INT, c DOUBLE, d INT"
    assert one(spark, reasons, 11, 1, 0.91, 1, ddl=ddl) == [
        "multimorbidity", "sepsis", "hemodynamic_instability", "emergency_admission"
    ]
    assert one(spark, reasons, 10, 0, 0.9, 0, ddl=ddl) == ["stable"]
    assert one(spark, reasons, None, None, None, None, ddl=ddl) == ["stable"]


def test_stay_class_label(spark):
    label = clinical.stay_class_label(F.col("i"))
    assert one(spark, label, 2, ddl="i INT") == "SHORT (<3 days)"
    assert one(spark, label, 7, ddl="i INT") == "Unknown"
