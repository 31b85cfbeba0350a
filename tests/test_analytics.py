"""Reports on small hand-checked frames: seed rows, edge rows, empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow.functions.calendar import KeyMapping, add_calendar_keys
from wardflow.operators import features as feat
from wardflow.plans import analytics as q
from wardflow.schemas import SOURCE_DDL
from wardflow.sources import generators

TS = dt.datetime


@pytest.fixture(scope="module")
def dates(spark):
    return generators.date_dim(spark, "2024-01-01", "2024-12-31")


@pytest.fixture(scope="module")
def times(spark):
    return generators.time_dim(spark)


@pytest.fixture(scope="module")
def stays(spark):
    df = spark.createDataFrame(
        [
            (2001, 1001, 5001, "CC", "MICU", TS(2024, 1, 1, 8), TS(2024, 1, 3, 16), 2.5, 1),
            (2002, 1002, 5002, "CC", "CCU", TS(2024, 1, 2, 12), TS(2024, 1, 2, 16), 0.5, 2),
            (2003, 1001, 5003, None, "CCU", TS(2024, 2, 1, 0), None, None, None),
            (2004, 1002, 5004, "SICU", None, TS(2025, 2, 1, 0), TS(2025, 2, 4), 3.0, 2),
        ],
        "stay_id INT, subject_id INT, hadm_id INT, first_careunit STRING, last_careunit STRING, "
        "intime timestamp_ntz, outtime timestamp_ntz, los DOUBLE, diagnoses_icd_key INT",
    )
    return add_calendar_keys(df, [KeyMapping.of("intime"), KeyMapping.of("outtime")])


@pytest.fixture(scope="module")
def diagnoses(spark):
    return spark.createDataFrame(
        [(1, "I10", 9, "Sepsis, unspecified"), (2, "E11.9", 10, "Type 2 diabetes"), (3, "J44", 10, None)],
        "diagnoses_icd_key INT, icd_code STRING, icd_version INT, long_title STRING",
    )


@pytest.fixture(scope="module")
def patients(spark):
    return spark.createDataFrame(
        [(1001, "M", 45, None), (1002, "F", 90, dt.date(2024, 5, 1)), (1003, None, 17, None)],
        "subject_id INT, gender STRING, anchor_age INT, dod DATE",
    )


@pytest.fixture(scope="module")
def triage(spark):
    return spark.createDataFrame(
        [
            (2001, 1001, 38.1, 101.0, 21.0, 94.0, 89.0, 80.0, "None", 3.0, "Chest pain"),
            (2002, 1002, 36.8, 82.0, 18.0, 97.0, 115.0, 75.0, "Mild", 2.0, "Chest pain"),
            (2003, 1001, None, None, None, None, None, None, None, None, None),
        ],
        "stay_id INT, subject_id INT, temperature DOUBLE, heartrate DOUBLE, resprate DOUBLE, "
        "o2sat DOUBLE, sbp DOUBLE, dbp DOUBLE, pain STRING, acuity DOUBLE, chiefcomplaint STRING",
    ).select(
        "stay_id", "subject_id", "pain", "chiefcomplaint",
        *[F.col(c).cast("decimal(10,4)").alias(c)
          for c in ("temperature", "heartrate", "resprate", "o2sat", "sbp", "dbp", "acuity")],
    )


def test_stays_by_year_keeps_days_outside_the_calendar(stays, dates, rows):
    assert rows(q.stays_by_year(stays, dates)) == [(2024, 3), (None, 1)]
    assert q.stays_calendar(stays, dates).count() == 4


def test_stays_by_unit_and_gender(stays, patients, rows):
    assert rows(q.stays_by_unit(stays)) == [("CC", 2), ("SICU", 1)]
    assert rows(q.stays_by_gender(stays, patients)) == [("F", 2), ("M", 2)]


def test_top_codes_tie_break(stays, diagnoses):
    got = [tuple(r) for r in q.top_codes(stays, diagnoses, 1).collect()]
    assert got == [("E11.9", "Type 2 diabetes", 2)]


def test_los_stats(stays, rows):
    assert rows(q.los_stats(stays)) == [
        ("CCU", 2, 0.5, 0.5, 0.5, 0.5),
        ("MICU", 1, 2.5, 2.5, 2.5, 2.5),
        (None, 1, 3.0, 3.0, 3.0, 3.0),
    ]


@pytest.fixture(scope="module")
def events(spark):
    df = spark.createDataFrame(
        [
            (1, "hr", TS(2024, 1, 1, 8, 0), 80.0),
            (1, "hr", TS(2024, 1, 1, 8, 30), 90.0),
            (1, "ox", TS(2024, 1, 1, 8, 59, 59), 97.0),
            (1, "hr", TS(2024, 1, 1, 9), 70.0),
            (1, "ox", TS(2024, 1, 1, 10), 95.0),
            (2, "ox", TS(2024, 1, 1, 8), None),
            (2, "hr", TS(2024, 1, 1, 8), 60.0),
            (1, "hr", TS(2030, 1, 1, 8), 1.0),
            (1, "ox", TS(2030, 1, 1, 8), 1.0),
        ],
        "stay_id INT, itemid STRING, charttime timestamp_ntz, valuenum DOUBLE",
    )
    return add_calendar_keys(df, [KeyMapping.of("charttime")])


def test_aligned_series(events, dates, times, rows):
    day = dt.date(2024, 1, 1)
    # Stay 2 has both items in the hour, one without a value; 2030 is outside the calendar.
    assert rows(q.aligned_series(events, dates, times, "hr", "ox")) == [
        (1, day, 8, 85.0, 97.0), (2, day, 8, 60.0, None)
    ]
    assert rows(q.aligned_series(events, dates, times, "hr", "ox", "day")) == [
        (1, day, 80.0, 96.0), (2, day, 60.0, None)
    ]


def test_aligned_series_is_one_scan_and_one_hash_shuffle(events, dates, times, plan_of):
    plan = plan_of(q.aligned_series(events, dates, times, "hr", "ox"))
    assert plan.count("hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 2


def test_hourly_vitals(events, dates, times, rows):
    assert rows(q.hourly_vitals(events, dates, times, "ox"))[0] == (
        1, dt.date(2024, 1, 1), 10, 95.0, 95.0, 95.0, 1)


def test_ed_triage_and_duration(stays, triage, rows):
    ed = stays.withColumns({c: F.lit("x") for c in ("gender", "race", "arrival_transport", "disposition")})
    assert q.ed_triage(ed, triage).count() == 4
    seconds = {r[0]: r[1] for r in q.stay_duration(stays).collect()}
    assert seconds == {2001: 2 * 86400 + 8 * 3600, 2002: 4 * 3600, 2003: None, 2004: 3 * 86400}


def test_status_reports(spark, stays, diagnoses, triage, rows):
    flags = {r["stay_id"]: r["sepsis_flag"] for r in q.status_flag(stays, diagnoses, "sepsis").collect()}
    assert flags == {2001: 1, 2002: 0, 2003: 0, 2004: 0}
    micro = spark.createDataFrame([(1001,), (1001,)], "subject_id INT")
    seen = q.status_micro_flag(stays, diagnoses, micro, "sepsis")
    assert {r["stay_id"]: r["has_micro_event"] for r in seen.collect()} == {
        2001: 1, 2002: 0, 2003: 1, 2004: 0}
    assert rows(q.status_count(stays, diagnoses, "sepsis")) == [("Non-Sepsis", 2), ("Sepsis", 1)]
    stats = {r["sepsis_status"]: r for r in q.vitals_stats(stays, diagnoses, triage, "sepsis").collect()}
    assert stats["Non-Sepsis"]["patient_count"] == 1 and stats["Sepsis"]["max_heartrate"] == 101.0
    compare = {r["sepsis_status"]: r for r in
               q.vitals_compare(stays, diagnoses, triage, "sepsis").collect()}
    assert compare["Sepsis"]["avg_temperature"] == 38.1
    assert compare["Sepsis"]["std_temperature"] is None
    assert compare["Non-Sepsis"]["patient_count"] == 2
    assert rows(q.complaints_by_status(stays, diagnoses, triage, "sepsis")) == [
        ("Non-Sepsis", "Chest pain", 1), ("Sepsis", "Chest pain", 1)]
    abnormal = {r["sepsis_status"]: r for r in
                q.abnormal_vitals(stays, diagnoses, triage, "sepsis").collect()}
    assert abnormal["Sepsis"]["tachycardia_pct"] == 100.0
    assert abnormal["Non-Sepsis"]["total_patients"] == 2
    assert abnormal["Non-Sepsis"]["abnormal_temp_count"] == 0


def test_transposed_report(stays, diagnoses, triage):
    out = {r["metric"]: r for r in q.vitals_transposed(stays, diagnoses, triage, "sepsis").collect()}
    assert len(out) == 6
    assert out["Heart Rate (bpm)"]["Sepsis"] == 101.0
    assert out["Heart Rate (bpm)"]["Non-Sepsis"] == 82.0


def test_demographics(patients, rows):
    assert rows(q.demographics(patients)) == [
        ("F", 1, 90.0, 90, 90), ("M", 1, 45.0, 45, 45), (None, 1, 17.0, 17, 17)]


def test_micro_with_stays(spark, stays):
    micro = spark.createDataFrame(
        [(1, 1001, 5001, "E. coli", None), (2, 1001, 9999, "E. coli", "x"), (3, 1002, 5002, None, "x")],
        "microevent_id INT, subject_id INT, hadm_id INT, org_name STRING, comments STRING")
    got = {r["microevent_id"]: r["stay_id"] for r in q.micro_with_stays(micro, stays).collect()}
    assert got == {1: 2001, 2: None}
    assert [r["microevent_id"] for r in q.micro_with_stays(micro, stays, "all").collect()] == [2]


def test_items(spark, rows):
    items = spark.createDataFrame(
        [(2, "RR", "V", "x", 1.0, 2.0), (1, "HR", None, "x", None, None)],
        "itemid INT, label STRING, category STRING, unitname STRING, lownormalvalue DOUBLE, "
        "highnormalvalue DOUBLE")
    assert [r["itemid"] for r in q.items_listing(items).collect()] == [1, 2]
    assert q.items_listing(items, "V").count() == 1
    assert rows(q.item_categories(items)) == [("V",)]


def test_fluid_and_mortality(spark, stays, patients, rows):
    ins = spark.createDataFrame([(2001, 10.0), (2001, 5.0), (2004, 1.0)], "stay_id INT, amount DOUBLE")
    outs = spark.createDataFrame([(2001, 3), (2002, 4)], "stay_id INT, value INT")
    balance = q.fluid_balance(stays, ins, outs)
    assert {r["stay_id"]: r["fluid_balance_ml"] for r in balance.collect()} == {
        2001: 12.0, 2002: -4.0, 2003: 0.0, 2004: 1.0}
    strict = q.fluid_balance(stays, ins, outs, null_as_zero=False)
    assert {r["stay_id"]: r["fluid_balance_ml"] for r in strict.collect()} == {
        2001: 12.0, 2002: None, 2003: None, 2004: None}
    last = q.last_stay(balance, patients)
    assert {r["subject_id"]: r["stay_id"] for r in last.collect()} == {1001: 2003, 1002: 2004}
    assert rows(q.mortality_by_balance(last)) == [("Negative", "Alive", 1), ("Positive", "Dead", 1)]
    assert rows(q.mortality_by_age(last)) == [
        ("40–64", "Negative", "Alive", 1), ("90+", "Positive", "Dead", 1)]


def test_last_stay_tie_goes_to_the_larger_id(spark, patients):
    df = spark.createDataFrame([(1, 1001, TS(2024, 1, 1)), (2, 1001, TS(2024, 1, 1))],
                               "stay_id INT, subject_id INT, intime timestamp_ntz")
    assert [r["stay_id"] for r in q.last_stay(df, patients).collect()] == [2]


def test_ols(spark, rows):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0), (None, 1.0)], "x DOUBLE, y DOUBLE")
    assert rows(q.ols(df, "y", "x")) == [(2.0, 1.0, 1.0, 3)]
    one = spark.createDataFrame([(1.0, 3.0)], "x DOUBLE, y DOUBLE")
    assert rows(q.ols(one, "y", "x")) == [(None, None, None, 1)]


def test_features_window_and_defaults(spark):
    stays = spark.createDataFrame(
        [(1, TS(2024, 1, 1, 8), 70, 1, 0), (2, TS(2024, 1, 1, 8), None, 0, 1)],
        "stay_id INT, intime timestamp_ntz, age INT, is_male INT, is_emergency INT")
    hr, sbp = feat.VITAL_ITEMS["heart_rate"], feat.VITAL_ITEMS["sbp"]
    events = spark.createDataFrame(
        [(1, hr, TS(2024, 1, 1, 8), 100.0), (1, hr, TS(2024, 1, 2, 7, 59, 59), 80.0),
         (1, hr, TS(2024, 1, 2, 8), 500.0), (1, hr, TS(2024, 1, 1, 7), 500.0),
         (1, sbp, TS(2024, 1, 1, 9), 90.0), (1, 5, TS(2024, 1, 1, 9), 5.0)],
        "stay_id INT, itemid INT, charttime timestamp_ntz, valuenum DOUBLE")
    dx = spark.createDataFrame(
        [(1, "Sepsis"), (1, "Acute respiratory failure"), (1, None)], "stay_id INT, long_title STRING")
    vitals = feat.vital_features(events, stays, feat.VITAL_ITEMS)
    frame = feat.stay_features(stays.drop("intime"), vitals, feat.diagnosis_features(dx, "stay_id"))
    got = {r["stay_id"]: r for r in frame.collect()}
    one = got[1]
    assert (one["mean_heart_rate"], one["min_heart_rate"], one["max_heart_rate"]) == (90, 80, 100)
    assert one["mean_spo2"] is None and one["shock_index"] == 1.0
    assert (one["dx_count"], one["has_sepsis"], one["has_resp_failure"], one["has_pneumonia"]) == (3, 1, 1, 0)
    assert (got[2]["dx_count"], got[2]["has_sepsis"], got[2]["shock_index"]) == (0, 0, 0.0)
    vector = feat.align_features(frame, ["age", "unknown", "mean_spo2"], ["stay_id"])
    assert sorted(tuple(r) for r in vector.collect()) == [(1, 70.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0)]


def test_risk_report(spark):
    df = spark.createDataFrame([(1, 0.0, 0, 0, 0.0, 0), (2, 10.0, 1, 12, 1.0, 1)],
                               "stay_id INT, age DOUBLE, has_sepsis INT, dx_count INT, "
                               "shock_index DOUBLE, is_emergency INT")
    half = feat.LinearModel(0.0, {"age": 1.0, "not_there": 5.0})
    classes = [feat.LinearModel(0.0, {"age": 1.0}), feat.LinearModel(0.0, {}), feat.LinearModel(0.0, {})]
    got = {r["stay_id"]: r for r in feat.risk_report(df, half, half, classes).collect()}
    # A probability of exactly one half is not high.
    assert (got[1]["mortality_prob"], got[1]["mortality_tier"]) == (0.5, "medium")
    assert (got[1]["readmission_tier"], got[1]["reasons"]) == ("low", ["stable"])
    assert (got[1]["stay_class"], round(got[1]["stay_confidence"], 6)) == (0, 0.333333)
    assert got[2]["mortality_tier"] == "high" and len(got[2]["reasons"]) == 4
    assert got[2]["stay_label"] == "LONG STAY (>7 days)" and got[2]["stay_confidence"] > 0.99


def test_emergency_flag_on_free_text(spark):
    df = spark.createDataFrame([(50, "M", "EW EMER.")], "a INT, g STRING, t STRING")
    cols = feat.demographic_columns(F.col("a"), F.col("g"), F.col("t"), emergency="EMER")
    assert tuple(df.select(*cols).first()) == (50, 1, 1)


def test_empty_inputs(spark, dates, times, stays, diagnoses, patients, triage, events):
    none = stays.limit(0)
    reports = [
        q.stays_by_year(none, dates), q.stays_by_unit(none), q.top_codes(none, diagnoses),
        q.los_stats(none), q.status_count(none, diagnoses, "x"),
        q.vitals_compare(none, diagnoses, triage, "x"),
        q.abnormal_vitals(none, diagnoses, triage, "x"),
        q.aligned_series(events.limit(0), dates, times, "hr", "ox"),
        q.demographics(patients.limit(0)),
    ]
    assert [r.count() for r in reports] == [0] * len(reports)
    assert "subject_id INT" in SOURCE_DDL["patients"]
