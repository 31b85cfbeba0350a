"""From source files and messages to a report: the whole path on a small hospital."""

import pytest

from wardflow.operators.star import resolve_diagnosis_key
from wardflow.plans import analytics, loads
from wardflow.schemas import SOURCE_DDL, column_names
from wardflow.sinks import streams
from wardflow.sources import generators, readers
from wardflow.specs import DIMS, FACTS
from wardflow.streaming import jobs


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("hospital"))


@pytest.fixture(scope="module")
def warehouse(spark, root):
    files = {
        "patients": ["1,F,70,2150,2017 - 2019,2151-01-01 00:00:00", "2,M,40,2150,2017 - 2019,"],
        "d_items": ["220045,Heart Rate,HR,chartevents,Vital,bpm,Numeric,60,100",
                    "220277,O2,SpO2,chartevents,Vital,%,Numeric,,"],
        "triage": ["1,10,38.5,110,22,93,85,50,5,2,fever", "2,20,36.6,80,16,99,120,80,0,4,cut"],
        "admissions": ["1,100,2150-01-01 00:00:00,2150-01-05 12:00:00,,EW EMER.,P1,ED,HOME,"
                       "Other,EN,,WHITE,,,0"],
        "icustays": ["1,100,10,MICU,MICU,2150-01-01 10:00:00,2150-01-03 10:00:00,2.0",
                     "2,200,20,CCU,SICU,2150-06-01 00:00:00,2150-06-02 12:00:00,1.5"],
        "edstays": ["1,100,10,2150-01-01 08:00:00,2150-01-01 09:59:59,F,WHITE,AMBULANCE,ADMITTED"],
        "diagnoses_icd": ["1,100,1,A41,10", "1,100,2,I10,10", "2,200,1,I10,10"],
        "d_icd_diagnoses": ["A41,10,Sepsis unspecified", "I10,10,Hypertension"],
    }
    paths = {}
    for name, lines in files.items():
        paths[name] = f"{root}/{name}.csv"
        with open(paths[name], "w") as f:
            f.write(",".join(column_names(SOURCE_DDL[name])) + "\n" + "\n".join(lines) + "\n")
    report = loads.load_dims(spark, DIMS, paths, f"{root}/wh")
    assert {r["status"] for r in report.collect()} == {"loaded"}

    spec = FACTS["icu_chartevents"]
    rows = [
        (1, 100, 10, None, f"2150-01-01T1{h}:0{m}:00", "NaT", item, f"{v} ", float(v), "u", "0.0")
        for h, m, item, v in [(0, 0, 220045, 80), (0, 5, 220045, 90), (0, 6, 220277, 97),
                              (1, 0, 220045, 120), (1, 0, 220277, 91), (2, 0, 220277, 95)]
    ]
    source = spark.createDataFrame(rows + rows[:3], spec.source_ddl)
    streams.publish_json(source, spec.partition_key, f"{root}/topic", "charttime", 2)
    messages = readers.read_stream(spark, f"{root}/topic", "key STRING, value STRING")
    jobs.drain(jobs.ingest_bronze(messages, spec, f"{root}/bronze", f"{root}/ck", f"{root}/bad",
                                  available_now=True))
    jobs.drain([jobs.bronze_to_silver(spark, spec, f"{root}/bronze", f"{root}/silver",
                                      f"{root}/ck/silver", ("charttime", "1 day"),
                                      available_now=True)])
    loaded = loads.load_fact(spark, spec, f"{root}/silver", f"{root}/wh/{spec.table}", f"{root}/marks")
    assert loaded.first()["rows_written"] == 6
    tables = readers.open_warehouse(spark, f"{root}/wh", [*DIMS, spec.table])
    tables["dates"] = generators.date_dim(spark)
    tables["times"] = generators.time_dim(spark)
    return tables


def test_calendar_keys_of_loaded_tables(warehouse):
    ed = warehouse["fact_edstays"].first()
    assert (ed["intime_date"], ed["intime_time"], ed["outtime_time"]) == (21500101, 28800, 35999)
    admission = warehouse["dim_admission"].first()
    assert (admission["dischtime_date"], admission["deathtime_date"]) == (21500105, None)


def test_reports_on_the_loaded_star(spark, warehouse, rows):
    w = warehouse
    diagnoses = w["dim_diagnoses_icd"]
    dx = spark.read.schema(SOURCE_DDL["diagnoses_icd"])
    events = dx.csv(w["fact_icustays"].inputFiles()[0].split("/wh/")[0] + "/diagnoses_icd.csv",
                    header=True)
    stays = resolve_diagnosis_key(w["fact_icustays"], events, diagnoses).drop("long_title")
    assert rows(analytics.stays_by_year(stays, w["dates"])) == [(2150, 2)]
    assert rows(analytics.status_count(stays, diagnoses, "sepsis")) == [
        ("Non-Sepsis", 1), ("Sepsis", 1)]
    abnormal = analytics.abnormal_vitals(stays, diagnoses, w["dim_triage"], "sepsis")
    got = {r["sepsis_status"]: r["abnormal_temp_count"] for r in abnormal.collect()}
    assert got == {"Non-Sepsis": 0, "Sepsis": 1}
    series = analytics.aligned_series(
        w["fact_chartevents"], w["dates"], w["times"], 220045, 220277)
    assert [(r["hour_of_day"], r["hr_avg"], r["spo2_avg"]) for r in series.collect()] == [
        (10, 85.0, 97.0), (11, 120.0, 91.0)]
    ed = analytics.ed_triage(w["fact_edstays"], w["dim_triage"]).first()
    assert (ed["stay_id"], ed["triage_subject_id"], ed["acuity"]) == (10, 1, 2)
    assert rows(analytics.stay_duration(w["fact_edstays"])) == [(10, 7199)]
    assert rows(analytics.demographics(w["dim_patients"])) == [
        ("F", 1, 70.0, 70, 70), ("M", 1, 40.0, 40, 40)]


def test_sql_on_the_loaded_star(spark, warehouse):
    text = (
        "SELECT i.label, count(*) AS n FROM fact_chartevents f JOIN dim_d_items i USING (itemid) "
        "WHERE f.valuenum > :low GROUP BY i.label"
    )
    got = {tuple(r) for r in readers.read_query(spark, text, args={"low": 90}).collect()}
    assert got == {("Heart Rate", 1), ("O2", 3)}
