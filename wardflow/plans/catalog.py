"""Every named query as ``(spark, path) -> DataFrame``; ``tools/sql_checks.py`` has SQL for each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import (
    KeyMapping,
    add_calendar_keys,
    keys_to_timestamp,
)
from ..functions.clinical import stay_class_of
from ..functions.text import iso_timestamp
from ..operators import features as feat
from ..operators import boosting, quality, sampling
from ..operators.clean import clean_chart_events
from ..operators.dedup import dedup
from ..operators.enrich import enrich_items, flag_out_of_range, with_date
from ..operators.incremental import read_since
from ..operators.star import diagnosis_dim, keyed_dictionary, resolve_diagnosis_key
from ..sinks.streams import write_stream
from ..sinks.tables import insert_absent, table_inventory, write_table
from ..session import materialise, work_path
from ..sources import generators, messages
from ..sources.readers import profile, read_query, read_stream
from ..specs import FactSpec, register_query
from ..streaming import jobs, monitor
from . import analytics as q
from . import loads
from .views import CONDITION, FEATURE_ITEMS, FEATURE_KEYWORDS, ClinicalViews as Views

MESSAGE_DDL = (
    "event_id BIGINT, subject_id BIGINT, hadm_id BIGINT, stay_id BIGINT, charttime STRING, "
    "storetime STRING, itemid STRING, value STRING, valuenum DOUBLE, valueuom STRING, "
    "warning STRING"
)
FACT_DDL = (
    "subject_id BIGINT, hadm_id BIGINT, stay_id BIGINT, charttime_date INT, charttime_time INT, "
    "itemid STRING, value STRING, valuenum DOUBLE, warning INT"
)
EVENT_SPEC = FactSpec(
    name="events",
    table="fact_chartevents",
    source_ddl=MESSAGE_DDL,
    target_ddl=FACT_DDL,
    clean=clean_chart_events,
    keys=("subject_id", "stay_id", "charttime", "itemid"),
    event_time="charttime",
    mappings=(KeyMapping.of("charttime"),),
    required=("subject_id", "itemid", "charttime_date", "charttime_time"),
    partition_key="stay_id",
)
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# --- query library -----------------------------------------------------------------------


def _register(name, build):
    register_query(name, lambda spark, path: build(Views(spark, path)))


_register("stays_calendar", lambda v: q.stays_calendar(v.stays, v.admission_dates).drop("intime", "outtime"))
_register("stays_by_year", lambda v: q.stays_by_year(v.stays, v.admission_dates))
_register("stays_by_unit", lambda v: q.stays_by_unit(v.stays))
_register("stays_by_segment", lambda v: q.stays_by_gender(v.stays, v.patients))
_register("top10_codes", lambda v: q.top_codes(v.stays, v.diagnoses, 10))
_register(
    "aligned_hourly",
    lambda v: q.aligned_series(v.chart_events, v.event_dates, v.times, "click", "view"),
)
_register(
    "aligned_daily",
    lambda v: q.aligned_series(v.chart_events, v.event_dates, v.times, "click", "view", "day"),
)
_register("hourly_vitals", lambda v: q.hourly_vitals(v.chart_events, v.event_dates, v.times, "click"))
_register("ed_triage_left", lambda v: q.ed_triage(v.ed_stays, v.triage))
_register("stay_duration", lambda v: q.stay_duration(v.ed_stays))
_register(
    "monitored_duration",
    lambda v: q.stay_duration(
        add_calendar_keys(v.monitored, [KeyMapping.of("intime"), KeyMapping.of("outtime")])
    ),
)
_register("sepsis_flag", lambda v: q.status_flag(v.stays, v.diagnoses, CONDITION))
_register(
    "sepsis_micro_flag",
    lambda v: q.status_micro_flag(v.stays, v.diagnoses, v.micro_events, CONDITION),
)
_register("sepsis_count", lambda v: q.status_count(v.stays, v.diagnoses, CONDITION))
_register("vitals_stats", lambda v: q.vitals_stats(v.stays, v.diagnoses, v.triage, CONDITION))
_register("vitals_compare", lambda v: q.vitals_compare(v.stays, v.diagnoses, v.triage, CONDITION))
_register(
    "vitals_transposed",
    lambda v: q.vitals_transposed(v.stays, v.diagnoses, v.triage, CONDITION).select(
        "metric", F.col("`Non-Sepsis`").alias("non_sepsis"), F.col("Sepsis").alias("sepsis")
    ),
)
_register(
    "complaints_by_status",
    lambda v: q.complaints_by_status(v.stays, v.diagnoses, v.triage, CONDITION),
)
_register("abnormal_vitals", lambda v: q.abnormal_vitals(v.stays, v.diagnoses, v.triage, CONDITION))
_register("demographics", lambda v: q.demographics(v.patients))
_register("los_median", lambda v: q.los_stats(v.stays))
_register("micro_with_stays", lambda v: q.micro_with_stays(v.micro_events, v.stays))
_register("micro_complete", lambda v: q.micro_with_stays(v.micro_events, v.stays, "all"))
_register("items_listing", lambda v: q.items_listing(v.items))
_register("items_in_category", lambda v: q.items_listing(v.items, "account"))
_register("item_categories", lambda v: q.item_categories(v.items))
_register("fluid_balance", lambda v: q.fluid_balance(v.stays, v.inputs, v.outputs))
_register(
    "fluid_balance_strict",
    lambda v: q.fluid_balance(v.stays, v.inputs, v.outputs, null_as_zero=False),
)


def _last(v: Views) -> DataFrame:
    """Totals are joined to the one stay of each subject that counts."""
    latest = v.with_discharge(q.latest_stays(v.admissions))
    return q.with_patient(q.fluid_balance(latest, v.inputs, v.outputs), v.patients)


_register("last_stay", lambda v: _last(v).drop("anchor_age"))
_register("mortality_by_balance", lambda v: q.mortality_by_balance(_last(v)))
_register("mortality_by_age", lambda v: q.mortality_by_age(_last(v)))
_register(
    "ols_pair",
    lambda v: q.ols(
        q.aligned_series(v.chart_events, v.event_dates, v.times, "click", "view"), "spo2_avg", "hr_avg"
    ),
)
_register("ols_triage", lambda v: q.ols(q.ed_triage(v.ed_stays, v.triage), "heartrate", "acuity"))

# --- calendar ----------------------------------------------------------------------------

_register("date_dim_span", lambda v: generators.date_dim_over(v.stays, "intime", "outtime"))


@register_query("date_attributes")
def date_attributes(spark: SparkSession, path: str) -> DataFrame:
    """Admissions per ISO week, month and quarter of the date dimension."""
    v = Views(spark, path)
    joined = with_date(v.stays.select("stay_id", "intime_date"), v.admission_dates, "intime_date", "inner")
    keys = ["year", "quarter", "month", "week"]
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("admissions"))


@register_query("time_dim_hits")
def time_dim_hits(spark: SparkSession, path: str) -> DataFrame:
    """Events per second of the day, with the attributes of the time dimension."""
    v = Views(spark, path)
    counted = v.chart_events.groupBy("charttime_time").agg(F.count(F.lit(1)).alias("events"))
    return counted.join(F.broadcast(v.times), F.col("charttime_time") == F.col("time_key")).drop(
        "charttime_time"
    )


@register_query("calendar_keys")
def calendar_keys(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    return v.chart_events.select("event_id", "charttime_date", "charttime_time")


@register_query("keys_roundtrip")
def keys_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    """Keys decoded back to a timestamp at second precision."""
    v = Views(spark, path)
    back = keys_to_timestamp(F.col("charttime_date"), F.col("charttime_time"))
    return v.chart_events.select("event_id", back.alias("charttime_second"))


@register_query("admission_dim")
def admission_dim(spark: SparkSession, path: str) -> DataFrame:
    """Interval rows with both timestamps replaced by key pairs."""
    v = Views(spark, path)
    times = [KeyMapping.of("intime"), KeyMapping.of("outtime")]
    base = v.stays.select("hadm_id", "subject_id", "first_careunit", "intime", "outtime")
    return add_calendar_keys(base, times, drop_source=True)


# --- star --------------------------------------------------------------------------------


@register_query("diagnosis_dim")
def diagnosis_dim_query(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    return diagnosis_dim(v.diagnosis_codes, v.diagnosis_dictionary).drop("diagnoses_icd_key")


@register_query("diagnosis_key")
def diagnosis_key(spark: SparkSession, path: str) -> DataFrame:
    """Primary diagnosis of every stay, resolved through the dimension."""
    v = Views(spark, path)
    # A primary code is a coded one, so its key follows from the dictionary alone.
    dim = keyed_dictionary(v.diagnosis_dictionary)
    stays = v.admissions.select("stay_id", "subject_id", F.col("stay_id").alias("hadm_id"))
    resolved = resolve_diagnosis_key(stays, v.diagnosis_events, dim)
    return resolved.select(
        "stay_id",
        "icd_code",
        "icd_version",
        "long_title",
        F.col("diagnoses_icd_key").isNotNull().alias("resolved"),
    )


# --- cleaning and messages ---------------------------------------------------------------


@register_query("clean_events")
def clean_events(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    raw = v.raw_chart_events
    cleaned = clean_chart_events(raw, order_by=[F.col("storetime"), F.col("value")])
    return cleaned.select(
        "subject_id",
        "stay_id",
        "itemid",
        F.col("charttime").cast("timestamp_ntz").alias("charttime"),
        "value",
        "valuenum",
        "valueuom",
        "warning",
    )


@register_query("dedup_micro")
def dedup_micro(spark: SparkSession, path: str) -> DataFrame:
    micro = Views(spark, path).micro_events
    order = ("charttime", "spec_itemid", "quantity", "dilution_value")
    return dedup(micro, ["microevent_id"], [F.col(c) for c in order]).select(
        "microevent_id", "subject_id", *order
    )


def _messages(v: Views) -> DataFrame:
    """Events as keyed JSON messages."""
    rows = v.chart_events.select(
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
    return messages.encode_json(rows, "stay_id")


@register_query("json_roundtrip")
def json_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    good = messages.decode_json(_messages(Views(spark, path)), MESSAGE_DDL).good
    inner = F.get_json_object("value", "$.k").cast("bigint")
    return good.select("event_id", "stay_id", "charttime", "itemid", "valuenum", inner.alias("k"))


def _break(rows: DataFrame) -> DataFrame:
    """Cut the closing brace off the messages of one item."""
    broken = F.col("value").contains('"itemid":"error"')
    cut = F.expr("substring(value, 1, length(value) - 1)")
    return rows.withColumn("value", F.when(broken, cut).otherwise(F.col("value")))


@register_query("json_bad_rows")
def json_bad_rows(spark: SparkSession, path: str) -> DataFrame:
    """Malformed messages with their raw text length, and the good ones by item."""
    split = messages.decode_json(_break(_messages(Views(spark, path))), MESSAGE_DDL)
    good = split.good.groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    bad = split.bad.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("malformed").alias("itemid"), "n"
    )
    return good.unionByName(bad)


@register_query("message_keys")
def message_keys(spark: SparkSession, path: str) -> DataFrame:
    """Messages per partition key."""
    keyed = _messages(Views(spark, path)).groupBy("key")
    return keyed.agg(F.count(F.lit(1)).alias("messages"))


@register_query("delivery_counters")
def delivery_counters(spark: SparkSession, path: str) -> DataFrame:
    rows = Views(spark, path).table("documents").select(F.col("text").alias("value"), "lang")
    return monitor.delivery_counters(rows, F.col("lang") == "en")


@register_query("normalise_rows")
def normalise_rows(spark: SparkSession, path: str) -> DataFrame:
    """Text rows with floats for ints, NaN and junk, as typed rows."""
    events = Views(spark, path).table("events")
    kind = F.col("event_type")
    raw = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("stay_id"),
        F.when(kind == "signup", "NaN").otherwise(F.col("value").cast("string")).alias("valuenum"),
        F.when(kind == "error", "NaN").otherwise(F.upper(kind)).alias("label"),
        F.when(kind == "view", "not a time")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("charttime"),
    )
    ddl = "event_id BIGINT, stay_id INT, valuenum DOUBLE, label STRING, charttime STRING, note STRING"
    return messages.normalise_rows(raw, ddl, iso_columns=("charttime",))


@register_query("iso_times")
def iso_times(spark: SparkSession, path: str) -> DataFrame:
    events = Views(spark, path).table("events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return events.select("event_id", iso_timestamp(text).alias("iso"))


@register_query("validation_split")
def validation_split(spark: SparkSession, path: str) -> DataFrame:
    """Rows that pass a validation rule and rows that it refuses, an undecided rule included."""
    stays = Views(spark, path).stays.select("stay_id", "los")
    split = messages.validate_rows(stays, F.col("los") >= 0)
    good = split.good.withColumn("valid", F.lit(1))
    return good.unionByName(split.bad.select("stay_id", "los").withColumn("valid", F.lit(0)))


# --- quality and loading -----------------------------------------------------------------


@register_query("out_of_range")
def out_of_range(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    flagged = flag_out_of_range(enrich_items(v.chart_events, v.items))
    return flagged.select("event_id", "itemid", "label", "valuenum", "is_critical")


@register_query("not_null_gate")
def not_null_gate(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    gate = quality.require_not_null(v.stays, ["subject_id", "outtime_date", "diagnoses_icd_key"])
    return gate.bad.select("stay_id", "missing")


@register_query("pk_violations")
def pk_violations(spark: SparkSession, path: str) -> DataFrame:
    return quality.pk_violations(Views(spark, path).micro_events, ["microevent_id"])


@register_query("fk_violations")
def fk_violations(spark: SparkSession, path: str) -> DataFrame:
    """Stays whose subject is missing from a dimension that holds living patients only."""
    v = Views(spark, path)
    living = v.patients.filter(F.col("dod").isNull())
    stays = v.stays.select("stay_id", "subject_id")
    return quality.fk_violations(stays, living, "subject_id")


@register_query("fk_violation_counts")
def fk_violation_counts(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    living = v.patients.filter(F.col("dod").isNull())
    return quality.fk_violation_counts(v.stays, living, "subject_id")


@register_query("fk_valid")
def fk_valid(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    living = v.patients.filter(F.col("dod").isNull())
    return quality.fk_valid(v.stays.select("stay_id", "subject_id"), living, "subject_id")


@register_query("insert_absent")
def insert_absent_query(spark: SparkSession, path: str) -> DataFrame:
    """A stored table after the rows that it lacks were appended."""
    stays = Views(spark, path).stays.select("stay_id", "subject_id", "intime_date")
    target = f"{work_path(spark, 'absent')}/stays"
    write_table(stays.filter(F.col("intime_date") < 19980101), target)
    write_table(insert_absent(stays, spark.read.parquet(target), ["stay_id"]), target)
    return spark.read.parquet(target)


@register_query("load_report")
def load_report(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    return quality.load_counters(v.micro_events, "micro", ["microevent_id"]).unionByName(
        quality.load_counters(v.stays, "stays", ["stay_id"])
    )


@register_query("dim_counts")
def dim_counts(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    return quality.row_counts(
        {"patients": v.patients, "diagnoses": v.diagnoses, "stays": v.stays, "items": v.items}
    )


@register_query("dim_samples")
def dim_samples(spark: SparkSession, path: str) -> DataFrame:
    """First five rows of the patient dimension in key order."""
    return Views(spark, path).patients.orderBy("subject_id").limit(5)


@register_query("table_inventory")
def table_inventory_query(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    names = (
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations"
    ).split()
    return table_inventory({n: v.table(n) for n in names})


@register_query("table_profile")
def table_profile(spark: SparkSession, path: str) -> DataFrame:
    return profile(Views(spark, path).table("events"))


@register_query("sql_on_views")
def sql_on_views(spark: SparkSession, path: str) -> DataFrame:
    """A user's own SQL with named parameters over the registered views."""
    Views(spark, path).register()
    text = (
        "SELECT last_careunit, count(*) AS long_stays FROM clinical_stays "
        "WHERE los > :days GROUP BY last_careunit"
    )
    return read_query(spark, text, args={"days": 30})


@register_query("incremental_window")
def incremental_window(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the half-open window between two marks."""
    events = Views(spark, path).chart_events
    lo, hi = datetime(2024, 1, 10), datetime(2024, 1, 20)
    return read_since(events, "charttime", lo, hi).rows.select("event_id", "charttime")


@register_query("incremental_load")
def incremental_load(spark: SparkSession, path: str) -> DataFrame:
    """Fact table after two incremental runs, the second one repeated with nothing new."""
    v = Views(spark, path)
    root = work_path(spark, "incremental")
    silver, target, marks = f"{root}/silver", f"{root}/fact", f"{root}/marks"
    rows = v.chart_events.select(
        "subject_id", "hadm_id", "stay_id", "charttime", "itemid", "value", "valuenum", "warning",
        F.col("charttime").alias("processed_timestamp"),
    )
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (F.col("charttime") < middle, F.col("charttime") >= middle):
        write_table(rows.filter(part), silver)
        loads.load_fact(spark, EVENT_SPEC, silver, target, marks)
    loads.load_fact(spark, EVENT_SPEC, silver, target, marks)
    return spark.read.parquet(target).drop("load_id")


# --- sampling ----------------------------------------------------------------------------


def _events(spark: SparkSession, path: str) -> DataFrame:
    columns = ("event_id", "stay_id", "charttime", "itemid", "valuenum")
    return Views(spark, path).chart_events.select(*columns)


@register_query("sample_uniform")
def sample_uniform(spark: SparkSession, path: str) -> DataFrame:
    return sampling.sample(_events(spark, path), "uniform", 0.1, keys=["event_id"])


@register_query("sample_critical")
def sample_critical(spark: SparkSession, path: str) -> DataFrame:
    v = Views(spark, path)
    flagged = flag_out_of_range(enrich_items(v.chart_events, v.items))
    kept = sampling.critical_sample(flagged, F.col("is_critical"), 0.1, ["event_id"])
    return kept.select("event_id", "itemid", "valuenum", "is_critical")


@register_query("sample_hash")
def sample_hash(spark: SparkSession, path: str) -> DataFrame:
    return sampling.hash_sample(_events(spark, path), "stay_id", 10)


@register_query("sample_stratified")
def sample_stratified(spark: SparkSession, path: str) -> DataFrame:
    return sampling.sample(
        _events(spark, path), "stratified", 0.1, time_col="charttime", keys=["event_id"]
    )


@register_query("sample_random")
def sample_random(spark: SparkSession, path: str) -> DataFrame:
    return sampling.sample(_events(spark, path), "random", 0.25, seed=7, keys=["event_id"])


@register_query("sample_systematic")
def sample_systematic(spark: SparkSession, path: str) -> DataFrame:
    return sampling.systematic_sample(_events(spark, path), 0.1, ["charttime", "event_id"])


# --- features and risk -------------------------------------------------------------------

# Illustrative weights: trained models are supplied by the user.
MORTALITY = feat.LinearModel(
    -4.0, {"age": 0.03, "has_sepsis": 0.8, "shock_index": 0.5, "dx_count": 0.005}
)
READMISSION = feat.LinearModel(-1.0, {"age": 0.01, "dx_count": 0.01, "is_emergency": 0.4})
STAY_LENGTH = (
    feat.LinearModel(0.2, {"has_sepsis": 0.4, "mean_resp_rate": 0.002}),
    feat.LinearModel(0.4, {"has_pneumonia": 0.2}),
    feat.LinearModel(0.6, {"is_male": 0.1, "age": -0.004}),
)


def feature_frame(v: Views) -> DataFrame:
    """Feature row of every monitored stay."""
    vitals = feat.vital_features(v.chart_events, v.monitored, FEATURE_ITEMS)
    dx = feat.diagnosis_features(v.diagnosis_events, "subject_id", FEATURE_KEYWORDS)
    demographic = feat.demographic_columns(
        F.col("anchor_age"), F.col("gender"), F.col("gender"), "BUILDING", "machinery"
    )
    people = v.patients.select("subject_id", "dod", *demographic)
    stays = v.monitored.select("stay_id", "subject_id").join(people, "subject_id", "left")
    return feat.stay_features(stays, vitals, dx.withColumnRenamed("subject_id", "stay_id"))


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {c for c, t in df.dtypes if t == "double"}
    return df.select(
        *[F.round(F.col(c), 6).alias(c) if c in doubles else F.col(c) for c in df.columns]
    )


@register_query("stay_features")
def stay_features(spark: SparkSession, path: str) -> DataFrame:
    return _rounded(feature_frame(Views(spark, path)).drop("dod"))


@register_query("aligned_features")
def aligned_features(spark: SparkSession, path: str) -> DataFrame:
    """Model-ready vector columns; a feature the frame does not have is 0."""
    names = ["age", "mean_heart_rate", "shock_index", "age_group"]
    return _rounded(feat.align_features(feature_frame(Views(spark, path)), names, ["stay_id"]))


@register_query("risk_report")
def risk_report(spark: SparkSession, path: str) -> DataFrame:
    features = feature_frame(Views(spark, path))
    report = feat.risk_report(features, MORTALITY, READMISSION, STAY_LENGTH)
    return _rounded(
        report.select(
            "stay_id",
            "mortality_prob",
            "mortality_tier",
            "readmission_prob",
            "readmission_tier",
            "stay_class",
            "stay_label",
            "stay_confidence",
            F.array_join("reasons", ",").alias("reasons"),
        )
    )


@register_query("reason_counts")
def reason_counts(spark: SparkSession, path: str) -> DataFrame:
    features = feature_frame(Views(spark, path))
    report = feat.risk_report(features, MORTALITY, READMISSION, STAY_LENGTH)
    return report.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("stays")
    )


@register_query("trained_risk")
def trained_risk(spark: SparkSession, path: str) -> DataFrame:
    """Score equations of a death-risk classifier fitted to the feature rows.

    At the optimum of a logistic regression without penalty, the mean of probability times
    feature equals the mean of label times feature, for every feature and the constant 1.
    """
    features = feature_frame(Views(spark, path)).withColumn(
        "died", F.col("dod").isNotNull().cast("double")
    )
    names = ["age", "dx_count", "mean_heart_rate", "mean_sbp", "shock_index"]
    features = materialise(features, "features")
    model = feat.train_classifier(features, names, "died", maxIter=500, tol=1e-14)
    scored = feat.apply_classifier(model, features, names, ["stay_id"])
    filled = features.select("stay_id", *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in names])
    both = scored.join(filled, "stay_id")
    means = [F.avg(F.col("positive_prob") * x) for x in (F.lit(1.0), *map(F.col, names))]
    terms = [
        F.struct(F.lit(t).alias("term"), F.round(m, 4).alias("mean"))
        for t, m in zip(["constant", *names], means, strict=True)
    ]
    return both.agg(F.array(*terms).alias("terms")).select(F.inline("terms"))


# Stays of the test tables last for years: the class limits in days, and what tells them apart.
STAY_LIMITS = {"long": 1000.0, "medium": 300.0}
STAY_TERMS = ["age", "dx_count", "heartrate", "sbp", "o2sat", "acuity"]


def stay_class_frame(v: Views) -> DataFrame:
    """Triage, age and diagnosis count of every stay, with the class of its length."""
    dx = feat.diagnosis_features(v.diagnosis_events, "hadm_id", {}).withColumnRenamed("hadm_id", "stay_id")
    people = v.patients.select("subject_id", F.col("anchor_age").alias("age"))
    stays = v.stays.select("stay_id", "subject_id", stay_class_of(F.col("los"), **STAY_LIMITS).alias("class"))
    joined = stays.join(people, "subject_id", "left").join(v.triage.drop("subject_id"), "stay_id", "left")
    joined = joined.join(dx, "stay_id", "left").drop("subject_id")
    return joined.select("stay_id", "class", *[F.col(c).cast("double").alias(c) for c in STAY_TERMS])


@register_query("trained_stay_class")
def trained_stay_class(spark: SparkSession, path: str) -> DataFrame:
    """Score equations of a multinomial model of the length-of-stay class.

    At the optimum, the mean of probability times feature equals that of membership times feature,
    for every class, every feature and the constant 1.
    """
    features = materialise(stay_class_frame(Views(spark, path)), "stay-classes")
    known = features.filter("class is not null")
    model = feat.train_classifier(
        known, STAY_TERMS, "class", family="multinomial", maxIter=500, tol=1e-14
    )
    scored = feat.class_probabilities(model, known, STAY_TERMS, ["stay_id"], 3)
    both = scored.join(feat.align_features(known, STAY_TERMS, ["stay_id"]), "stay_id")
    terms = [("constant", F.lit(1.0)), *[(n, F.col(n)) for n in STAY_TERMS]]
    means = [
        F.struct(
            F.lit(k).alias("stay_class"),
            F.lit(name).alias("term"),
            F.round(F.avg(F.col(f"prob_{k}") * x), 4).alias("mean"),
        )
        for k in range(3)
        for name, x in terms
    ]
    return both.agg(F.array(*means).alias("means")).select(F.inline("means"))


@register_query("boosted_stay_class")
def boosted_stay_class(spark: SparkSession, path: str) -> DataFrame:
    """Class and probabilities of every stay by three rounds of boosted trees of one split.

    Ages and the other terms have fewer values than bins, so every cut is tried.
    """
    features = materialise(stay_class_frame(Views(spark, path)), "stay-classes")
    model = boosting.train_boosted(features, STAY_TERMS, "class", 3, rounds=3, depth=1, rate=0.5)
    return _rounded(feat.class_probabilities(model, features, STAY_TERMS, ["stay_id"], 3))


# --- streams -----------------------------------------------------------------------------


def _event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The event table as a stream; the glob matches it as one file and as a folder of files."""
    folder = path.rstrip("/")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return read_stream(spark, f"{folder}/events.parque[t]", schema, max_files=1000)


def _stream_messages(spark: SparkSession, path: str) -> DataFrame:
    """The event table as a stream of JSON messages, every message delivered twice."""
    rows = _event_stream(spark, path).select(
        "event_id",
        F.col("user_id").alias("subject_id"),
        F.col("user_id").alias("hadm_id"),
        F.col("user_id").alias("stay_id"),
        F.date_format("ts", STAMP).alias("charttime"),
        F.lit("NaT").alias("storetime"),
        F.col("event_type").alias("itemid"),
        F.col("props").alias("value"),
        F.col("value").alias("valuenum"),
        F.lit(" unit ").alias("valueuom"),
        F.when(F.col("event_type") == "error", "1.0").otherwise("0.0").alias("warning"),
    )
    once = messages.encode_json(rows, "stay_id")
    return once.withColumn("value", F.explode(F.array("value", "value")))


def _disorder(spark: SparkSession, path: str) -> tuple[str, str]:
    """Longest delay of an event in a table of unordered events: the time that they span."""
    events = Views(spark, path).table("events")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    return "charttime", f"{(hi - lo).days + 1 if lo else 1} days"


@register_query("stream_bronze_silver")
def stream_bronze_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver table after messages ran through bronze with every message repeated."""
    root = work_path(spark, "silver")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    landed = jobs.ingest_bronze(
        _stream_messages(spark, path), EVENT_SPEC, bronze, f"{root}/ck", f"{root}/bad",
        available_now=True,
    )
    jobs.drain(landed)
    cleaned = jobs.bronze_to_silver(
        spark, EVENT_SPEC, bronze, silver, f"{root}/ck/silver", _disorder(spark, path),
        max_files=1000, available_now=True,
    )
    jobs.drain([cleaned])
    return spark.read.parquet(silver).select(
        "event_id",
        "stay_id",
        F.col("charttime").cast("timestamp_ntz").alias("charttime"),
        "itemid",
        "valuenum",
        "valueuom",
        "warning",
    )


@register_query("stream_quarantine")
def stream_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Good and quarantined message counts of a stream with malformed messages."""
    root = work_path(spark, "quarantine")
    broken = _break(_stream_messages(spark, path))
    jobs.drain(
        jobs.ingest_bronze(
            broken, EVENT_SPEC, f"{root}/bronze", f"{root}/ck", f"{root}/bad", available_now=True
        )
    )
    counts = {"bronze": f"{root}/bronze", "quarantine": f"{root}/bad"}
    return quality.row_counts({n: spark.read.parquet(p) for n, p in counts.items()})


@register_query("stream_enrich")
def stream_enrich(spark: SparkSession, path: str) -> DataFrame:
    """Stream joined to the item dictionary, thinned out, with all critical events kept."""
    root = work_path(spark, "enrich")
    events = _event_stream(spark, path).select(
        "event_id", F.col("event_type").alias("itemid"), F.col("value").alias("valuenum")
    )
    items = materialise(Views(spark, path).items, "items")
    kept = jobs.enrich_stream(events, items, 0.1, ["event_id"])
    kept = kept.select("event_id", "itemid", "valuenum", "is_critical")
    jobs.drain([write_stream(kept, f"{root}/out", f"{root}/ck", available_now=True)])
    return spark.read.parquet(f"{root}/out")


@register_query("stream_monitor")
def stream_monitor(spark: SparkSession, path: str) -> DataFrame:
    """Rows seen by the monitor over all batches, and the newest event time."""
    root = work_path(spark, "monitor")
    query = monitor.monitor(
        _event_stream(spark, path), f"{root}/metrics", f"{root}/ck", time_col="ts", available_now=True
    )
    jobs.drain([query])
    return monitor.read_metrics(spark, f"{root}/metrics").agg(
        F.max("total_rows").alias("total_rows"),
        F.sum("row_count").alias("row_count"),
        F.max("newest_time").alias("newest_time"),
    )
