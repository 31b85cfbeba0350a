"""The registered dimension and fact specs run on the test tables, from source files to tables.

Each source is a test table in the columns of its DDL, with flaws that the load must handle: rows
given twice, rows without a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup
from ..schemas import SOURCE_DDL, split_ddl
from ..session import work_path
from ..sinks.tables import write_table
from ..sources.readers import read_table
from ..specs import DIMS, FACTS, register_query
from ..streaming import jobs
from . import analytics as q
from . import loads
from .views import ClinicalViews as Views


def _as_source(df: DataFrame, name: str, columns: dict[str, Column]) -> DataFrame:
    """Columns of a source table; what is not given is NULL."""
    fields = split_ddl(SOURCE_DDL[name])
    return df.select(*[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in fields])


def admissions(v: Views) -> DataFrame:
    """One admission per order; every 40th is given twice and every 50th also without its key."""
    stays = v.with_discharge(v.table("orders").withColumn("stay_id", F.col("o_orderkey")))
    start, end, status = F.col("o_orderdate"), F.col("outtime"), F.col("o_orderstatus")
    rows = _as_source(
        stays,
        "admissions",
        {
            "subject_id": F.col("o_custkey"),
            "hadm_id": F.col("o_orderkey"),
            "admittime": start,
            "dischtime": end,
            "deathtime": F.when(status == "F", end),
            "admission_type": F.col("o_orderpriority"),
            "admit_provider_id": F.concat(F.lit("P"), F.col("o_custkey").cast("string")),
            "admission_location": status,
            "insurance": F.lit("Other"),
            "language": F.lit("EN"),
            "race": F.col("o_orderpriority"),
            "edregtime": start - F.expr("INTERVAL 2 HOURS"),
            "edouttime": start - F.expr("INTERVAL 30 SECONDS"),
            "hospital_expire_flag": (status == "F").cast("int"),
        },
    )
    again = rows.filter(F.col("hadm_id") % 40 == 0)
    keyless = rows.filter(F.col("hadm_id") % 50 == 0).withColumn("hadm_id", F.lit(None).cast("int"))
    return rows.unionByName(again).unionByName(keyless)


def micro(v: Views) -> DataFrame:
    """One microbiology event per order and line number; seventh lines have no id.

    Of several lines with one number the earliest is the event, so that it is known which copy
    a stream keeps.  Lines are dealt by order: one shuffle and one sort serve both that choice and
    the join.
    """
    line = F.col("l_linenumber")
    order = [F.col(c) for c in ("l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice")]
    lines = dedup(v.table("lineitem").repartition("l_orderkey"), ["l_orderkey", "l_linenumber"], order)
    lines = lines.join(v.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return _as_source(
        lines,
        "microbiologyevents",
        {
            "microevent_id": F.when(line < 7, F.col("l_orderkey") * 10 + line),
            "subject_id": F.col("o_custkey"),
            "hadm_id": F.col("l_orderkey"),
            "micro_specimen_id": F.col("l_partkey"),
            "order_provider_id": F.concat(F.lit("P"), F.col("l_suppkey").cast("string")),
            "charttime": F.col("l_shipdate"),
            "spec_itemid": F.col("l_suppkey"),
            "spec_type_desc": F.col("l_returnflag"),
            "test_seq": line,
            "test_itemid": F.col("l_partkey") % 1000,
            "test_name": F.col("l_linestatus"),
            "org_itemid": F.col("l_suppkey") % 10,
            "org_name": F.col("l_linestatus"),
            "isolate_num": line,
            "quantity": F.col("l_quantity").cast("int").cast("string"),
            "dilution_comparison": F.lit("<="),
            "dilution_value": F.col("l_extendedprice"),
            "interpretation": F.col("l_returnflag"),
        },
    )


def chart(v: Views) -> DataFrame:
    """Chart events as they arrive, in the columns of the source."""
    item = F.length("itemid") * 1000 + F.ascii("itemid")
    raw = v.raw_chart_events
    given = {c: F.col(c) for c in raw.columns if c != "itemid"}
    return _as_source(raw, "chartevents", {**given, "itemid": item})


def _flawed(rows: DataFrame, key: str) -> DataFrame:
    """Some rows given twice, some also without their key."""
    again = rows.filter(F.col(key) % 40 == 0)
    keyless = rows.filter(F.col(key) % 50 == 0).withColumn(key, F.lit(None).cast("int"))
    return rows.unionByName(again).unionByName(keyless)


def items(v: Views) -> DataFrame:
    """The item dictionary, its text item codes as numbers."""
    code = F.length("itemid") * 1000 + F.ascii("itemid")
    given = {c: F.col(c) for c in ("label", "category", "unitname", "lownormalvalue", "highnormalvalue")}
    kind = {"itemid": code, "linksto": F.lit("chartevents"), "param_type": F.lit("Numeric")}
    return _flawed(_as_source(v.items, "d_items", {**given, **kind}), "itemid")


def patients(v: Views) -> DataFrame:
    given = {c: F.col(c) for c in ("subject_id", "gender", "anchor_age", "dod")}
    rows = _as_source(v.patients, "patients", {**given, "anchor_year": F.col("anchor_age") + 2000})
    return _flawed(rows, "subject_id")


def triage(v: Views) -> DataFrame:
    given = {c: F.col(c) for c in v.triage.columns}
    return _flawed(_as_source(v.triage, "triage", {**given, "pain": F.lit("unable")}), "stay_id")


def icu_stays(v: Views) -> DataFrame:
    given = {c: F.col(c) for c in v.stays.columns}
    return _flawed(_as_source(v.stays, "icustays", given), "stay_id")


def ed_stays(v: Views) -> DataFrame:
    raw = v.stays.join(v.ed_stays.select("stay_id", "gender", "race", "arrival_transport", "disposition"), "stay_id")
    return _flawed(_as_source(raw, "edstays", {c: F.col(c) for c in raw.columns}), "stay_id")


def load_dim(spark: SparkSession, table: str, sources: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Write sources as CSV, load one registered dimension; its rows and its report."""
    root = work_path(spark, table)
    paths = {}
    for name, df in sources.items():
        paths[name] = f"{root}/{name}"
        df.write.option("header", True).csv(paths[name])
    report = loads.load_dims(spark, {table: DIMS[table]}, paths, f"{root}/wh")
    return spark.read.parquet(f"{root}/wh/{table}"), report


def silver(spark: SparkSession, name: str, source: DataFrame, time: str, copies: int = 1) -> str:
    """Run a source, given ``copies`` times, through the registered bronze-to-silver stream; the silver folder.

    The source is computed once: its copies and its span of time are read from bronze.
    """
    root = work_path(spark, f"{name}-silver")
    write_table(source, f"{root}/bronze", compression="zstd")
    landed = spark.read.parquet(f"{root}/bronze")
    for _ in range(1, copies):
        write_table(landed, f"{root}/bronze", compression="zstd")
    stamp = F.col(time).try_cast("timestamp").cast("date")
    lo, hi = landed.agg(F.min(stamp), F.max(stamp)).first()
    # The rows are in no order, so a copy may be as late as all that they span.
    horizon = (time, f"{(hi - lo).days + 1 if lo else 1} days")
    query = jobs.bronze_to_silver(
        spark, FACTS[name], f"{root}/bronze", f"{root}/silver", f"{root}/ck", horizon,
        max_files=1000, available_now=True,
    )
    jobs.drain([query])
    return f"{root}/silver"


def load_fact(spark: SparkSession, name: str, folder: str) -> DataFrame:
    root = work_path(spark, f"{name}-fact")
    loads.load_fact(spark, FACTS[name], folder, f"{root}/fact", f"{root}/marks")
    return spark.read.parquet(f"{root}/fact").drop("load_id")


@register_query("load_dim_admission")
def load_dim_admission(spark: SparkSession, path: str) -> DataFrame:
    """The admission dimension: five times as key pairs, 21 columns."""
    return load_dim(spark, "dim_admission", {"admissions": admissions(Views(spark, path))})[0]


def _diagnosis_sources(v: Views) -> dict[str, DataFrame]:
    events = v.diagnosis_events.select("subject_id", "hadm_id", "seq_num", "icd_code", "icd_version")
    return {"diagnoses_icd": events, "d_icd_diagnoses": v.diagnosis_dictionary}


@register_query("load_dim_diagnoses")
def load_dim_diagnoses(spark: SparkSession, path: str) -> DataFrame:
    """The diagnosis dimension; whether its keys are distinct stands in for their values."""
    loaded = load_dim(spark, "dim_diagnoses_icd", _diagnosis_sources(Views(spark, path)))[0]
    return loaded.drop("diagnoses_icd_key")


def _registered(table: str, source: str, rows) -> None:
    register_query(
        f"load_{table}", lambda spark, path: load_dim(spark, table, {source: rows(Views(spark, path))})[0]
    )


_registered("dim_d_items", "d_items", items)
_registered("dim_patients", "patients", patients)
_registered("dim_triage", "triage", triage)
_registered("fact_icustays", "icustays", icu_stays)
_registered("fact_edstays", "edstays", ed_stays)


@register_query("balance_files")
def balance_files(spark: SparkSession, path: str) -> DataFrame:
    """Input, output and balance files, typed and read back: the sums of the first two per stay
    beside what the third says for it."""
    v, root = Views(spark, path), work_path(spark, "balance")
    stays = v.stays.select("stay_id", "subject_id", "hadm_id", "intime", "outtime")
    placed = {"inputevents": v.inputs.withColumn("unit", F.lit("ml")), "outputevents": v.outputs}
    amounts = {
        "inputevents": {"amount": F.col("amount"), "amountuom": F.lit("ml"), "starttime": F.col("intime")},
        "outputevents": {"value": F.col("value"), "valueuom": F.lit("ml"), "charttime": F.col("intime")},
    }
    read = {}
    for name, rows in placed.items():
        known = {c: F.col(c) for c in ("stay_id", "subject_id", "hadm_id")}
        source = _as_source(rows.join(stays, "stay_id"), name, {**known, **amounts[name]})
        source.write.option("header", True).csv(f"{root}/{name}")
        read[name] = read_table(spark, f"{root}/{name}", "csv", SOURCE_DDL[name])
    told = q.last_stay(q.fluid_balance(v.stays, v.inputs, v.outputs), v.patients)
    told = _as_source(told, "fluid_balance_last_stay", {c: F.col(c) for c in told.columns})
    told.write.option("header", True).csv(f"{root}/told")
    told = read_table(spark, f"{root}/told", "csv", SOURCE_DDL["fluid_balance_last_stay"])
    sums = q.fluid_balance(stays, read["inputevents"], read["outputevents"])
    told = told.select("stay_id", F.col("fluid_balance_ml").alias("told_ml"), "dod")
    wanted = ("stay_id", "subject_id", "total_input_ml", "total_output_ml", "fluid_balance_ml")
    return sums.select(*wanted).join(told, "stay_id", "left")


@register_query("load_report_dims")
def load_report_dims(spark: SparkSession, path: str) -> DataFrame:
    """Counters of two dimension loads."""
    v = Views(spark, path)
    first = load_dim(spark, "dim_admission", {"admissions": admissions(v)})[1]
    second = load_dim(spark, "dim_diagnoses_icd", _diagnosis_sources(v))[1]
    return first.unionByName(second).drop("error")


@register_query("load_fact_chartevents")
def load_fact_chartevents(spark: SparkSession, path: str) -> DataFrame:
    """Chart events from bronze through silver to the fact of 11 columns, once per key."""
    folder = silver(spark, "icu_chartevents", chart(Views(spark, path)), "charttime")
    # Which of two copies survives in a stream is open, so only what they share is returned.
    return load_fact(spark, "icu_chartevents", folder).drop("value")


@register_query("stream_micro_silver")
def stream_micro_silver(spark: SparkSession, path: str) -> DataFrame:
    """Microbiology events, given twice, through the registered stream: one row per id, none without."""
    folder = silver(spark, "hosp_microbiologyevents", micro(Views(spark, path)), "charttime", copies=2)
    kept = ("microevent_id", "subject_id", "hadm_id", "charttime", "org_name", "dilution_value")
    rows = spark.read.parquet(folder).select(*kept)
    return rows.withColumn("charttime", F.col("charttime").cast("timestamp_ntz"))


@register_query("load_fact_micro")
def load_fact_micro(spark: SparkSession, path: str) -> DataFrame:
    """The microbiology fact of 21 columns."""
    folder = silver(spark, "hosp_microbiologyevents", micro(Views(spark, path)), "charttime", copies=2)
    return load_fact(spark, "hosp_microbiologyevents", folder)


@register_query("ordered_reports")
def ordered_reports(spark: SparkSession, path: str) -> DataFrame:
    """Place of every row of three ordered reports (few rows each), to check their order."""
    v = Views(spark, path)
    reports = {
        "unit": (q.stays_by_unit(v.stays), "first_careunit"),
        "year": (q.stays_by_year(v.stays, v.admission_dates), "year"),
        "code": (q.top_codes(v.stays, v.diagnoses, 10), "icd_code"),
    }
    out = None
    for name, (df, key) in reports.items():
        place = (F.monotonically_increasing_id() + 1).alias("place")
        one = df.coalesce(1).select(F.lit(name).alias("report"), F.col(key).cast("string").alias("item"), place)
        out = one if out is None else out.unionByName(one)
    return out
