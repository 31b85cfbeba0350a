"""Clinical tables seen through the star-schema test tables.

Each property is a lazy frame; nothing is read until a query runs, and column pruning reaches
the Parquet scans through the views.  Timestamps stay ``timestamp_ntz`` from end to end.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import KeyMapping, add_calendar_keys
from ..sources import generators
from ..sources.readers import read_table

STAY_TIMES = (KeyMapping.of("intime"), KeyMapping.of("outtime"))
CHART_TIMES = (KeyMapping.of("charttime"),)
# Word of the diagnosis titles that stands for the condition of interest.
CONDITION = "widget"
FEATURE_KEYWORDS = {
    "has_sepsis": "widget",
    "has_heart_failure": "gizmo",
    "has_pneumonia": "bolt",
    "has_resp_failure": "ring",
}
FEATURE_ITEMS = {
    "heart_rate": "click",
    "sbp": "view",
    "spo2": "purchase",
    "resp_rate": "error",
    "temperature": "signup",
}


class ClinicalViews:
    """Lazy clinical frames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        # Footers are read once per set of views, so a rewritten table is seen by the next set.
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, f"{self.path}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def admission_dates(self) -> DataFrame:
        """Date dimension over every admission day of the data."""
        return generators.date_dim_over(self.table("orders"), "o_orderdate")

    @cached_property
    def event_dates(self) -> DataFrame:
        """Date dimension over every day of the event table."""
        return generators.date_dim_over(self.table("events"), "ts")

    @cached_property
    def dates(self) -> DataFrame:
        """Date dimension over admissions and events, for SQL users."""
        days = self.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))
        more = self.table("events").select(F.col("ts").cast("date").alias("day"))
        return generators.date_dim_over(days.unionByName(more), "day")

    @cached_property
    def times(self) -> DataFrame:
        return generators.time_dim(self.spark)

    @cached_property
    def patients(self) -> DataFrame:
        balance = F.col("c_acctbal")
        return self.table("customer").select(
            F.col("c_custkey").alias("subject_id"),
            F.col("c_mktsegment").alias("gender"),
            (F.floor(F.abs(balance)) % 100).cast("int").alias("anchor_age"),
            F.when(balance < 0, F.lit("2005-01-01").cast("date")).alias("dod"),
        )

    @cached_property
    def admissions(self) -> DataFrame:
        """Stays as far as orders alone tell."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("stay_id"),
            F.col("o_custkey").alias("subject_id"),
            F.col("o_orderdate").alias("intime"),
        )

    def with_discharge(self, stays: DataFrame) -> DataFrame:
        """Stays with the time of their last line."""
        lines = self.table("lineitem").groupBy(F.col("l_orderkey").alias("stay_id"))
        return stays.join(lines.agg(F.max("l_shipdate").alias("outtime")), "stay_id", "left")

    @cached_property
    def stays(self) -> DataFrame:
        """One stay per order; length of stay and diagnosis come from its lines."""
        lines = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("stay_id"))
            .agg(
                F.max("l_shipdate").alias("outtime"),
                F.min("l_partkey").alias("diagnoses_icd_key"),
            )
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("stay_id"),
            F.col("o_custkey").alias("subject_id"),
            F.col("o_orderkey").alias("hadm_id"),
            F.col("o_orderpriority").alias("first_careunit"),
            F.col("o_orderstatus").alias("last_careunit"),
            F.col("o_orderdate").alias("intime"),
        )
        joined = orders.join(lines, "stay_id", "left")
        los = F.date_diff(F.col("outtime"), F.col("intime")).cast("double")
        return add_calendar_keys(joined.withColumn("los", los), STAY_TIMES)

    @cached_property
    def ed_stays(self) -> DataFrame:
        lines = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("stay_id"))
            .agg(F.max("l_shipdate").alias("outtime"))
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("stay_id"),
            F.col("o_custkey").alias("subject_id"),
            F.col("o_orderstatus").alias("gender"),
            F.col("o_orderpriority").alias("race"),
            F.col("o_orderpriority").alias("arrival_transport"),
            F.col("o_orderstatus").alias("disposition"),
            F.col("o_orderdate").alias("intime"),
        )
        return add_calendar_keys(orders.join(lines, "stay_id", "left"), STAY_TIMES, True)

    @cached_property
    def diagnoses(self) -> DataFrame:
        """Diagnosis dimension with one key per part."""
        return self.table("part").select(
            F.col("p_partkey").alias("diagnoses_icd_key"),
            F.col("p_brand").alias("icd_code"),
            F.col("p_size").alias("icd_version"),
            F.col("p_name").alias("long_title"),
        )

    @cached_property
    def _coded(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_partkey").alias("diagnoses_icd_key"),
            F.col("l_linenumber").alias("seq_num"),
        )

    @cached_property
    def diagnosis_codes(self) -> DataFrame:
        """Coded diagnoses per admission, one per order line, without the subject."""
        return self._coded.join(self.diagnoses, "diagnoses_icd_key").drop("diagnoses_icd_key")

    @cached_property
    def diagnosis_events(self) -> DataFrame:
        """Coded diagnoses with subject and admission.

        The join by diagnosis comes last: grouping by admission then shuffles partial results and
        leaves AQE free to split a hot admission in the first join.
        """
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id")
        )
        coded = self._coded.join(orders, "hadm_id").join(self.diagnoses, "diagnoses_icd_key")
        return coded.select(
            "subject_id", "hadm_id", "seq_num", "icd_code", "icd_version", "long_title"
        )

    @cached_property
    def diagnosis_dictionary(self) -> DataFrame:
        return self.diagnoses.select("icd_code", "icd_version", "long_title")

    @cached_property
    def triage(self) -> DataFrame:
        def vital(col):
            return col.cast("decimal(10,4)")

        low, high = F.min("l_quantity"), F.max("l_quantity")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("stay_id"))
            .agg(
                vital(F.lit(35) + high / 10).alias("temperature"),
                vital(F.lit(50) + high).alias("heartrate"),
                vital(F.lit(10) + low / 2).alias("resprate"),
                vital(F.lit(100) - F.max("l_discount") * 100).alias("o2sat"),
                vital(F.lit(80) + low).alias("sbp"),
                vital(F.lit(50) + low).alias("dbp"),
                vital(F.max("l_linenumber")).alias("acuity"),
                F.min("l_returnflag").alias("chiefcomplaint"),
                F.min("l_suppkey").alias("subject_id"),
            )
        )

    @cached_property
    def chart_events(self) -> DataFrame:
        events = self.table("events").select(
            F.col("event_id"),
            F.col("user_id").alias("subject_id"),
            F.col("user_id").alias("hadm_id"),
            F.col("user_id").alias("stay_id"),
            F.col("event_type").alias("itemid"),
            F.col("ts").alias("charttime"),
            F.col("props").alias("value"),
            F.col("value").alias("valuenum"),
            (F.col("event_type") == "error").cast("int").alias("warning"),
        )
        return add_calendar_keys(events, CHART_TIMES)

    @cached_property
    def raw_chart_events(self) -> DataFrame:
        """Events as they arrive: text times, padded or blank values, every event sent twice."""
        blank = F.col("event_type") == "signup"
        stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        once = self.table("events").select(
            F.col("user_id").alias("subject_id"),
            F.lit(None).cast("bigint").alias("hadm_id"),
            F.when(F.col("value") >= 1, F.col("user_id")).alias("stay_id"),
            F.date_format("ts", stamp).alias("charttime"),
            F.date_format("ts", stamp).alias("storetime"),
            F.col("event_type").alias("itemid"),
            F.when(blank, "   ").otherwise(F.concat(F.lit("  "), "props", F.lit(" "))).alias("value"),
            F.col("value").alias("valuenum"),
            F.when(blank, "NaN").otherwise(" unit ").alias("valueuom"),
            F.when(F.col("event_type") == "error", "1.0").otherwise("0.0").alias("warning"),
        )
        again = once.withColumn("storetime", F.lit("NaT")).withColumn("value", F.lit("late copy"))
        return once.unionByName(again)

    @cached_property
    def items(self) -> DataFrame:
        """Item dictionary derived from the events; one item has no normal bounds."""
        kind = F.col("event_type")
        bounded = kind != "signup"
        half = F.floor(F.avg("value") / 2).cast("double")
        double = F.floor(F.avg("value") * 2).cast("double")
        counted = self.table("events").groupBy(kind).agg(half.alias("lo"), double.alias("hi"))
        return counted.select(
            kind.alias("itemid"),
            F.upper(kind).alias("label"),
            F.when(kind.isin("click", "view"), "browse")
            .when(kind == "error", F.lit(None))
            .otherwise("account")
            .alias("category"),
            F.lit("unit").alias("unitname"),
            F.when(bounded, F.col("lo")).alias("lownormalvalue"),
            F.when(bounded, F.col("hi")).alias("highnormalvalue"),
        )

    @cached_property
    def micro_events(self) -> DataFrame:
        lines = self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("microevent_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_suppkey").alias("spec_itemid"),
            F.col("l_returnflag").alias("spec_type_desc"),
            F.col("l_linenumber").alias("test_seq"),
            F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("org_name"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("dilution_value"),
            F.col("l_shipdate").alias("charttime"),
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id")
        )
        return lines.join(orders, "hadm_id")

    @cached_property
    def inputs(self) -> DataFrame:
        lines = self.table("lineitem").filter(F.col("l_returnflag") != "N")
        return lines.select(F.col("l_orderkey").alias("stay_id"), F.col("l_quantity").alias("amount"))

    @cached_property
    def outputs(self) -> DataFrame:
        lines = self.table("lineitem").filter(F.col("l_returnflag") == "N")
        return lines.select(F.col("l_orderkey").alias("stay_id"), F.col("l_quantity").alias("value"))

    @cached_property
    def monitored(self) -> DataFrame:
        """One monitored stay per user of the event table, from first to last event."""
        spans = (
            self.table("events")
            .groupBy(F.col("user_id").alias("stay_id"))
            .agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"))
        )
        return spans.withColumn("subject_id", F.col("stay_id"))

    def register(self) -> None:
        """Expose the frames as session views for SQL users."""
        for name in ("patients", "stays", "ed_stays", "diagnoses", "triage", "chart_events",
                     "items", "micro_events", "inputs", "outputs", "dates", "times"):
            getattr(self, name).createOrReplaceTempView(f"clinical_{name}")
