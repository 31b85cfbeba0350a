"""Queries on stored layouts: sketches for roll-ups, bucketed tables, facts by month."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distinct import distinct_sketches, roll_up
from ..operators.enrich import with_pruned_months
from ..session import materialise, work_path
from ..sinks.tables import drop_tables, write_bucketed, write_by_month
from ..specs import register_query
from .views import ClinicalViews as Views

#: Buckets of the tables of the bucketed query.
BUCKETS = 8


@register_query("subjects_by_year_unit")
def subjects_by_year_unit(spark: SparkSession, path: str) -> DataFrame:
    """Subjects per year and unit from sketches stored per day and unit, beside the exact number.

    ``within`` tells whether the estimate lies within its stated relative error of the exact count.
    """
    stays = Views(spark, path).stays.select("intime_date", "first_careunit", "subject_id")
    stored = materialise(
        distinct_sketches(stays, ["intime_date", "first_careunit"], "subject_id"), "sketches"
    )
    year = F.floor(F.col("intime_date") / 10000).cast("int").alias("year")
    rough = roll_up(stored, [year, "first_careunit"], "estimate")
    exact = stays.groupBy(year, "first_careunit").agg(F.count_distinct("subject_id").alias("subjects"))
    both = rough.join(exact, ["year", "first_careunit"])
    off = F.abs(F.col("estimate") - F.col("subjects"))
    within = (off <= F.col("relative_error") * F.col("subjects")).cast("int")
    return both.select(
        "year", "first_careunit", "rows", "subjects", within.alias("within"), "relative_error"
    )


def join_bucketed(stays: DataFrame, triage: DataFrame) -> DataFrame:
    """Vital signs of stays; without a shuffle where both sides are bucketed by stay."""
    return stays.join(triage, "stay_id").select("stay_id", "los", "heartrate", "acuity")


@register_query("bucketed_vitals")
def bucketed_vitals(spark: SparkSession, path: str) -> DataFrame:
    """Stays with triage from two tables bucketed by stay; the tables are dropped afterwards."""
    v, root, run = Views(spark, path), work_path(spark, "bucketed"), uuid.uuid4().hex
    names = {f"fact_stays_{run}": v.stays.select("stay_id", "los"), f"dim_triage_{run}": v.triage}
    stays, triage = (
        write_bucketed(df, name, ["stay_id"], BUCKETS, f"{root}/{name}") for name, df in names.items()
    )
    joined = materialise(join_bucketed(stays, triage), "bucketed-vitals")
    drop_tables(spark, list(names))
    return joined


@register_query("quarter_by_unit")
def quarter_by_unit(spark: SparkSession, path: str) -> DataFrame:
    """Stays of the second quarter of 1995 per unit and ISO week, from a fact stored by month."""
    v, target = Views(spark, path), f"{work_path(spark, 'by-month')}/stays"
    write_by_month(v.stays.select("stay_id", "first_careunit", "intime_date"), "intime_date", target)
    days = v.admission_dates.filter((F.col("year") == 1995) & (F.col("quarter") == 2))
    joined = with_pruned_months(spark.read.parquet(target), days, "intime_date")
    return joined.groupBy("first_careunit", "week").agg(F.count(F.lit(1)).alias("stays"))
