"""Joins of facts to their dimensions.

No size is assumed: dimension joins carry no hint, so Spark broadcasts by measured size and AQE
splits skewed keys of a sort-merge join.  Only the calendar dimensions, whose row counts are
bounded by the calendar (86,400 seconds; days, of which ten thousand years have 3.7 million), are
broadcast outright.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import out_of_range
from ..functions.text import keyword_class


def with_date(df: DataFrame, dates: DataFrame, key_col: str, how: str = "left") -> DataFrame:
    """All date-dimension columns for one date key."""
    return df.join(F.broadcast(dates), df[key_col] == dates["date_key"], how)


def with_pruned_months(
    df: DataFrame, dates: DataFrame, key_col: str, month_col: str = "month"
) -> DataFrame:
    """Inner join of a fact stored by month to the wanted days of the date dimension.

    The month is part of the join, so the scan of the fact is pruned at run time to the months that
    the filtered dimension has.  No filter on the fact has to be written by hand.
    """
    days = dates.withColumn("_month", F.floor(F.col("date_key") / 100).cast("int"))
    same = (df[key_col] == days["date_key"]) & (df[month_col] == days["_month"])
    return df.join(F.broadcast(days), same).drop("_month", month_col)


def with_calendar(
    df: DataFrame, dates: DataFrame, times: DataFrame, date_col: str, time_col: str
) -> DataFrame:
    """Inner star join to both calendar dimensions: adds ``chart_date`` and ``hour_of_day``."""
    day = dates.select(F.col("date_key").alias("_dk"), F.col("full_date").alias("chart_date"))
    second = times.select(F.col("time_key").alias("_tk"), F.col("hour").alias("hour_of_day"))
    return (
        df.join(F.broadcast(day), df[date_col] == F.col("_dk"))
        .join(F.broadcast(second), df[time_col] == F.col("_tk"))
        .drop("_dk", "_tk")
    )


def enrich_items(events: DataFrame, items: DataFrame) -> DataFrame:
    """Events with their item's label and normal bounds; unknown items stay with NULLs."""
    return events.join(items, "itemid", "left")


def flag_out_of_range(df: DataFrame, name: str = "is_critical") -> DataFrame:
    flag = out_of_range(F.col("valuenum"), F.col("lownormalvalue"), F.col("highnormalvalue"))
    return df.withColumn(name, flag)


def with_status(
    stays: DataFrame, diagnoses: DataFrame, keyword: str, yes="Sepsis", no="Non-Sepsis",
    name: str = "sepsis_status",
) -> DataFrame:
    """Stays with the class of their diagnosis title; no diagnosis counts as ``no``."""
    titled = diagnoses.select("diagnoses_icd_key", "long_title")
    joined = stays.join(titled, "diagnoses_icd_key", "left")
    return joined.withColumn(name, keyword_class(F.col("long_title"), keyword, yes, no))
