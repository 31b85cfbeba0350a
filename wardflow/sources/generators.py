"""Generated calendars and literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_attributes, time_attributes

# Range of the de-identified calendar.
DEFAULT_START, DEFAULT_END = "2100-01-01", "2299-12-31"


def date_dim(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    first = F.lit(start).cast("date")
    span = spark.range(1).select(
        F.explode(F.sequence(first, F.lit(end).cast("date"))).alias("full_date")
    )
    return span.select(*date_attributes(F.col("full_date")))


def date_dim_over(df: DataFrame, *columns: str) -> DataFrame:
    """Date dimension spanning every date of the given columns, derived from the data."""
    lows = F.least(*[F.min(c) for c in columns]) if len(columns) > 1 else F.min(columns[0])
    highs = F.greatest(*[F.max(c) for c in columns]) if len(columns) > 1 else F.max(columns[0])
    span = df.agg(lows.cast("date").alias("lo"), highs.cast("date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return days.select(*date_attributes(F.col("full_date")))


def time_dim(spark: SparkSession) -> DataFrame:
    """One row per second of the day, 86,400 rows."""
    return spark.range(86400).select(*time_attributes(F.col("id")))


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
