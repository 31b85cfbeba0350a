"""Data-quality gates and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.messages import Split
from .joins import spread_join


def require_not_null(df: DataFrame, columns: Sequence[str]) -> Split:
    """Rows with every required column, and the rejected rows with the list of gaps."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in columns]))
    rejected = df.filter(~present).withColumn("missing", F.array_join(gaps, ","))
    return Split(df.filter(present), rejected)


def pk_violations(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or are incomplete, with their row count."""
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    counted = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | incomplete)


def fk_violations(fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Fact rows whose non-null key has no dimension row.

    The anti join runs on the distinct keys of the fact (reduced map-side); only offending keys
    go back to the fact rows, which are dealt to lanes so that an offender of many rows is spread.
    """
    pk = pk or fk
    keys = fact.select(fk).filter(F.col(fk).isNotNull()).distinct()
    orphans = keys.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")
    return spread_join(fact, orphans, [fk])


def fk_violation_counts(fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Offending keys with their number of fact rows; the fact is counted before the join."""
    pk = pk or fk
    counted = (
        fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counted.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")


def fk_valid(fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None) -> DataFrame:
    """Fact rows whose key exists in the dimension."""
    pk = pk or fk
    return fact.join(dim.select(F.col(pk).alias(fk)).distinct(), fk, "left_semi")


def load_counters(df: DataFrame, table: str, pk: Sequence[str]) -> DataFrame:
    """One row: rows read, rows left after dedup and key checks, rows dropped, share kept.

    The counts come from one aggregation: rows are counted per key map-side, then summed.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pk])
    per_key = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"),
        F.count_if(complete).alias("rows_kept"),
        F.coalesce(F.sum(F.when(complete, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(~complete, F.col("n"))), F.lit(0)).alias("incomplete_keys"),
    )
    rate = F.round(F.try_divide(F.lit(100.0) * F.col("rows_kept"), F.col("rows_read")), 2)
    return totals.select(F.lit(table).alias("table_name"), "*", rate.alias("kept_pct"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
