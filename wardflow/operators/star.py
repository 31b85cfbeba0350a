"""Star-schema building: dimensions, surrogate keys, warehouse projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COLUMN_VARIANTS, split_ddl
from .dedup import dedup


def surrogate_key(*columns: str) -> Column:
    """Key computed from the business key: equal on every run and after any recomputation."""
    return F.xxhash64(*columns)


def project(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast to the columns of a table; bad values become NULL."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in split_ddl(ddl)])


def adapt_columns(df: DataFrame, table: str) -> DataFrame:
    """Rename the columns of an older layout of a table; other columns stay as they are."""
    return df.withColumnsRenamed(COLUMN_VARIANTS.get(table, {}))


def key_clean(df: DataFrame, pk: Sequence[str], surrogates: Sequence[str] = ()) -> DataFrame:
    """One row per complete primary key; of several, the smallest by its other columns.

    A fixed choice, so that a repeated or recomputed load yields the same dimension.  Computed
    ``surrogates`` do not take part in it.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in {*pk, *surrogates}]
    return dedup(df.dropna(subset=list(pk)), pk, rest or None)


def diagnosis_dim(diagnoses: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Diagnosis dimension at (code, version, title) grain with the smallest sequence number.

    The event side is reduced to its (code, version) minimum before the join, so the join moves
    one row per code instead of one per diagnosis.
    """
    code = ["icd_code", "icd_version"]
    lowest = diagnoses.groupBy(*code).agg(F.min("seq_num").alias("seq_num"))
    titles = dictionary.select(*code, "long_title").distinct()
    joined = lowest.join(titles, code, "inner")
    return joined.select(
        surrogate_key("icd_code", "icd_version", "long_title").alias("diagnoses_icd_key"),
        "seq_num",
        "icd_code",
        "icd_version",
        "long_title",
    )


def keyed_dictionary(dictionary: DataFrame) -> DataFrame:
    """Distinct titles with the key that :func:`diagnosis_dim` gives them."""
    titles = dictionary.select("icd_code", "icd_version", "long_title").distinct()
    key = surrogate_key("icd_code", "icd_version", "long_title")
    return titles.withColumn("diagnoses_icd_key", key)


def primary_diagnosis(diagnoses: DataFrame, by: Sequence[str]) -> DataFrame:
    """Diagnosis with the smallest sequence number per admission; ties go to the smaller code.

    ``min`` over a struct aggregates map-side, so a hot admission is reduced before it moves.
    """
    first = F.min(F.struct("seq_num", "icd_code", "icd_version"))
    return (
        diagnoses.groupBy(*by)
        .agg(first.alias("d"))
        .select(*by, "d.seq_num", "d.icd_code", "d.icd_version")
    )


def resolve_diagnosis_key(
    stays: DataFrame,
    diagnoses: DataFrame,
    dim: DataFrame,
    by: Sequence[str] = ("subject_id", "hadm_id"),
) -> DataFrame:
    """Stays with the dimension key of their primary diagnosis; NULL where there is none."""
    by = list(by)
    primary = primary_diagnosis(diagnoses, by).drop("seq_num")
    titled = dedup(
        dim.select("icd_code", "icd_version", "diagnoses_icd_key", "long_title"),
        ["icd_code", "icd_version"],
        [F.col("long_title").asc_nulls_last()],
    )
    return stays.join(primary, by, "left").join(titled, ["icd_code", "icd_version"], "left")
