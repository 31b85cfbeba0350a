"""Rows <-> keyed JSON messages, with malformed messages kept apart."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_timestamp, nan_to_null, null_tokens_to_null
from ..schemas import column_names, split_ddl

CORRUPT = "_corrupt_record"


class Split(NamedTuple):
    """Rows that passed, and rows that did not with the raw text or reason kept."""

    good: DataFrame
    bad: DataFrame


def decode_json(df: DataFrame, ddl: str, value_col: str = "value") -> Split:
    """Parse JSON text into typed columns; malformed or wrongly typed messages go to ``bad``.

    ``good`` has the flat columns of ``ddl``; ``bad`` keeps the raw text under ``raw``.
    """
    text = F.col(value_col).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(text, f"{ddl}, {CORRUPT} STRING", options)
    # As the input of a generator the text is parsed once per row; as a plain column the parse
    # would be copied into the filters below.
    rows = df.select(text.alias("raw"), F.inline(F.array(parsed)))
    broken = F.col(CORRUPT).isNotNull() | F.col("raw").isNull()
    return Split(
        rows.filter(~broken).select(*column_names(ddl)), rows.filter(broken).select("raw")
    )


def encode_json(df: DataFrame, key_col: str, keep_nulls: bool = True) -> DataFrame:
    """Rows as ``(key, value)`` messages: the key as text, the whole row as one JSON object."""
    options = {
        "ignoreNullFields": str(not keep_nulls).lower(),
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns), options).alias("value"),
    )


def _lenient(col: Column, source_type: str, target: str) -> Column:
    target = target.upper()
    if target in ("INT", "BIGINT", "SMALLINT"):
        # "12.0" is an int that went through a floating column.
        return F.coalesce(col.try_cast(target), col.try_cast("DOUBLE").try_cast(target))
    if target == "DOUBLE":
        return nan_to_null(col.try_cast(target))
    if target.startswith("TIMESTAMP"):
        return F.try_to_timestamp(col) if source_type == "string" else col.try_cast(target)
    if target == "STRING":
        return null_tokens_to_null(col.cast(target))
    return col.try_cast(target)


def normalise_rows(df: DataFrame, ddl: str, iso_columns: tuple[str, ...] = ()) -> DataFrame:
    """Raw text rows as typed message rows: lenient casts, null-like values to NULL.

    Columns missing from the input come out NULL; ``iso_columns`` keep timestamps as ISO text.
    """
    types = dict(df.dtypes)
    out = []
    for name, target in split_ddl(ddl):
        if name not in types:
            out.append(F.lit(None).cast(target).alias(name))
        elif name in iso_columns:
            out.append(iso_timestamp(null_tokens_to_null(F.col(name))).alias(name))
        else:
            out.append(_lenient(F.col(name), types[name], target).alias(name))
    return df.select(*out)


def validate_rows(df: DataFrame, rule: Column) -> Split:
    """Split by a validation rule; an undecided (NULL) rule counts as invalid."""
    holds = F.coalesce(rule, F.lit(False))
    return Split(df.filter(holds), df.filter(~holds))


def for_ordered_topic(df: DataFrame, key_col: str, order_col: str, partitions: int = 6) -> DataFrame:
    """Lay rows out so that the events of one key sit in one partition in time order."""
    return df.repartition(partitions, key_col).sortWithinPartitions(key_col, order_col)
