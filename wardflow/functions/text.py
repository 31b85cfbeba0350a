"""Text helpers: blanks, null-like tokens, keyword classes, ISO timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts under which a missing value travels through a JSON message.
NULL_TOKENS = ("NaN", '"NaN"', "NaT")


def blank_to_null(col: Column) -> Column:
    trimmed = F.trim(col)
    return F.nullif(trimmed, F.lit(""))


def null_tokens_to_null(col: Column) -> Column:
    return F.when(~col.isin(*NULL_TOKENS), col)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def contains_keyword(col: Column, keyword: str) -> Column:
    """Case-insensitive substring test; NULL text gives NULL."""
    return F.contains(F.lower(col), F.lit(keyword.lower()))


def keyword_class(col: Column, keyword: str, yes, no) -> Column:
    """``yes`` where the keyword occurs, ``no`` elsewhere, also for NULL text."""
    return F.when(contains_keyword(col, keyword), F.lit(yes)).otherwise(F.lit(no))


def iso_timestamp(col: Column) -> Column:
    """Any readable timestamp text as ISO-8601; unreadable text passes through unchanged.

    A UTC offset stays, and the clock time before it is the one that was written.
    """
    offset = F.regexp_extract(col, r"\d{2}(?::\d{2})?(?:\.\d+)?\s*(Z|[+-]\d{2}:?\d{2})\s*$", 1)
    clock = F.regexp_replace(col, r"\s*(?:Z|[+-]\d{2}:?\d{2})\s*$", "")
    ts = F.try_to_timestamp(F.when(offset != "", clock).otherwise(col))
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    whole = F.date_trunc("second", ts) == ts
    return F.coalesce(F.concat(F.when(whole, plain).otherwise(micros), offset), col)
