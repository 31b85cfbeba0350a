"""Bronze -> silver cleaning; the same transforms run on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, nan_to_null, null_tokens_to_null
from .dedup import dedup, dedup_stream

# Business keys of the two event streams.
CHART_KEYS = ("subject_id", "hadm_id", "stay_id", "charttime", "itemid")
CHART_REQUIRED = ("subject_id", "stay_id", "itemid", "charttime")
MICRO_KEYS = ("microevent_id",)


def require_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every named column is present."""
    return df.dropna("any", subset=list(columns))


def _unique(df, keys, order_by, spread, horizon):
    if df.isStreaming:
        return dedup_stream(df, keys, horizon, spread)
    return dedup(df, keys, order_by)


def _stamped(df: DataFrame, stamp: Column | None) -> DataFrame:
    return df.withColumn("processed_timestamp", F.current_timestamp() if stamp is None else stamp)


def parse_timestamp(df: DataFrame, name: str) -> Column:
    """Column as a timestamp; unreadable text (such as ``NaT``) becomes NULL."""
    kind = dict(df.dtypes)[name]
    return F.try_to_timestamp(F.col(name)) if kind == "string" else F.col(name)


def clean_chart_events(
    df: DataFrame,
    order_by: Sequence[Column] | None = None,
    spread: int = 0,
    horizon: tuple[str, str] | None = None,
    stamp: Column | None = None,
) -> DataFrame:
    """Silver chart events: complete keys, one row per event key, typed, trimmed, stamped.

    The null filter runs before the dedup: its columns are part of the key, so the result is
    the same and less is shuffled or kept as state.
    """
    unique = _unique(require_all(df, CHART_REQUIRED), CHART_KEYS, order_by, spread, horizon)
    types = dict(df.dtypes)
    warning = F.col("warning")
    if types["warning"] == "boolean":
        warning = warning.cast("int")
    else:
        # "0.0" is how an int flag looks after a trip through a floating column.
        warning = nan_to_null(warning.try_cast("double")).try_cast("int")
    typed = {
        "valuenum": nan_to_null(F.col("valuenum").try_cast("double")),
        "warning": warning,
        "charttime": parse_timestamp(df, "charttime"),
        "value": blank_to_null(null_tokens_to_null(F.col("value"))),
        "valueuom": blank_to_null(null_tokens_to_null(F.col("valueuom"))),
    }
    return _stamped(unique.withColumns(typed), stamp)


def clean_micro_events(
    df: DataFrame,
    order_by: Sequence[Column] | None = None,
    spread: int = 0,
    horizon: tuple[str, str] | None = None,
    stamp: Column | None = None,
) -> DataFrame:
    """Silver microbiology events: one row per event id, ``charttime`` as a timestamp.

    A stream is typed before its dedup, which then moves the time once and not as text; a batch
    after it, as ``order_by`` is on the columns as they arrive.
    """
    rows = require_all(df, MICRO_KEYS)
    if df.isStreaming:
        rows = rows.withColumn("charttime", parse_timestamp(rows, "charttime"))
    unique = _unique(rows, MICRO_KEYS, order_by, spread, horizon)
    return _stamped(unique.withColumn("charttime", parse_timestamp(unique, "charttime")), stamp)
