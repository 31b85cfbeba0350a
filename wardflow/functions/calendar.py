"""Calendar keys: timestamps <-> (``YYYYMMDD`` int, second-of-day int), all as integer columns."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KeyMapping(NamedTuple):
    """One timestamp column and the two key columns derived from it."""

    source: str
    date_col: str
    time_col: str

    @classmethod
    def of(cls, source: str) -> KeyMapping:
        return cls(source, f"{source}_date", f"{source}_time")


def date_key(ts: Column) -> Column:
    """``YYYYMMDD`` as int; NULL in, NULL out."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_key(ts: Column) -> Column:
    """Second of the day, 0..86399; the fraction of a second is cut off."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def add_calendar_keys(
    df: DataFrame, mappings: Iterable[KeyMapping], drop_source: bool = False
) -> DataFrame:
    """Add the key pair of every mapping in one projection, keeping or dropping the sources."""
    mappings = list(mappings)
    dropped = {m.source for m in mappings} if drop_source else set()
    kept = [F.col(c) for c in df.columns if c not in dropped]
    keys = []
    for m in mappings:
        keys.append(date_key(F.col(m.source)).alias(m.date_col))
        keys.append(time_key(F.col(m.source)).alias(m.time_col))
    return df.select(*kept, *keys)


def key_to_date(key: Column) -> Column:
    """Date of a ``YYYYMMDD`` key; NULL for a key that is no calendar day."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def keys_to_timestamp(d_key: Column, t_key: Column) -> Column:
    """Inverse of :func:`date_key` and :func:`time_key` at second precision."""
    return F.try_make_timestamp_ntz(
        (d_key / 10000).cast("int"),
        (d_key / 100).cast("int") % 100,
        d_key % 100,
        (t_key / 3600).cast("int"),
        (t_key / 60).cast("int") % 60,
        (t_key % 60).cast("decimal(16,6)"),
    )


def interval_seconds(
    start_date: Column, start_time: Column, end_date: Column, end_time: Column
) -> Column:
    """Length of an interval given as two key pairs; integer arithmetic, free of time zones."""
    days = F.date_diff(key_to_date(end_date), key_to_date(start_date)).cast("bigint")
    return days * 86400 + end_time - start_time


def date_attributes(day: Column) -> list[Column]:
    """Columns of the date dimension for a DATE column; ``week`` is the ISO week."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    ]


def time_attributes(second_of_day: Column) -> list[Column]:
    """Columns of the time dimension for a second-of-day column."""
    s = second_of_day.cast("int")
    hour = (s / 3600).cast("int")
    minute = (s % 3600 / 60).cast("int")
    second = s % 60
    return [
        s.alias("time_key"),
        F.format_string("%02d:%02d:%02d", hour, minute, second).alias("time_value"),
        hour.alias("hour"),
        minute.alias("minute"),
        second.alias("second"),
    ]
