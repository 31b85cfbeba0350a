"""High-water marks: gap-free windows over an append-only table.

Marks are instants, kept as naive datetimes in UTC, so that no change of the session's time zone
or of daylight saving moves them.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: mark before the first run.
FIRST_MARK = datetime(2000, 1, 1)
EPOCH = datetime(1970, 1, 1)

MARK_DDL = "name STRING, version BIGINT, mark TIMESTAMP_NTZ"


class Slice(NamedTuple):
    rows: DataFrame
    lo: datetime
    hi: datetime


def load_mark(spark: SparkSession, path: str, name: str) -> tuple[datetime, int]:
    """Latest mark and its version; the start mark when nothing was saved yet."""
    try:
        marks = spark.read.schema(MARK_DDL).parquet(path)
    except AnalysisException as error:
        # Only a folder that is not there yet means a first run; anything else must not reload all.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return FIRST_MARK, 0
    row = (
        marks.filter(F.col("name") == name)
        .agg(F.max(F.struct("version", "mark")).alias("m"))
        .first()
    )
    return (row["m"]["mark"], row["m"]["version"]) if row["m"] else (FIRST_MARK, 0)


def save_mark(spark: SparkSession, path: str, name: str, mark: datetime) -> None:
    """Append a new version of the mark; earlier versions stay, so no moment is without one.

    A mark never goes back: a smaller one is an error.
    """
    before, version = load_mark(spark, path, name)
    if version and mark < before:
        raise ValueError(f"mark of {name} would go back from {before} to {mark}")
    row = spark.createDataFrame([(name, version + 1, mark)], MARK_DDL)
    row.coalesce(1).write.mode("append").parquet(path)


def read_since(df: DataFrame, ts_col: str, lo: datetime, hi: datetime | None = None) -> Slice:
    """Rows in the half-open window (lo, hi]; hi defaults to the newest stamp in the snapshot.

    A fixed upper end makes consecutive windows tile the table: rows that arrive during the run
    belong to the next window.  Both ends are typed literals, so the filter reaches the scan.
    Columns without a time zone are taken as UTC.
    """
    is_instant = dict(df.dtypes)[ts_col] == "timestamp"

    def bound(mark: datetime):
        # Via a number or text, because a naive datetime literal would be read in local time.
        if is_instant:
            return F.timestamp_micros(F.lit((mark - EPOCH) // timedelta(microseconds=1)))
        return F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")

    newer = df.filter(F.col(ts_col) > bound(lo))
    if hi is None and is_instant:
        micros = newer.agg(F.max(F.unix_micros(F.col(ts_col)))).first()[0]
        hi = lo if micros is None else EPOCH + timedelta(microseconds=micros)
    elif hi is None:
        hi = newer.agg(F.max(F.col(ts_col))).first()[0] or lo
    return Slice(newer.filter(F.col(ts_col) <= bound(hi)), lo, hi)
