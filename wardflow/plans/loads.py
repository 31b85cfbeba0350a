"""Load jobs: incremental facts, dimensions with per-table isolation."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import add_calendar_keys
from ..operators.incremental import load_mark, read_since, save_mark
from ..operators.quality import require_not_null
from ..operators.sampling import sample
from ..operators.star import key_clean, project
from ..sinks.tables import replace_folder, write_by_month
from ..sources.readers import read_table
from ..specs import DimSpec, FactSpec

REPORT_DDL = (
    "table_name STRING, status STRING, rows_read BIGINT, rows_sampled BIGINT, "
    "rows_written BIGINT, rows_rejected BIGINT, error STRING"
)


def fact_rows(df: DataFrame, spec: FactSpec) -> DataFrame:
    """Silver rows as fact rows: calendar keys, projection, required-key gate."""
    keyed = project(add_calendar_keys(df, spec.mappings), spec.target_ddl)
    return require_not_null(keyed, spec.required).good


def load_fact(
    spark: SparkSession,
    spec: FactSpec,
    silver: str,
    target: str,
    marks: str,
    month_of: str | None = None,
    **sampling,
) -> DataFrame:
    """Load the silver rows that arrived since the last mark; returns a one-row report.

    One pass writes and counts.  The output folder is named after the window's lower end, which
    stays the same until the mark is saved: a run repeated after a crash replaces the folder it
    left behind, so nothing is loaded twice.

    ``month_of`` names a date-key column by whose month the folder is partitioned, for pruning by
    later queries; rows are rebalanced first, which splits a heavy month and merges light ones.
    """
    lo, _ = load_mark(spark, marks, spec.name)
    window = read_since(spark.read.parquet(silver), "processed_timestamp", lo)
    if window.hi == lo:
        return spark.createDataFrame([(spec.table, "empty", 0, 0, 0, 0, None)], REPORT_DDL)
    read, drawn, kept = (Observation(n) for n in ("read", "drawn", "kept"))
    count = F.count(F.lit(1)).alias("n")
    method = sampling.pop("method", spec.sampling_method)
    rate = sampling.pop("rate", spec.sampling_rate)
    sampling.setdefault("keys", list(spec.keys))
    sampling.setdefault("time_col", spec.event_time)
    sampling.setdefault("order", ["processed_timestamp", *spec.keys])
    # A systematic sample reads its input twice (to find range bounds, then to sort), which an
    # observed counter would add up; its input is counted by itself.
    recounted = method == "systematic"
    source = window.rows if recounted else window.rows.observe(read, count)
    sampled = sample(source, method, rate, **sampling)
    rows = fact_rows(sampled.observe(drawn, count), spec).observe(kept, count)
    folder = f"{target}/load_id=since-{lo:%Y%m%dT%H%M%S.%f}"
    if month_of:
        write_by_month(rows, month_of, folder)
    else:
        rows.write.mode("overwrite").parquet(folder)
    save_mark(spark, marks, spec.name, window.hi)
    n_read = window.rows.count() if recounted else read.get["n"]
    n_drawn, n_kept = drawn.get["n"], kept.get["n"]
    report = (spec.table, "loaded", n_read, n_drawn, n_kept, n_drawn - n_kept, None)
    return spark.createDataFrame([report], REPORT_DDL)


def keyed_rows(spec: DimSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Source frames in the columns of one dimension or interval fact, before its key gate."""
    frames = [sources[name] for name in spec.sources]
    built = spec.build(*frames) if spec.build else frames[0]
    return project(add_calendar_keys(built, spec.mappings, drop_source=True), spec.target_ddl)


def dim_rows(spec: DimSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Source frames as the rows of one dimension or interval fact."""
    return key_clean(keyed_rows(spec, sources), spec.pk, spec.surrogates)


def load_dim(
    spark: SparkSession, spec: DimSpec, paths: Mapping[str, str], target: str, fmt: str = "csv"
) -> tuple:
    """Load one dimension; its folder is replaced once all is written, so a run can be repeated.

    ``rows_read`` counts the rows of all sources, ``rows_sampled`` those that reach the key gate
    (what :attr:`DimSpec.build` makes of them) and ``rows_rejected`` those that it refuses.
    """
    count = F.count(F.lit(1)).alias("n")
    read = {name: Observation(f"read-{name}") for name in spec.sources}
    sources = {
        name: read_table(spark, paths[name], fmt, ddl).observe(read[name], count)
        for name, ddl in spec.sources.items()
    }
    built, kept = Observation("built"), Observation("kept")
    rows = keyed_rows(spec, sources).observe(built, count)
    replace_folder(key_clean(rows, spec.pk, spec.surrogates).observe(kept, count), target)
    n_read = sum(o.get["n"] for o in read.values())
    n_built, n_kept = built.get["n"], kept.get["n"]
    return (spec.table, "loaded", n_read, n_built, n_kept, n_built - n_kept, None)


def load_dims(
    spark: SparkSession,
    specs: Mapping[str, DimSpec],
    paths: Mapping[str, str],
    target_root: str,
    fmt: str = "csv",
) -> DataFrame:
    """Load every dimension; a table that fails is reported and the others go on."""
    report = []
    for name, spec in specs.items():
        try:
            report.append(load_dim(spark, spec, paths, f"{target_root}/{name}", fmt))
        except Exception as error:  # noqa: BLE001 - isolation is the point
            report.append((name, "failed", None, None, None, None, str(error)))
    return spark.createDataFrame(report, REPORT_DDL)


def last_mark(spark: SparkSession, marks: str, spec: FactSpec) -> datetime:
    return load_mark(spark, marks, spec.name)[0]
