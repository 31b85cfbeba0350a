"""Load shedding.

Samples that name key columns draw from a hash of those columns and a seed, not from a random
generator: a row keeps or loses its place whatever task reads it, so a recomputed partition
after an executor loss yields the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

METHODS = ("uniform", "critical", "hash", "stratified", "random", "systematic", "none")


def keyed_draw(keys: Sequence[str | Column], rate: float | Column, seed: int = 42) -> Column:
    """True for a ``rate`` share of the distinct keys: the 32-bit hash lies below rate * 2**32."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    unsigned = F.hash(F.lit(seed), *columns).cast("bigint") + F.lit(1 << 31)
    if isinstance(rate, Column):
        return unsigned < F.floor(rate * float(1 << 32))
    return unsigned < F.lit(int(rate * (1 << 32)))


def uniform_sample(
    df: DataFrame, rate: float, keys: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Keep each row with probability ``rate``; keyed by ``keys`` or by the whole row."""
    return df.filter(keyed_draw(keys or df.columns, rate, seed))


def critical_sample(
    df: DataFrame,
    critical: Column,
    rate: float,
    keys: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Keep every critical row and a ``rate`` share of the others (NULL is not critical)."""
    keep = F.coalesce(critical, F.lit(False)) | keyed_draw(keys or df.columns, rate, seed)
    return df.filter(keep)


def hash_sample(df: DataFrame, id_col: str, modulus: int = 10) -> DataFrame:
    """Keep or drop whole entities: those whose hash is divisible by ``modulus``."""
    return df.filter(F.pmod(F.hash(F.col(id_col)), F.lit(modulus)) == 0)


def stratified_sample(
    df: DataFrame,
    stratum: Column,
    rate: float | dict,
    keys: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Sample every stratum at its rate without listing the strata on the driver.

    ``rate`` is one share for all strata or a dict for named strata (others are dropped, as in
    ``sampleBy``).  The stratum takes part in the draw, so strata are sampled independently.
    """
    share: float | Column = rate if not isinstance(rate, dict) else F.lit(0.0)
    if isinstance(rate, dict):
        for value, part in rate.items():
            share = F.when(stratum == F.lit(value), F.lit(float(part))).otherwise(share)
    return df.filter(keyed_draw([stratum, *(keys or df.columns)], share, seed))


def random_sample(
    df: DataFrame, rate: float, keys: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Simple random sample without replacement; without keys it is Spark's own ``sample``."""
    if keys is None:
        return df.sample(False, rate, seed)
    return uniform_sample(df, rate, keys, seed)


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "row_num", partitions: int | None = None
) -> DataFrame:
    """Global row number 1..N in the given total order, without a single-task window.

    Rows are range-partitioned over all order columns and sorted, which gives each row its place
    inside its partition; the place in the table adds the sizes of the earlier partitions.  The
    partitioned rows are written to the shared folder in between, so both steps see the same
    partitions whatever is recomputed.  The order columns must identify a row (dedup first);
    then no value of the first one, however frequent, ends up in one task.
    """
    spread = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    placed = spread.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = materialise(placed, "numbered")
    # The id holds the partition number above bit 33 and the row's place below it.
    part = F.shiftright("_at", 33)
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    # One row per partition: one small ordered window, and a broadcast of bounded size.
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_skip"))
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (inside + F.col("_skip") + 1).alias(name))


def systematic_sample(
    df: DataFrame, rate: float, order: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Every n-th row in a total order, n = int(1 / rate)."""
    if not 0 < rate <= 1:
        raise ValueError("rate must be in (0, 1]")
    step = int(1 / rate)
    numbered = number_rows(df, order, "_n", partitions)
    return numbered.filter(F.col("_n") % step == 0).drop("_n")


def sample(df: DataFrame, method: str = "none", rate: float = 0.1, seed: int = 42, **kw) -> DataFrame:
    """Dispatch by configured method name; an unknown method keeps every row, as ``none`` does."""
    keys = kw.get("keys")
    if method == "uniform":
        return uniform_sample(df, rate, keys, seed)
    if method == "critical":
        return critical_sample(df, kw["critical"], rate, keys, seed)
    if method == "hash":
        return hash_sample(df, kw["id_col"], kw.get("modulus", max(1, int(1 / rate))))
    if method in ("stratified", "stratified_time"):
        stratum = kw.get("stratum")
        if stratum is None:
            stratum = F.to_date(F.col(kw["time_col"]))
        return stratified_sample(df, stratum, rate, keys, seed)
    if method == "random":
        return random_sample(df, rate, keys, seed)
    if method == "systematic":
        return systematic_sample(df, rate, kw["order"], kw.get("partitions"))
    return df
