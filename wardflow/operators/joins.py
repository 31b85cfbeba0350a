"""Many-to-one joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most keys that are looked at as hot, and counters of the sketch that finds them.
HOT_KEYS, TRACKED = 64, 4096


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def heavy_keys(df: DataFrame, on: Sequence[str], parts: int | None = None) -> DataFrame:
    """One row with ``hot``: a map from the hash of a heavy key to its number of lanes.

    A mergeable frequent-items sketch counts key hashes in one pass over the key columns.  A key is
    heavy if it has more rows than two of ``parts`` equal parts of the table (by default the shuffle
    partitions), or one row in ``HOT_KEYS`` where the parts are more; it gets a lane per such part.
    So the lanes of all heavy keys together are no more than the parts.
    """
    parts = parts or shuffle_partitions(df)
    hashes = df.select(_key_hash([F.col(k) for k in on]).alias("_h"))
    counted = hashes.agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_accumulate(_h, {TRACKED}), {HOT_KEYS})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    part = F.col("n") / F.lit(parts)
    least = F.greatest(2 * part, F.col("n") / F.lit(HOT_KEYS))
    heavy = F.filter("top", lambda t: (t["count"] >= least) & (t["count"] > 1))
    lanes = F.transform(heavy, lambda t: F.struct(t["item"], F.ceil(t["count"] / part).cast("int")))
    return counted.select(F.coalesce(F.map_from_entries(lanes), F.create_map().cast("map<bigint,int>")).alias("hot"))


def spread_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    parts: int | None = None,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Join fact rows to a side with one row per key, NULL keys matching NULL.

    Rows of heavy keys (see :func:`heavy_keys`) are dealt to lanes by a hash of the row, and the one
    row of such a key on the other side is repeated once per lane; all other rows stay in lane 0 and
    are joined plainly, so ``one`` is shuffled once but for the heavy keys.  AQE cannot spread these
    by itself where a following aggregation by the key reuses the partitioning of the join; here it
    starts with partial results instead.  The sketch is a scalar subquery: it runs with the join,
    once for both sides, and nothing passes the driver.  ``keys_of`` names a frame with the same
    keys that is cheaper to read, such as the table that ``many`` was joined from.
    """
    types = dict(many.dtypes)
    hot = heavy_keys((many if keys_of is None else keys_of).select(*[F.col(k).cast(types[k]) for k in on]), on, parts)
    # Hashes depend on the type, so both sides take that of the fact.
    lanes = F.coalesce(
        F.try_element_at(hot.scalar(), _key_hash([F.col(k).cast(types[k]) for k in on])), F.lit(1)
    )
    row = F.pmod(F.xxhash64(*many.columns), lanes).cast("int")
    left = many.withColumn("_lane", row)
    rest = [c for c in one.columns if c not in on]
    right = one.select(
        *[F.col(k).alias(f"_on_{k}") for k in on],
        *rest,
        F.explode(F.sequence(F.lit(0), lanes - 1)).alias("_right_lane"),
    )
    same = [left[k].eqNullSafe(right[f"_on_{k}"]) for k in on]
    same.append(left["_lane"] == right["_right_lane"])
    joined = left.join(right, reduce(lambda a, b: a & b, same), how)
    return joined.select(*many.columns, *rest)
