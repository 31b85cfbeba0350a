"""Exact percentiles per group whose work is spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Distinct values of a group that one task may order.
CELL_VALUES = 1_000_000
#: Cells that a group with more of them is cut into, and the accuracy of the cuts.
CELLS, ACCURACY = 100, 10_000


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per key with their row count; equal values merge map-side."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    return rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, p: float, alias: str, cell_values: int = CELL_VALUES
) -> DataFrame:
    """``percentile_cont(p)`` of ``value`` per key, exact, one row per key that has a value."""
    counts = materialise(value_counts(df, keys, value), "value-counts")
    return percentile_of_counts(counts, keys, p, alias, cell_values)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys]


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k_{k}") for k in keys]


def _refined(counts: DataFrame, keys: Sequence[str], place: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells of each group that hold its positions, and what lies before them.

    ``counts`` has distinct values ``_v`` and their rows ``_n``; ``place`` has, per group, the first
    and last position wanted, counted from the start of ``counts``.  The cuts are approximate
    quantiles of the distinct values, from mergeable sketches, so a cell has about as many values as
    any other, however they lie.  NaN is the largest value and a cell of its own: no cut holds it.
    """
    n = CELLS
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    ordinary = F.when(~F.isnan("_v"), F.col("_v"))
    cuts = counts.groupBy(*keys).agg(F.percentile_approx(ordinary, shares, ACCURACY).alias("_cuts"))
    cuts = cuts.select(*_renamed(keys), F.array_distinct(F.coalesce("_cuts", F.array())).alias("_cuts"))
    joined = counts.join(cuts, _all(_same(counts, cuts, keys)))
    # The number of cuts below a value never falls as values rise.
    cell = F.when(F.isnan("_v"), n + 1).otherwise(
        F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    )
    placed = joined.select(*keys, "_v", "_n", cell.cast("int").alias("_cell"))
    sized = placed.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_size"))
    upto = Window.partitionBy(*keys).orderBy("_cell")
    bounds = sized.select(*keys, "_cell", "_size", (F.sum("_size").over(upto) - F.col("_size")).alias("_before"))
    wanted = place.select(*_renamed(keys), "_low", "_high")
    held = bounds.join(wanted, _all(_same(bounds, wanted, keys)))
    held = held.filter((F.col("_low") < F.col("_before") + F.col("_size")) & (F.col("_high") >= F.col("_before")))
    # The positions are next to each other, so their cells are, too.
    start = held.groupBy(*keys).agg(F.min("_before").alias("_skip"))
    hit = held.select(*_renamed(keys), F.col("_cell").alias("_c"))
    same = [*_same(placed, hit, keys), placed["_cell"] == hit["_c"]]
    return placed.join(hit, _all(same), "left_semi").drop("_cell"), start


def _narrowed(
    counts: DataFrame, keys: Sequence[str], places: Sequence[Column], cell_values: int
) -> tuple[DataFrame, DataFrame]:
    """What is left of ``counts`` when no group has more than ``cell_values``, and the places in it."""
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_values"))
    place = materialise(totals.select(*keys, *places, "_values"), "percentile-places")
    most = place.agg(F.max("_values")).first()[0] or 0
    while most > cell_values:
        kept, start = _refined(counts, keys, place)
        counts = materialise(kept, "percentile-cells")
        left = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values")).select(*_renamed(keys), "_values")
        start = start.select(*_renamed(keys), "_skip")
        moved = place.drop("_values").join(start, _all(_same(place, start, keys)))
        moved = moved.select(*keys, *[(F.col(c) - F.col("_skip")).alias(c) for c in ("_pos", "_low", "_high")])
        moved = moved.join(left, _all(_same(moved, left, keys))).select(*moved.columns, "_values")
        place = materialise(moved, "percentile-places")
        before, most = most, place.agg(F.max("_values")).first()[0] or 0
        if most >= before:  # neighbouring values that lie in two cells: nothing left to part
            break
    return counts, place


def percentile_of_counts(
    counts: DataFrame, keys: Sequence[str], p: float, alias: str, cell_values: int = CELL_VALUES
) -> DataFrame:
    """Exact percentile from the output of :func:`value_counts`, which is best written before.

    Groups of up to ``cell_values`` distinct values are ordered by one task each.  While a group has
    more, it is cut into cells and only those that hold the wanted positions are looked at further,
    so no task orders more, whatever the values are; infinities and NaN have their places.
    """
    keys = list(keys)
    counts = counts.filter(F.col("_v").isNotNull())
    within = Window.partitionBy(*keys)
    position = F.lit(p) * (F.col("_total") - 1)
    places = [position.alias("_pos"), F.floor(position).alias("_low"), F.ceil(position).alias("_high")]
    values = [*keys, "_v", "_n", F.sum("_n").over(within.orderBy("_v")).alias("_end")]
    # No group has more values than there are rows; only if that is too many are they counted.
    if counts.count() <= cell_values:
        ordered = counts.select(*values, F.sum("_n").over(within).alias("_total")).select("*", *places)
    else:
        counts, place = _narrowed(counts, keys, places, cell_values)
        ordered, wanted = counts.select(*values), place.select(*_renamed(keys), "_pos", "_low", "_high")
        ordered = ordered.join(wanted, _all(_same(ordered, wanted, keys)))

    def value_at(position: str) -> Column:
        inside = (F.col("_end") - F.col("_n") <= F.col(position)) & (F.col(position) < F.col("_end"))
        return F.max(F.when(inside, F.col("_v")))

    found = ordered.groupBy(*keys).agg(
        value_at("_low").alias("_lo"),
        value_at("_high").alias("_hi"),
        F.max(F.col("_pos") - F.col("_low")).alias("_w"),
    )
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")
    exact = F.when((F.col("_lo") == F.col("_hi")) | (F.col("_w") == 0), F.col("_lo")).otherwise(between)
    return found.select(*keys, exact.alias(alias))
