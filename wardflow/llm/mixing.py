"""Mixing sources to target weights by temperature.

Token shares ``p`` of the sources are raised to a power ``a`` and normalised.  Bisection finds the
power between 0 (all sources alike) and 1 (as they are) whose weights meet a target entropy, then
raises it as far as a limit on repetition asks.  The weights become token budgets.  A budget holds
whole passes over its source and a part of one more: documents are dealt to blocks by a hash, the
blocks of a source are put in a permuted order, and the part takes whole blocks while they fit,
then whole parts of the block in which the budget ends, and the first documents, by hash, of the
last such part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

#: Sources that may pass the driver; beyond it ``source_col`` is not a column of sources.
MAX_SOURCES = 100_000
#: Blocks of a source; a table of at most this many times the sources is broadcast if it is small.
BLOCKS = 256
#: Parts of the block in which a budget ends.
PARTS = 4096
BROADCAST_ROWS = 200_000


def entropy(weights: np.ndarray) -> float:
    used = weights[weights > 0]
    return float(-(used * np.log(used)).sum())


def tempered(shares: np.ndarray, power: float) -> np.ndarray:
    raised = np.where(shares > 0, shares, 0.0)
    raised[shares > 0] **= power
    return raised / raised.sum() if raised.sum() else raised


def budgets_for(weights: np.ndarray, tokens: np.ndarray, total: int | None) -> np.ndarray:
    """Token budgets; without a total, the least by which every source is used once in full."""
    if total is None:
        used = tokens > 0
        total = float((tokens[used] / weights[used]).max()) if used.any() else 0
    return weights * total


def find_power(
    tokens: np.ndarray, total: int | None, target_entropy: float | None, max_repeats: float | None
) -> float:
    """The least power in [0, 1] that meets both; 1 where even that cannot meet a limit.

    ``target_entropy`` is a share of the largest possible entropy.  Entropy falls, and the largest
    repetition too, as the power rises, so each limit is found by bisection.
    """
    shares = tokens / tokens.sum()
    most = np.log(max((tokens > 0).sum(), 1))

    def even(power: float) -> bool:
        return entropy(tempered(shares, power)) <= target_entropy * most

    def within(power: float) -> bool:
        budget = budgets_for(tempered(shares, power), tokens, total)
        used = tokens > 0
        return (budget[used] / tokens[used]).max() <= max_repeats

    low_end = 0.0
    checks = [c for c, v in ((even, target_entropy), (within, max_repeats)) if v is not None]
    for met in checks or [lambda power: power >= 1]:
        low, high = low_end, 1.0
        if met(low):
            continue
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if met(middle) else (middle, high)
        low_end = high
    return low_end


def _unit(*parts: Column | str) -> Column:
    return F.xxhash64(*parts)


def mix_sources(
    df: DataFrame,
    tokens: Column,
    source_col: str = "source",
    id_col: str = "doc_id",
    total_tokens: int | None = None,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    seed: int = 17,
) -> DataFrame:
    """The rows of the mixture: all columns of ``df`` once per use, with ``mix_epoch`` and ``mix_order``.

    ``tokens`` is the token count of a row, an expression over the columns of ``df``.
    ``total_tokens`` is the budget of the whole mixture, by default the least with which no row is
    left out.  ``mix_epoch`` numbers the passes over a source from 0.  Sorting by ``mix_order`` gives
    the permuted mixture: ``place`` runs from 0 to 1 along the budget of each source, so that any
    stretch of the order has about the target weights, first passes and later ones alike; ``block``
    and ``row`` are the permuted numbers behind it.  A source exceeds its budget by less than one
    document.

    A null source is a source of its own.  A row of no tokens (a null count is none) costs nothing
    and is used in each pass of its block; a source of no tokens at all is used once.  A null id
    counts as an id of its own.  Rows of equal ids go together, ordered by tokens.  An empty table
    yields no rows.  Input columns named ``mix_epoch`` or ``mix_order``, in any case, give way to
    those of the result; others are kept, whatever their names.

    Only sums are shuffled, per (source, block), then per part of the block in which a budget ends,
    and the ids and tokens of the last such part: 1 in ``BLOCKS * PARTS`` of a source.  No text moves.
    """
    spark = df.sparkSession
    names = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: F.col(f"c{names.index(n)}") for n in (source_col, id_col)}
    shown = [i for i, n in enumerate(names) if n.lower() not in ("mix_epoch", "mix_order")]
    sized = df.withColumn("__mix_tokens", F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)).cast("long"))
    rows = (
        sized.toDF(*flat.columns, "__mix_tokens")
        .select(
            F.struct(*flat.columns).alias("row"),
            at[source_col].cast("string").alias("source"),
            at[id_col].alias("id"),
            F.col("__mix_tokens").alias("tokens"),
        )
        .withColumn("block", F.pmod(_unit(F.lit(seed), "id"), F.lit(BLOCKS)).cast("int"))
        .withColumn("part", F.pmod(_unit(F.lit(seed), F.lit("part"), "id"), F.lit(PARTS)).cast("int"))
    )
    sums = materialise(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    sources = sums.groupBy("source").agg(F.sum("tokens").alias("tokens")).limit(MAX_SOURCES + 1).collect()
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} values in {source_col}")
    sources.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    have = np.array([float(r["tokens"]) for r in sources])
    if have.sum():
        power = find_power(have, total_tokens, target_entropy, max_repeats)
        budget = budgets_for(tempered(have / have.sum(), power), have, total_tokens)
    else:
        budget = have
    plan = []
    for r, b in zip(sources, budget, strict=True):
        passes, rest = divmod(int(round(b)), r["tokens"]) if r["tokens"] else (1, 0)
        plan.append((r["source"], int(passes), int(rest), int(r["tokens"])))
    plans = spark.createDataFrame(plan, "source string, passes int, rest long, have long")

    order = W.partitionBy("source").orderBy("shuffled", "block").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        sums.alias("s")
        .join(F.broadcast(plans).alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        .select("s.source", "s.block", "passes", "rest", "have", F.col("s.tokens").alias("inside"))
        .withColumn("shuffled", _unit(F.lit(seed), F.lit("blocks"), "block"))
        .withColumn("before", F.coalesce(F.sum("inside").over(order), F.lit(0)))
    )
    ends_here = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("inside") > F.col("rest"))
    placed = materialise(placed.withColumn("ends", ends_here), "mix-order")
    last = _last_rows(rows, placed.filter("ends"), seed)

    small = len(sources) * BLOCKS <= BROADCAST_ROWS
    where = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.block") == F.col("b.block"))
    joined = rows.alias("r").join((F.broadcast(placed) if small else placed).alias("b"), where)
    joined = joined.select(
        "r.row", "r.id", "r.tokens", "r.source", "r.part", "passes", "rest", "have", "before", "inside", "shuffled", "ends",
    )
    if last.count() <= BROADCAST_ROWS:
        used = _decided(joined, F.broadcast(last))
    else:  # only the rows of the ending blocks move
        used = _decided(joined.filter("ends"), last)
        begun = (F.col("before") < F.col("rest")).cast("int")
        used = used.unionByName(joined.filter("NOT ends").withColumn("uses", F.col("passes") + begun))
    epochs = F.explode(F.sequence(F.lit(0), F.col("uses") - 1)).alias("mix_epoch")
    used = used.filter("uses > 0").select("*", epochs)
    # Where the use stands along the whole budget of its source.
    row = _unit(F.lit(seed), "mix_epoch", "id")
    share = F.shiftrightunsigned(row, 11) / F.lit(float(1 << 53))
    along = (F.col("before") + share * F.col("inside")) / F.greatest(F.col("have"), F.lit(1))
    length = F.col("passes") + F.col("rest") / F.greatest(F.col("have"), F.lit(1))
    place = (F.col("mix_epoch") + F.when(F.col("have") > 0, along).otherwise(share)) / length
    key = F.struct(place.alias("place"), F.col("shuffled").alias("block"), row.alias("row"))
    out = used.select(*[F.col(f"row.c{i}") for i in shown], "mix_epoch", key.alias("mix_order"))
    return out.toDF(*[names[i] for i in shown], "mix_epoch", "mix_order")


def _decided(joined: DataFrame, last: DataFrame) -> DataFrame:
    """``joined`` with ``uses``: its whole passes, and whether the last one takes the row, too."""
    # One row per part of an ending block, and one per document of the last part.
    cut = F.col("j.source").eqNullSafe(F.col("l.source")) & (F.col("j.part") == F.col("l.part")) & F.col("j.ends")
    one = F.col("l.id").eqNullSafe(F.col("j.id")) & (F.col("l.tokens") == F.col("j.tokens"))
    both = joined.alias("j").join(last.alias("l"), cut & (~F.col("l.single") | one), "left")
    begun = F.when(F.col("j.ends"), F.col("l.before") < F.col("j.rest")).otherwise(F.col("j.before") < F.col("j.rest"))
    return both.select("j.*", (F.col("passes") + F.coalesce(begun, F.lit(False)).cast("int")).alias("uses"))


def _last_rows(rows: DataFrame, ending: DataFrame, seed: int) -> DataFrame:
    """Tokens before each part of the ending blocks, and before each document of the last part.

    Rows are ``source``, ``part``, ``before`` and, for documents (``single``), ``id`` and ``tokens``.
    """
    where = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.block") == F.col("b.block"))
    slim = rows.select("source", "block", "part", "id", "tokens").alias("r")
    inside = slim.join(ending.select("source", "block", "before", "rest").alias("b"), where)
    inside = inside.select("r.source", "part", "id", "tokens", "before", "rest")
    parts = inside.groupBy("source", "part", "before", "rest").agg(F.sum("tokens").alias("size"))
    turn = _unit(F.lit(seed), F.lit("parts"), "part")
    order = W.partitionBy("source").orderBy(turn, "part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    last = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") > F.col("rest"))
    parts = materialise(parts.withColumn("last", last), "mix-parts")
    chosen = parts.filter("last").select("source", "part", "before").alias("p")
    same = F.col("i.source").eqNullSafe(F.col("p.source")) & (F.col("i.part") == F.col("p.part"))
    within = inside.alias("i").join(chosen, same).select("i.source", "i.part", "i.id", "i.tokens", "p.before")
    # Rows of equal id and tokens are one row of that many: they are used or left out together.
    within = within.groupBy("source", "part", "id", "tokens", "before").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("source", "part").orderBy(_unit(F.lit(seed), F.lit("row"), "id"), "id", "tokens")
    order = order.rowsBetween(W.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum(F.col("tokens") * F.col("n")).over(order), F.lit(0))
    single = within.select("source", "part", before.alias("before"), "id", "tokens", F.lit(True).alias("single"))
    none = [F.lit(None).cast(single.schema[c].dataType).alias(c) for c in ("id", "tokens")]
    whole = parts.filter("NOT last").select("source", "part", "before", *none, F.lit(False).alias("single"))
    return materialise(single.unionByName(whole), "mix-last")
