"""Connected components of a graph of any size, by contracted label propagation."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import Forest, batch

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Edges contracted at a time within a task.
CONTRACT = 1 << 18


def spanning(edges: DataFrame) -> DataFrame:
    """Fewer edges of the same components: each task keeps a star forest of the edges it reads."""

    def forest(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        number: dict[int, int] = {}
        pairs = [
            (number.setdefault(a, len(number)), number.setdefault(b, len(number)))
            for rows in batches
            for a, b in zip(rows[0].to_pylist(), rows[1].to_pylist(), strict=True)
        ]
        tree = Forest(len(number))
        for a, b in pairs:
            tree.union(a, b)
        names = list(number)
        least: dict[int, int] = {}
        roots = [tree.find(i) for i in range(len(names))]
        for root, name in zip(roots, names, strict=True):
            least[root] = min(name, least.get(root, name))
        kept = [(least[r], n) for r, n in zip(roots, names, strict=True) if least[r] != n]
        return batch(_EDGES, ([a for a, _ in kept], [b for _, b in kept]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            held.append(rows)
            size += rows.num_rows
            if size >= CONTRACT:
                held = [forest(held)]
                size = held[0].num_rows
                if size >= CONTRACT // 2:
                    yield held[0]
                    held, size = [], 0
        if held:
            yield forest(held)

    return edges.mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex`` and ``component`` (its smallest vertex) of every vertex of an edge.

    Each round gives every vertex the smallest label among itself and its neighbours, by an
    aggregation that combines before its shuffle, and then the label of that label.  Rounds are
    written to the shared folder, so none depends on an executor; they end when nothing changes.
    Null ends, loops and repeated edges are harmless; no edges give no rows.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    pairs = pairs.filter("a is not null and b is not null and a <> b")
    # Contracted where it was found, then where a vertex's edges from several tasks meet.
    pairs = materialise(spanning(spanning(pairs).repartition("b")), "component-edges")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = labels.select(F.col("a").alias("vertex"), F.least("a", "low").alias("component"))
    labels = materialise(labels, "component-labels")
    while True:
        # One-row-per-vertex tables meet edges or labels: a vertex of many edges is split by AQE.
        near = both.join(labels.withColumnRenamed("vertex", "b"), "b").groupBy("a")
        near = near.agg(F.min("component").alias("near")).withColumnRenamed("a", "vertex")
        lower = labels.join(near, "vertex", "left").select(
            "vertex", "component", F.least("component", "near").alias("low")
        )
        of_label = labels.select(F.col("vertex").alias("low"), F.col("component").alias("jump"))
        new = lower.join(of_label, "low", "left").select(
            "vertex", F.least("low", "jump").alias("component"), F.col("component").alias("was")
        )
        new = materialise(new, "component-labels")
        labels = new.select("vertex", "component")
        if new.filter("component <> was").isEmpty():
            return labels
