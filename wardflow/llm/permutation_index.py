"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots, in order.  Each segment of the data keeps inverted
files, one per pivot, of its vectors and the pivot's place in their order.  A query walks the files
of its own pivots, which yields the footrule distance between its order and that of every posted
vector; the nearest by footrule are reranked by their true distance.  Equal vectors of a segment are
posted once, so copies do not crowd others out of the rerank.

With ``m`` places per order, and a missing pivot taken as place ``m``, the footrule distance of two
orders is ``m * (m + 1)`` less ``2 * (m - max(i, j))`` for every pivot that they share at places
``i`` and ``j``, so only shared pivots need a visit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batch, partitions, pick

#: A query meets ``PLACES ** 2 / PIVOTS`` postings per vector of the index.
PIVOTS, PLACES = 2048, 64
#: Least and most rows of a segment.
SEGMENT, LARGEST = 4096, 131_072
#: A query reranks this share of the distinct vectors, and ``EXTRA * sqrt(rows * k / 10)`` besides.
RERANK, EXTRA = 0.02, 7.0
#: Rows that pivots are chosen from, for each pivot: bounded, by hash of the id.
PIVOT_ROWS = 2
#: Rows whose distances to all pivots are held at a time.
ORDER_BLOCK = 1024


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``vec`` (doubles) of rows with an id and a finite, non-zero vector."""
    rows = pick(df, vec_id=id_col, vec=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    # Null components must not pass as unknown.
    return rows.filter(
        F.col("vec_id").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, np.float64).reshape(len(column), -1)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Batches cut where the first two columns, the segment and the kind of row, change."""
    for rows in batches:
        if not rows.num_rows:
            continue
        at, kind = rows[0].to_numpy(), rows[1].to_numpy()
        cuts = np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1
        ends = [0, *cuts.tolist(), rows.num_rows]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield int(at[a]), int(kind[a]), rows.slice(a, b - a)


def distances(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from the differences themselves.

    Differences whose squares leave the range of doubles are scaled by a power of two first.
    """
    with np.errstate(over="ignore"):
        gap = many - one
        squares = np.einsum("ij,ij->i", gap, gap)
        far = np.sqrt(squares)
        odd = np.flatnonzero((squares < 1e-280) | (squares > 1e300))
        if len(odd):
            exponent = np.frexp(np.abs(gap[odd]).max(axis=1))[1]
            part = np.ldexp(gap[odd], -exponent[:, None])
            far[odd] = np.ldexp(np.sqrt(np.einsum("ij,ij->i", part, part)), exponent)
    return far


class Orders:
    """Nearest pivots of vectors, in order; ties to the pivot named first."""

    def __init__(self, pivots: np.ndarray, places: int):
        self.pivots, self.places = pivots, min(places, len(pivots))
        self.exponent = int(np.frexp(np.abs(pivots).max())[1])
        self.scaled = np.ldexp(pivots, -self.exponent)
        self.squares = (self.scaled**2).sum(1)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        parts = [self._of(vectors[i : i + ORDER_BLOCK]) for i in range(0, len(vectors), ORDER_BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, self.places), np.int16)

    def _of(self, vectors: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            # A vector's own square is the same for every pivot.
            far = self.squares - 2 * np.ldexp(vectors, -self.exponent) @ self.scaled.T
        for i in np.flatnonzero(~np.isfinite(far).all(axis=1)):
            far[i] = distances(vectors[i], self.pivots)
        near = np.argpartition(far, self.places - 1, axis=1)[:, : self.places]
        near.sort(axis=1)
        inner = np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable")
        return np.take_along_axis(near, inner, 1).astype(np.int16)


class Segment:
    """Inverted files of one segment; rows must come in ascending id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, orders: Orders):
        whole = np.ascontiguousarray(vectors).view(f"V{vectors.itemsize * vectors.shape[1]}").ravel()
        _, first, copy_of = np.unique(whole, return_index=True, return_inverse=True)
        # Distinct vectors stand in the order of their smallest id.
        rank = np.empty(len(first), np.int64)
        rank[np.argsort(first, kind="stable")] = np.arange(len(first))
        copy_of = rank[copy_of]
        self.ids = ids[np.argsort(copy_of, kind="stable")]
        self.copies = np.concatenate([[0], np.cumsum(np.bincount(copy_of))])
        self.vectors, self.orders = vectors[np.sort(first)], orders
        found = orders.of(self.vectors)
        posted = np.argsort(found.ravel(), kind="stable")
        self.rows = (posted // orders.places).astype(np.int32)
        self.at = (posted % orders.places).astype(np.int32)
        counts = np.bincount(found.ravel(), minlength=len(orders.pivots))
        self.ends = np.concatenate([[0], np.cumsum(counts)])

    def search(self, query_id: int, query: np.ndarray, order: np.ndarray, k: int, n: int):
        """Up to ``k`` nearest of the segment, of ``n`` distinct vectors reranked, as (ids, distances)."""
        m, size = self.orders.places, len(self.vectors)
        shared = np.zeros(size, np.int32)
        for i, pivot in enumerate(order):
            a, b = self.ends[pivot], self.ends[pivot + 1]
            shared[self.rows[a:b]] += m - np.maximum(self.at[a:b], i)
        near = np.arange(size)
        if n < size:
            footrule = m * (m + 1) - 2 * shared.astype(np.int64)
            # Ties go to the smaller id.
            near = np.argpartition(footrule * size + near, n - 1)[:n]
        far = distances(query, self.vectors[near])
        ids: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        got, last = 0, -1.0
        for at in np.argsort(far, kind="stable"):
            if got >= k and far[at] > last:
                break
            copies = self.ids[self.copies[near[at]] : self.copies[near[at] + 1]]
            copies = copies[copies != query_id][:k]
            ids.append(copies)
            scores.append(np.full(len(copies), far[at]))
            got, last = got + len(copies), far[at]
        all_ids, all_scores = np.concatenate(ids), np.concatenate(scores)
        best = np.lexsort((all_ids, all_scores))[:k]
        return all_ids[best], all_scores[best]


def nearest_neighbours(
    df: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    pivots: int = PIVOTS,
    places: int = PLACES,
    rerank: float = RERANK,
    extra: float = EXTRA,
    segment: int = SEGMENT,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the Euclidean distance, nearest first.

    ``queries`` has the same two columns.  Candidates are all rows of ``df`` but those of the
    query's own id; ties go to the smaller id.  A query reranks ``rerank`` of the rows and
    ``extra * sqrt(rows * k / 10)`` more, ``24 * k`` at least, in equal parts by segment; where a
    segment holds fewer distinct vectors than its part, all of them compete.  Rows without an id, and null, zero or non-finite vectors or vectors with null
    components, take no part; nor do vectors of another length than most of ``df`` has (of equally
    common lengths the smallest counts).  A repeated row is a candidate of its own; query rows
    repeated exactly count once, and rows of one id with other vectors are queries of their own.
    No usable row, or no query, gives no rows; other columns are ignored.

    The pivots are distinct vectors among ``2 * pivots`` rows, by a hash of the id.  Every row is
    indexed: rows are dealt by hash to segments, as many as there are shuffle partitions, but of
    ``segment`` to 131,072 rows each, so a vector that is very common is spread.  Every segment sees
    every query, in batches; nothing but one segment and one batch is held.  Distances beyond the
    range of doubles are infinite.
    """
    spark = df.sparkSession
    rows = usable_vectors(df, id_col, vector_col)
    lengths = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").take(1)
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    dim, rows = lengths[0]["dim"], rows.filter(F.size("vec") == lengths[0]["dim"])
    total = lengths[0]["count"]
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(PIVOT_ROWS * pivots).collect()
    chosen = list(dict.fromkeys(tuple(r["vec"]) for r in first))[:pivots]
    shared = spark.sparkContext.broadcast(np.array(chosen))  # at most pivots * dim numbers
    segments = max(-(-total // LARGEST), min(partitions(spark), -(-total // segment)))
    wanted = max(24 * k, rerank * total + extra * (total * k / 10) ** 0.5)
    part = max(2 * k, math.ceil(wanted / segments))

    asked = usable_vectors(queries, id_col, vector_col).filter(F.size("vec") == dim).distinct()
    query_key = F.xxhash64("vec_id", "vec")
    blocked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"),
        F.lit(1).alias("is_query"),
        "vec_id",
        query_key.alias("key"),
        "vec",
    )
    posted = rows.select(
        F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(segments)).cast("int").alias("segment"),
        F.lit(0).alias("is_query"),
        "vec_id",
        F.lit(0).cast("long").alias("key"),
        "vec",
    )
    dealt = (
        posted.unionByName(blocked)
        .repartition(partitions(spark), "segment")
        .sortWithinPartitions("segment", "is_query", "vec_id", "key")
    )
    arrow = pa.schema(
        [("query_id", pa.int64()), ("key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = Orders(shared.value, places)
        index, number, held = None, None, []
        for at, is_query, rows in _stretches(batches):
            if at != number:
                index, number, held = None, at, []
            if not is_query:
                held.append((rows[2].to_numpy(), _matrix(rows[4])))
                continue
            if held:
                index = Segment(*(np.concatenate(c) for c in zip(*held, strict=True)), orders)
                held = []
            if index is None:
                continue
            ids, vectors = rows[2].to_numpy(), _matrix(rows[4])
            found = [
                index.search(q, v, o, k, part)
                for q, v, o in zip(ids, vectors, orders.of(vectors), strict=True)
            ]
            n = [len(i) for i, _ in found]
            yield batch(
                arrow,
                (
                    np.repeat(ids, n),
                    np.repeat(rows[3].to_numpy(), n),
                    np.concatenate([i for i, _ in found]),
                    np.concatenate([d for _, d in found]),
                ),
            )

    near = dealt.mapInArrow(run, "query_id long, key long, vec_id long, score double")
    order = W.partitionBy("query_id", "key").orderBy("score", "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours, by query and id, that were found."""
    pairs = exact.select("query_id", "vec_id").distinct()
    hit = pairs.join(found.select("query_id", "vec_id").distinct(), ["query_id", "vec_id"])
    return hit.count() / max(pairs.count(), 1)
