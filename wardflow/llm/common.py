"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


#: Rows that cross to Python at a time: texts are long, and several copies of a batch exist.
BATCH_ROWS = 2048


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of Arrow batches of whole texts; for jobs to call, not for operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``new=old`` by exact name, whatever other columns are called.

    Columns are addressed by position, so names that differ only in case, or repeat, are harmless;
    of repeated names the first counts.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(old)}").alias(new) for new, old in columns.items()])


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls (a null text counts as empty)."""
    rows = pick(df, doc_id=id_col, text=text_col)
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser with two multiplications)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def strings(column: pa.ChunkedArray | pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the fan-out of everything that is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, n: int, *keys: Column | str) -> DataFrame:
    """Rows hash-partitioned by ``keys`` into ``n`` parts that adaptive execution leaves alone."""
    return df.repartition(n, *keys)


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterable[pa.RecordBatch]:
    """Batches of whole groups, for rows sorted by their first ``keys`` integer columns."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows[i].to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(rows.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(int(c[0]) for c in columns)
        starts = np.flatnonzero(change).tolist()
        if held and first != last:
            yield _joined(held)
            held = []
        begin = 0
        for end in starts:
            held.append(rows.slice(begin, end - begin))
            yield _joined(held)
            held, begin = [], end
        held.append(rows.slice(begin))
        last = tuple(int(c[-1]) for c in columns)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


class Forest:
    """Union-find over small consecutive integers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def planes(values: np.ndarray, kind: str) -> bytes:
    """Bytes of equal weight together, so that shuffles compress them."""
    wide = np.ascontiguousarray(values.astype(kind))
    return np.ascontiguousarray(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()
