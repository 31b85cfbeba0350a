"""Winnowing fingerprints: rolling k-gram hashes, the rightmost minimum of every window.

Two texts that share a run of ``k + window - 1`` characters share at least one fingerprint, and
the positions kept tell where.  Hashes are polynomials over code points modulo 2**64, taken from
prefix sums, so a k-gram hashes alike wherever it stands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, batch, id_and_text, mix64, partitions, strings

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
K, WINDOW = 20, 60


class Winnower:
    """Fingerprints of texts as ``(hashes, positions)``, both unsigned 32-bit, by position."""

    def __init__(self, k: int = K, window: int = WINDOW):
        if k < 1 or window < 1:
            raise ValueError("k and window must be positive")
        self.k, self.window = k, window
        self.powers = self.inverse = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers), 4096)
            up, down = np.full(n, BASE, U64), np.full(n, pow(BASE, -1, 1 << 64), U64)
            up[0] = down[0] = 1
            self.powers, self.inverse = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def _hashes(self, points: np.ndarray, k: int) -> np.ndarray:
        """Hash of every k-gram, 32 bits."""
        n = len(points)
        self._grow(n)
        sums = np.zeros(n + 1, U64)
        np.cumsum((points.astype(U64) + U64(1)) * self.powers[:n], out=sums[1:])
        return mix64((sums[k:] - sums[:-k]) * self.inverse[: n - k + 1]) >> U64(32)

    def select(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        hashes = self._hashes(points, min(self.k, len(points)))
        n = len(hashes)
        # Hash above, distance from the end below: the least is the rightmost least hash.
        best = hashes << U64(32) | np.arange(n - 1, -1, -1, dtype=U64)
        width, reach = min(self.window, n), 1
        while 2 * reach <= width:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        if width > reach:
            best = np.minimum(best[: reach - width], best[width - reach :])
        best = best[np.flatnonzero(np.append(True, best[1:] != best[:-1]))]
        positions = U64(n - 1) - (best & U64(0xFFFFFFFF))
        return (best >> U64(32)).astype(np.uint32), positions.astype(np.uint32)


def as_hex(found: tuple[np.ndarray, np.ndarray]) -> str:
    """Sixteen hexadecimal digits per fingerprint: hash, then position."""
    return np.stack(found, axis=1).astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two empty sets are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``hashes`` and ``positions`` (code points).

    A text shorter than ``k`` has one fingerprint, of the whole text; a text with fewer than
    ``window`` k-grams has one; a null or empty text has none.  Rows are independent, so equal ids
    or texts repeat; null ids are kept, other columns are ignored, an empty table stays empty.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_chars", pa.int64()),
            ("hashes", pa.list_(pa.int64())),
            ("positions", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(k, window)
        for rows in batches:
            texts = strings(rows[1])
            found = [winnower.select(t) for t in texts]
            yield batch(
                schema,
                (
                    rows[0].to_pylist(),
                    [len(t) for t in texts],
                    [h.astype(np.int64) for h, _ in found],
                    [p.astype(np.int64) for _, p in found],
                ),
            )

    return id_and_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, hashes array<long>, positions array<long>"
    )


def _with_successor(docs: DataFrame) -> DataFrame:
    """Rows dealt to ranges of descending ids; each range also holds the first row of the next.

    Within ``part`` the order is own rows (``extra`` 0), then rows of the next range's first id.
    One copy of the texts is shuffled.  The cut points and first ids that pass the driver are at
    most as many as there are shuffle partitions.
    """
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    docs = docs.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    shares = [i / n for i in range(1, n)] or [0.5]
    cuts = docs.agg(F.percentile_approx("key", shares, 10_000)).first()[0] or []
    cuts = sorted({float(c) for c in cuts})
    splits = [float("-inf"), *cuts, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="as_double", outputCol="range")
    ranges = cut.transform(docs.withColumn("as_double", F.col("key").cast("double")))
    ranges = ranges.withColumn("range", F.col("range").cast("int")).drop("as_double")
    first = sorted(ranges.groupBy("range").agg(F.max("key")).collect())
    moves = [(r, k, first[(i + 1) % len(first)][0]) for i, (r, k) in enumerate(first)]
    heads = spark.createDataFrame(moves, "range int, key long, to int")
    copies = F.array_compact(
        F.array(
            F.struct(F.col("range").alias("part"), F.lit(0).alias("extra")),
            F.when(
                F.col("to").isNotNull(), F.struct(F.col("to").alias("part"), F.lit(1).alias("extra"))
            ),
        )
    )
    return (
        ranges.join(F.broadcast(heads), ["range", "key"], "left")
        .select("doc_id", "key", "text", F.explode(copies).alias("at"))
        .select("doc_id", "key", "text", "at.part", "at.extra")
        .repartitionById(len(splits), F.col("part"))
        .sortWithinPartitions("part", "extra", F.desc("key"), "text")
        .select("doc_id", "text", "part", "extra")
    )


def compare_with_successor(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    window: int = WINDOW,
    replaced: int = 3,
) -> DataFrame:
    """Fingerprints of each text, of an edited text, and their likeness; see ``op2`` in queries.

    The successor of a document is the next one in descending id (the first after the last; rows
    of equal ids follow each other by text; a null id is the smallest).  The edited text has its
    last ``n_chars // replaced`` characters replaced by as many from the start of the successor,
    or by the whole successor if that is shorter.  ``near_edited`` and ``near_next`` are Jaccard
    similarities of fingerprint hashes.  A null text is empty; an empty table yields no rows.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    schema = pa.schema(
        list(
            zip(
                [*names, "near_edited", "near_next"],
                [pa.int64(), pa.int64()] + [pa.string()] * 3 + [pa.float64()] * 2,
                strict=True,
            )
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(k, window)
        held = None  # the row that still waits for its successor
        for rows in batches:
            out: list[list] = [[] for _ in schema]
            columns = (rows[0].to_pylist(), strings(rows[1]), rows[2].to_pylist(), rows[3].to_pylist())
            for doc, text, part, extra in zip(*columns, strict=True):
                own = winnower.select(text)
                if held is not None:
                    before, before_text, before_own = held
                    cut = len(before_text) // replaced
                    edited = before_text[: len(before_text) - cut] + text[:cut]
                    changed = winnower.select(edited)
                    row = (
                        before,
                        len(before_text),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_hex(before_own),
                        as_hex(changed),
                        likeness(before_own[0], changed[0]),
                        likeness(before_own[0], own[0]),
                    )
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                held = None if extra else (doc, text, own)
            yield batch(schema, out)

    docs = id_and_text(df, id_col, text_col)
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], _compared())
    return _with_successor(docs).mapInArrow(run, _compared())


def _compared() -> str:
    return (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
