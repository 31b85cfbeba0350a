"""Quality classifier: naive Bayes weighted n-grams and a linear support vector machine.

Features are indicators of hashed n-grams over two views of a text, its words and the shapes of
its words (runs of upper case, lower case, digits and each sign reduced to one).  Each indicator is
scaled by the log-count ratio of its class counts, and a linear hinge-loss model is fitted to the
scaled features by dual coordinate descent.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import U64, batch, from_planes, id_and_text, mix64, pick, planes, strings

#: Size of the hashed feature space: bounds the model, its counts and what is broadcast.
SPACE = 1 << 18
#: Most rows of each class that the support vector machine is fitted to.
FIT_ROWS = 6_000
MEMO_WORDS = 300_000
#: Bits of the filter for labelled ids: 8 MB of bitmaps at most, however many labels there are.
FILTER_BITS = 1 << 26
_WORD = re.compile(r"\S+")
_RUNS = (
    (re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else _cased(m[0])),
    (re.compile(r"\d+"), lambda m: "9"),
    (re.compile(r"([^\w\s])\1+"), lambda m: m[1] * 2),
)


def _cased(run: str) -> str:
    return "Aa" if run[0].isupper() else "a"


def word_shape(word: str) -> str:
    """``Word,`` -> ``Aa,``; ``LOUD!!`` -> ``A!!``; ``12%%%`` -> ``9%%``."""
    for pattern, short in _RUNS:
        word = pattern.sub(short, word)
    return word[:16]


class Features:
    """Sorted distinct feature numbers below ``space`` of one text at a time."""

    def __init__(self, space: int = SPACE):
        self.space = U64(space)
        self.memo: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        shape = zlib.crc32(word_shape(word).encode("utf-8", "replace"))
        value = zlib.crc32(word.lower().encode("utf-8", "replace")) << 32 | shape
        if len(word) <= 40:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = value
        return value

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        get, new = self.memo.get, self._hash
        both = np.fromiter((get(w) or new(w) for w in words), U64, len(words))
        word, shape = both >> U64(32), both & U64(0xFFFFFFFF)
        grams = [word | U64(1 << 40), shape | U64(2 << 40)]
        pair = shape[:-1] * U64(0x9E3779B1) + shape[1:]
        grams.append(mix64(pair) | U64(1))
        grams.append(mix64(pair[:-1] * U64(0x85EBCA77) + shape[2:]) & ~U64(1))
        grams.append(np.full(int((word[1:] == word[:-1]).any()), 3 << 40, U64))
        return np.unique(mix64(np.concatenate(grams)) % self.space).astype(np.int64)


def fit_svm(
    rows: list[np.ndarray], target: np.ndarray, scale: np.ndarray, c: float, rounds: int
) -> tuple[np.ndarray, float]:
    """Hinge-loss weights by dual coordinate descent over rows of features scaled by ``scale``.

    Each row has unit length and a constant feature besides.  Rows are visited in an order drawn
    anew each round from a fixed seed; a round in which no dual value moves ends the descent.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    values = [scale[r] / max(np.linalg.norm(scale[r]), 1e-12) for r in rows]
    squares = np.array([v @ v + 1.0 for v in values])
    dual, order = np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v, y = rows[i], values[i], target[i]
            slope = y * (weights[r] @ v + bias) - 1.0
            now = min(max(dual[i] - slope / squares[i], 0.0), c)
            if now != dual[i]:
                step = (now - dual[i]) * y
                weights[r] += step * v
                bias += step
                moved = max(moved, abs(now - dual[i]))
                dual[i] = now
        if moved < 1e-4:
            break
    return weights, bias


def log_ratios(counts: np.ndarray, docs: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log of each feature's share among documents of class 1 over its share in class 0."""
    share = (counts + smooth) / (docs[:, None] + 2 * smooth)
    return np.log(share[1] / share[0])


class QualityModel:
    """Weights per feature (bounded by ``space``) and a bias; empty where no class could be told."""

    def __init__(self, weights: np.ndarray, scale: np.ndarray, bias: float):
        self.weights, self.scale, self.bias = weights.astype(np.float32), scale.astype(np.float32), bias

    def score(self, features: np.ndarray) -> float:
        """Between 0 and 1, above 0.5 for a positive margin; a text without words has the bias."""
        scaled = self.scale[features]
        length = float(np.sqrt(scaled @ scaled)) or 1.0
        margin = float(self.weights[features] @ scaled) / length + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(3.0 * margin, -60, 60))))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: one in three by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _maybe_labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose id may be among those of ``known``: all that are, and few others.

    Ids are hashed to bits of bitmaps of 4 KB, which are broadcast: at most ``FILTER_BITS`` bits in
    all.  When labels outgrow them more rows pass, and the join that follows drops those.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = known.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    place = F.bitmap_bit_position(slot)
    octet = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    found = F.getbit(octet.cast("long"), (place % 8).cast("int")) == 1
    same = (F.bitmap_bucket_number(slot) == F.col("bucket")) & found
    return docs.join(F.broadcast(bits), same, "left_semi")


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    space: int = SPACE,
    fit_rows: int = FIT_ROWS,
    c: float = 1.0,
    rounds: int = 40,
    keep: Column | None = None,
) -> QualityModel:
    """Learn from every labelled row that is not held out.

    Class counts and log-count ratios cover all those rows; the support vector machine is fitted
    to at most about ``fit_rows`` rows of each class, chosen by a hash of the id.  Labels other
    than 0 and 1 and rows without an id teach nothing; of contradicting labels of one id the
    smallest counts.  With no row of a class the model scores every text 1 if only class 1 is
    known, 0 if only class 0 is, and 0.5 if neither.
    """
    spark = docs.sparkSession
    known = pick(labels, doc_id=id_col, label=label_col)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = materialise(known.groupBy("doc_id").agg(F.min("label").alias("label")), "quality-labels")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    taken = {k: min(1 << 30, (fit_rows << 30) // max(n, 1)) for k, n in sizes.items()}
    texts = id_and_text(docs, id_col, text_col).filter(~held_out(F.col("doc_id")))
    features = _features(_maybe_labelled(texts, known), space)
    limit = F.when(F.col("label") == 1, taken.get(1, 0)).otherwise(taken.get(0, 0))
    # Labels grow with the documents, so they are never broadcast.
    train = features.join(known.hint("merge"), "doc_id").select(
        "label", "features", (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < limit).alias("fit")
    )

    schema = "label int, feature long, n long, features binary"
    arrow = pa.schema(
        [("label", pa.int32()), ("feature", pa.int64()), ("n", pa.int64()), ("features", pa.binary())]
    )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, space + 1), np.int64)
        for rows in batches:
            label = rows[0].to_numpy(zero_copy_only=False)
            packed = rows[1].to_pylist()
            found = [_unpacked(x) for x in packed]
            for y in (0, 1):
                own = [x for x, z in zip(found, label, strict=True) if z == y]
                if own:
                    counts[y, :space] += np.bincount(np.concatenate(own), minlength=space)
                    counts[y, space] += len(own)
            fit = [(int(y), x) for y, x, f in zip(label, packed, rows[2].to_pylist(), strict=True) if f]
            none = [None] * len(fit)
            yield batch(arrow, ([y for y, _ in fit], none, none, [x for _, x in fit]))
        for y in (0, 1):
            at = np.flatnonzero(counts[y])
            yield batch(arrow, (np.full(len(at), y), at, counts[y, at], [None] * len(at)))

    gathered = materialise(train.mapInArrow(tally, schema), "quality-counts")
    totals = (
        gathered.filter("feature is not null").groupBy("label", "feature").agg(F.sum("n").alias("n"))
    ).toPandas()  # at most two rows per feature of the bounded space
    counts = np.zeros((2, space + 1))
    counts[totals["label"].to_numpy(int), totals["feature"].to_numpy(int)] = totals["n"]
    docs_of = counts[:, space]
    if not docs_of.all():
        bias = float(docs_of[1] > 0) - float(docs_of[0] > 0)
        return QualityModel(np.zeros(space), np.zeros(space), 20 * bias)
    ratios = log_ratios(counts[:, :space], docs_of)
    shared = spark.sparkContext.broadcast(ratios)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat(list(frames)).sort_values(["label", "features"], kind="stable")
        found = [_unpacked(x) for x in sample["features"]]
        target = sample["label"].to_numpy(float) * 2 - 1
        weights, bias = fit_svm(found, target, shared.value, c, rounds)
        at = np.flatnonzero(weights)
        yield pd.DataFrame({"feature": np.append(at, -1), "weight": np.append(weights[at], bias)})

    sample = gathered.filter("features is not null").select("label", "features").coalesce(1)
    fitted = sample.mapInPandas(fit, "feature long, weight double").toPandas()
    weights, bias = np.zeros(space), 0.0
    if len(fitted):
        at = fitted["feature"].to_numpy(int)
        weights[at[at >= 0]] = fitted["weight"][at >= 0]
        bias = float(fitted["weight"][at < 0].iloc[0])
    return QualityModel(weights, ratios, bias)


def _packed(features: np.ndarray) -> bytes:
    """Ascending numbers as their differences, bytes of equal weight together: compresses well."""
    return planes(np.diff(features, prepend=0), "<u4")


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u4").astype(np.int64))


def _features(docs: DataFrame, space: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Features(space)
        for rows in batches:
            found = [_packed(extract(t)) for t in strings(rows[1])]
            yield batch(schema, (rows[0].to_pylist(), found))

    return docs.mapInArrow(run, "doc_id long, features binary")


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
    space: int = SPACE,
) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every row, from the whole text alone.

    Null and empty texts have no features and score by the model's bias.  Rows with equal ids
    stay apart and equal texts score alike; other columns are ignored.
    """
    # Plain arrays: bounded by the feature space, and readable without this package.
    parts = (model.weights, model.scale, model.bias)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract, judge = Features(space), QualityModel(*shared.value)
        for rows in batches:
            scores = [judge.score(extract(t)) for t in strings(rows[1])]
            yield batch(schema, (rows[0].to_pylist(), scores, [int(s >= 0.5) for s in scores]))

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, score double, predicted int"
    )


def keep_quality(
    docs: DataFrame,
    model: QualityModel,
    text_col: str = "text",
    space: int = SPACE,
) -> DataFrame:
    """The rows of ``docs``, all columns, that the model predicts as class 1; nothing is shuffled."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    parts = (model.weights, model.scale, model.bias)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        extract, judge = Features(space), QualityModel(*shared.value)
        for part in texts:
            yield pd.Series([judge.score(extract(t)) for t in part])

    text = F.coalesce(F.col(f"c{names.index(text_col)}").cast("string"), F.lit(""))
    return flat.filter(scored(text) >= 0.5).toDF(*names)
