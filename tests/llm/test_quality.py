import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from wardflow.llm import quality as Q


def corpus(n=400):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(20, 90))]
        good = rnd.random() < 0.7
        if not good:
            kind = rnd.randrange(3)
            words = [[w.upper() + "!!" for w in words], [w + "%%%" for w in words], [w for w in words[:9] for _ in range(9)]][kind]
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark, docs_of):
    rows, labels = corpus()
    df, known = docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = Q.train_quality(df, known)
    scored = Q.score_quality(df, model).withColumn("held_out", Q.held_out(Q.F.col("doc_id"))).collect()
    truth = dict((i, q) for i, q, _ in labels)
    assert len(scored) == len(rows)
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    held = [r for r in scored if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    # Labels of held-out rows teach nothing.
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    again = Q.train_quality(df, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias
    kept = Q.keep_quality(df, model)
    assert kept.columns == df.columns
    assert sorted(r[0] for r in kept.collect()) == sorted(r["doc_id"] for r in scored if r["predicted"])


def test_edges(spark, docs_of):
    rows, labels = corpus(60)
    rows += [(None, "null id"), (1000, None), (1001, ""), (3, rows[3][1]), (1002, "word " * 50_000)]
    labels += [(None, 1, 0), (1000, None, 0), (1001, 5, 0), (4, 1 - labels[4][1], 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = Q.train_quality(docs_of(rows), known)
    assert Q.score_quality(docs_of(rows), model).count() == len(rows)
    ones = Q.train_quality(docs_of(rows), known.filter("quality = 1"))
    assert {r["predicted"] for r in Q.score_quality(docs_of(rows), ones).collect()} == {1}
    none = Q.train_quality(docs_of([]), known.limit(0))
    assert {r["score"] for r in Q.score_quality(docs_of(rows), none).collect()} == {0.5}
    assert Q.score_quality(docs_of([]), model).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    target = np.array([1.0 if r[0] < 3 else -1.0 for r in rows])
    scale = rng.normal(1, 0.2, 30)
    w, b = Q.fit_svm(rows, target, scale, 1.0, 3000)

    def loss(w, b):
        margins = [y * (w[r] @ scale[r] / np.linalg.norm(scale[r]) + b) for r, y in zip(rows, target, strict=True)]
        return 0.5 * (w @ w + b * b) + sum(max(0.0, 1 - m) for m in margins)

    best = loss(w, b)
    for _ in range(300):
        assert loss(w + rng.normal(0, 0.01, 30), b + rng.normal(0, 0.01)) >= best - 1e-3


def test_filter_keeps_every_labelled_row(spark, monkeypatch):
    """All ids of the labels pass, at a size where few others do and at one where most do."""
    docs = spark.range(-3000, 3000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    docs = docs.union(spark.createDataFrame([(None, "x"), (2**63 - 1, "y"), (-(2**63), "z")], "doc_id long, text string"))
    known = docs.filter("doc_id % 7 = 0 or abs(doc_id / 2) > 4000").select("doc_id", F.lit(1).alias("label"))
    ids = {r[0] for r in known.select("doc_id").collect()}
    for size, others in ((1 << 26, 10), (1 << 8, 6000)):
        monkeypatch.setattr(Q, "FILTER_BITS", size)
        passed = [r[0] for r in Q._maybe_labelled(docs, known).select("doc_id").collect()]
        assert ids <= set(passed) and len(passed) - len(ids) <= others
    monkeypatch.setattr(Q, "FILTER_BITS", 1 << 26)
    assert Q._maybe_labelled(docs, known.limit(0)).count() == 0
