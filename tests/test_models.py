"""Multi-class models: boosted trees against a plain reimplementation, multinomial scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wardflow.functions.clinical import stay_class_of
from wardflow.operators import boosting
from wardflow.operators import features as feat


def best_split(rows, grad, weight):
    """Cut of largest gain, as (gain, feature, cut); every midpoint of neighbouring values is tried."""
    best = None
    for f in range(len(rows[0])):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            gain = 0.0
            for side in (True, False):
                at = [i for i, r in enumerate(rows) if (r[f] <= cut) == side]
                gain += sum(grad[i] for i in at) ** 2 / sum(weight[i] for i in at)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, f, cut)
    return best


def grow(rows, grad, weight, depth):
    split = best_split(rows, grad, weight) if depth else None
    base = sum(grad) ** 2 / sum(weight)
    if split is None or split[0] - base < 1e-12:
        value = sum(grad) / sum(weight)
        return lambda r: value
    _, f, cut = split
    parts = []
    for side in (True, False):
        at = [i for i, r in enumerate(rows) if (r[f] <= cut) == side]
        parts.append(grow([rows[i] for i in at], [grad[i] for i in at], [weight[i] for i in at], depth - 1))
    return lambda r: parts[0](r) if r[f] <= cut else parts[1](r)


def plain_boost(rows, labels, classes, rounds, depth, rate, query):
    margins, out = [[0.0] * classes for _ in rows], [[0.0] * classes for _ in query]

    def probs(m):
        e = [math.exp(x) for x in m]
        return [x / sum(e) for x in e]

    for _ in range(rounds):
        p = [probs(m) for m in margins]
        for k in range(classes):
            grad = [(y == k) - q[k] for y, q in zip(labels, p)]
            weight = [max(q[k] * (1 - q[k]), boosting.LEAST_WEIGHT) for q in p]
            tree = grow(rows, grad, weight, depth)
            for m, r in zip(margins, rows):
                m[k] += rate * tree(r)
            for m, r in zip(out, query):
                m[k] += rate * tree(r)
    return [probs(m) for m in out]


@pytest.mark.parametrize("classes,depth", [(3, 2), (2, 3)])
def test_boosting_equals_a_plain_version(spark, classes, depth):
    rnd = random.Random(classes)
    rows = [(rnd.randrange(9) * 1.7, rnd.randrange(6) * 1.3, rnd.randrange(4) * 1.0) for _ in range(150)]
    labels = [int((r[0] + 2 * r[1] + rnd.random() * 6) / 9 * classes / 3) % classes for r in rows]
    data = [(i, *r, y) for i, (r, y) in enumerate(zip(rows, labels))]
    data += [(200, 5.0, 2.0, 1.0, None), (201, None, None, None, 0)]
    df = spark.createDataFrame(data, "id INT, a DOUBLE, b DOUBLE, c DOUBLE, y INT")
    model = boosting.train_boosted(df, ["a", "b", "c", "absent"], "y", classes, rounds=3, depth=depth, rate=0.4)
    scored = feat.class_probabilities(model, df, ["a", "b", "c", "absent"], ["id"], classes)
    known = [(*(x or 0.0 for x in d[1:4]), 0.0) for d in data]
    use = [i for i, d in enumerate(data) if d[4] is not None]
    want = plain_boost([known[i] for i in use], [data[i][4] for i in use], classes, 3, depth, 0.4, known)
    for r in scored.collect():
        place = next(i for i, d in enumerate(data) if d[0] == r["id"])
        got = [r[f"prob_{k}"] for k in range(classes)]
        assert got == pytest.approx(want[place], abs=1e-9)
        assert r["predicted_class"] == got.index(max(got))
    generic = feat.apply_classifier(model, df, ["a", "b", "c", "absent"], ["id"]).collect()
    assert all(0.3 < r["confidence"] <= 1 for r in generic)


def test_more_rounds_lower_the_loss(spark):
    rnd = random.Random(5)
    data = [(i, rnd.random() * 10, rnd.random() * 10) for i in range(400)]
    rows = [(*d, (0 if d[1] > 7 else 1 if d[2] > 4 else 2) if rnd.random() > 0.1 else rnd.randrange(3)) for d in data]
    df = spark.createDataFrame(rows, "id INT, a DOUBLE, b DOUBLE, y INT")
    losses = []
    for rounds in (1, 4):
        model = boosting.train_boosted(df, ["a", "b"], "y", 3, rounds=rounds, depth=2)
        scored = feat.class_probabilities(model, df, ["a", "b"], ["y"], 3)
        losses.append(boosting.log_loss(scored, "y", 3).first())
    assert losses[1]["log_loss"] < losses[0]["log_loss"] < math.log(3)
    assert losses[1]["accuracy"] > 0.85
    with pytest.raises(ValueError):
        boosting.train_boosted(df, ["a"], "y", 1)


def test_class_limits(spark):
    df = spark.createDataFrame([(8.0,), (7.0,), (3.0,), (2.9,), (None,)], "los DOUBLE")
    assert [r[0] for r in df.select(stay_class_of(F.col("los"))).collect()] == [0, 1, 1, 2, None]


def test_equal_rows_are_boosted_as_one(spark, monkeypatch):
    once = [(float(i % 7), float(i % 5), i % 3) for i in range(105)]
    sizes, write = [], boosting.materialise
    monkeypatch.setattr(boosting, "materialise", lambda df, label: sizes.append(write(df, label).count()) or write(df, label))
    scores = []
    for data in (once, once * 6):
        df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, y INT")
        model = boosting.train_boosted(df, ["a", "b"], "y", 3, rounds=2, depth=2)
        query = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(35)], "id INT, a DOUBLE, b DOUBLE")
        scored = feat.class_probabilities(model, query, ["a", "b"], ["id"], 3).orderBy("id").collect()
        scores.append([x for r in scored for x in r[2:]])
    assert sizes == [105] * 4
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)
