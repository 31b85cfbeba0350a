"""Gradient-boosted trees for several classes, from Spark's distributed regression trees.

Every round fits one tree per class to the Newton step of the softmax loss: a tree whose target is
gradient over curvature and whose row weight is the curvature has the optimal step as the weighted
mean of each leaf, and its weighted variance gain is the gain of the loss.  Margins are written
after each round, so a round reads one small table and its plan does not grow with the rounds.
Rows of equal features and class have equal steps in every round: they are one row with their number.
The result is an ordinary pipeline of Spark's own stages and can be stored and loaded as one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, work_path
from .features import align_features

#: Least curvature of a row: a class that is all but certain gives no unbounded steps.
LEAST_WEIGHT = 1e-6


def softmax(margins: Sequence[Column]) -> list[Column]:
    """Probabilities of the classes; the largest margin is subtracted first."""
    top = F.greatest(*margins) if len(margins) > 1 else margins[0]
    parts = [F.exp(m - top) for m in margins]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def _softmax_stage(columns: list[list[str]], rate: float):
    """The trees' predictions as class probabilities ``_p0``... and the class of the largest."""
    from pyspark.ml.feature import SQLTransformer

    margins = [f"{rate!r} * ({' + '.join(names)})" for names in columns]
    sums = ", ".join(f"{m} AS _m{k}" for k, m in enumerate(margins))
    top = f"greatest({', '.join(f'_m{k}' for k in range(len(columns)))})"
    total = " + ".join(f"exp(_m{k} - _top)" for k in range(len(columns)))
    probs = ", ".join(f"exp(_m{k} - _top) / ({total}) AS _p{k}" for k in range(len(columns)))
    best = f"CAST(array_position(array({', '.join(f'_m{k}' for k in range(len(columns)))}), _top) - 1 AS DOUBLE)"
    drop = ", ".join(c for names in columns for c in names)
    inner = f"SELECT *, {top} AS _top FROM (SELECT * EXCEPT ({drop}), {sums} FROM __THIS__)"
    return SQLTransformer(statement=f"SELECT *, {probs}, {best} AS prediction FROM ({inner})")


def train_boosted(
    features: DataFrame,
    names: Sequence[str],
    label: str,
    classes: int,
    rounds: int = 10,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 128,
    min_rows: int = 1,
    path: str | None = None,
    seed: int = 17,
):
    """Fit boosted trees and store them; the loaded pipeline model is returned.

    ``label`` holds the class index (rows without one are left out); features are aligned as for
    scoring, so a missing one is 0.  Splits are cut at midpoints of values where a feature has at
    most ``bins`` of them, else at quantiles.  The model's output has ``_probability`` and
    ``prediction`` as that of the other classifiers.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    if classes < 2 or rounds < 1:
        raise ValueError("boosting needs two classes and one round")
    spark = features.sparkSession
    margin = [f"_margin{k}" for k in range(classes)]
    assembler = VectorAssembler(inputCols=list(names), outputCol="_features")
    rows = features.filter(F.col(label).isNotNull()).withColumn("_class", F.col(label).cast("int"))
    rows = align_features(rows, names, keep=["_class"])
    if min_rows > 1:  # Spark counts the rows of a leaf, not their weights
        rows = rows.withColumn("_rows", F.lit(1.0))
    else:
        rows = rows.groupBy("_class", *names).agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    rows = assembler.transform(rows).select("_features", "_class", "_rows")
    rows = materialise(rows.withColumns({m: F.lit(0.0) for m in margin}), "boost")
    trees, columns = [], [[] for _ in range(classes)]
    for number in range(rounds):
        probs = softmax([F.col(m) for m in margin])
        grown = []
        for k in range(classes):
            gradient = (F.col("_class") == k).cast("double") - probs[k]
            weight = F.greatest(probs[k] * (1 - probs[k]), F.lit(LEAST_WEIGHT))
            column = f"_tree_{number}_{k}"
            learner = DecisionTreeRegressor(
                featuresCol="_features", labelCol="_step", weightCol="_weight", predictionCol=column,
                maxDepth=depth, maxBins=bins, minInstancesPerNode=min_rows, seed=seed,
            )
            total = (F.col("_rows") * weight).alias("_weight")
            step = rows.select("_features", total, (gradient / weight).alias("_step"))
            grown.append(learner.fit(step))
            columns[k].append(column)
        trees += grown
        if number + 1 < rounds:
            for tree in grown:
                rows = tree.transform(rows)
            moved = [F.col(m) + rate * F.col(f"_tree_{number}_{k}") for k, m in enumerate(margin)]
            rows = rows.select("_features", "_class", "_rows", *[c.alias(m) for c, m in zip(moved, margin, strict=True)])
            rows = materialise(rows, "boost")
    joined = VectorAssembler(inputCols=[f"_p{k}" for k in range(classes)], outputCol="_probability")
    model = PipelineModel([assembler, *trees, _softmax_stage(columns, rate), joined])
    path = path or work_path(spark, "boosted")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def log_loss(scored: DataFrame, label: str, classes: int) -> DataFrame:
    """Mean log-loss and accuracy of class probabilities ``prob_k`` over labelled rows."""
    probs = F.array(*[F.col(f"prob_{k}") for k in range(classes)])
    own = F.greatest(F.get(probs, F.col(label).cast("int")), F.lit(1e-15))
    hit = (F.col("predicted_class") == F.col(label)).cast("double")
    labelled = scored.filter(F.col(label).isNotNull())
    return labelled.agg(F.avg(-F.log(own)).alias("log_loss"), F.avg(hit).alias("accuracy"))
