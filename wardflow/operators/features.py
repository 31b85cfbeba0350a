"""Risk features per stay, scoring, tiers and reasons, as batch jobs over all stays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import (
    STAY_CLASSES,
    risk_reasons,
    risk_tier,
    shock_index,
    stay_class_label,
)
from ..functions.text import contains_keyword
from ..session import work_path
from .joins import spread_join

# Vital signs and diagnosis groups that make up the feature vector.
VITALS = ("heart_rate", "sbp", "spo2", "resp_rate", "temperature")
DIAGNOSIS_KEYWORDS = {
    "has_sepsis": "sepsis",
    "has_heart_failure": "heart failure",
    "has_pneumonia": "pneumonia",
    "has_resp_failure": "respiratory failure",
}
# Chart item codes of the vital signs.
VITAL_ITEMS = {
    "heart_rate": 220045,
    "sbp": 220179,
    "spo2": 220277,
    "resp_rate": 220210,
    "temperature": 223761,
}


def vital_features(
    events: DataFrame, stays: DataFrame, items: Mapping[str, object], hours: int = 24
) -> DataFrame:
    """Mean, min and max of each vital sign in the first hours of a stay, one row per stay.

    The item filter runs before the join, the join spreads a hot stay over several tasks, and
    the aggregation is conditional in one pass, so only partial aggregates move after the join.
    """
    wanted = events.filter(F.col("itemid").isin(*items.values()))
    length = F.expr(f"INTERVAL {int(hours)} HOURS")
    slim = wanted.select("stay_id", "itemid", "charttime", "valuenum")
    early = spread_join(slim, stays.select("stay_id", "intime"), ["stay_id"]).filter(
        (F.col("charttime") >= F.col("intime"))
        & (F.col("charttime") < F.col("intime") + length)
    )
    measures = []
    for agg_name, agg in (("mean", F.avg), ("min", F.min), ("max", F.max)):
        for vital, code in items.items():
            picked = F.when(F.col("itemid") == F.lit(code), F.col("valuenum"))
            measures.append(agg(picked).alias(f"{agg_name}_{vital}"))
    return early.groupBy("stay_id").agg(*measures)


def diagnosis_features(
    diagnoses: DataFrame, by: str, keywords: Mapping[str, str] = DIAGNOSIS_KEYWORDS
) -> DataFrame:
    """Diagnosis count and keyword flags per stay (or any other key)."""
    flags = [
        F.coalesce(F.max(contains_keyword(F.col("long_title"), kw).cast("int")), F.lit(0)).alias(n)
        for n, kw in keywords.items()
    ]
    return diagnoses.groupBy(by).agg(F.count(F.lit(1)).alias("dx_count"), *flags)


def demographic_columns(
    age: Column, gender: Column, admission_type: Column, male="M", emergency="EMERGENCY"
) -> list[Column]:
    return [
        age.alias("age"),
        F.when(gender == male, 1).otherwise(0).alias("is_male"),
        F.when(contains_keyword(admission_type, emergency), 1).otherwise(0).alias("is_emergency"),
    ]


def stay_features(stays: DataFrame, vitals: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Assemble the feature row of every stay; stays without measurements keep NULL vitals.

    ``stays`` carries ``stay_id`` and the demographic columns; the other two sides hold one row
    per stay, so both joins are 1:1 on the same key and share its partitioning.
    """
    joined = stays.join(vitals, "stay_id", "left").join(diagnoses, "stay_id", "left")
    filled = joined.fillna(0, subset=["dx_count", *[c for c in diagnoses.columns if "has_" in c]])
    index = shock_index(F.col("mean_heart_rate"), F.col("mean_sbp"))
    return filled.withColumn("shock_index", index)


def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns in model order as doubles; features the frame lacks, and NULLs, become 0."""
    have = set(df.columns)
    return df.select(
        *keep,
        *[
            (F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in have else F.lit(0.0)).alias(n)
            for n in names
        ],
    )


class LinearModel(NamedTuple):
    """Weights by feature name; a missing feature counts as 0."""

    intercept: float
    weights: Mapping[str, float]

    def logit(self, df: DataFrame) -> Column:
        have = set(df.columns)
        total = F.lit(self.intercept)
        for name, weight in self.weights.items():
            if name in have:
                value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
                total = total + value * F.lit(weight)
        return total


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_binary(df: DataFrame, model: LinearModel, name: str) -> DataFrame:
    """Add a probability as column arithmetic; stays in generated JVM code."""
    return df.withColumn(name, logistic(model.logit(df)))


def score_stay_class(df: DataFrame, models: Sequence[LinearModel]) -> DataFrame:
    """Softmax over the length-of-stay classes: class index, label and confidence."""
    logits = [f"_z{i}" for i in range(len(models))]
    scored = df.withColumns({z: m.logit(df) for z, m in zip(logits, models, strict=True)})
    top = F.greatest(*logits)
    weights = [F.exp(F.col(z) - top) for z in logits]
    total = sum(weights[1:], weights[0])
    index = None
    for i, z in enumerate(logits):
        hit = F.col(z) == top
        index = F.when(hit, i) if index is None else index.when(hit, i)
    return (
        scored.withColumn("stay_class", index)
        .withColumn("stay_confidence", F.lit(1.0) / total)
        .withColumn("stay_label", stay_class_label(F.col("stay_class")))
        .drop(*logits)
    )


def risk_report(
    features: DataFrame,
    mortality: LinearModel,
    readmission: LinearModel,
    stay_models: Sequence[LinearModel],
) -> DataFrame:
    """All risk outputs per stay: two probabilities with tiers, stay class, reasons."""
    scored = score_binary(features, mortality, "mortality_prob")
    scored = score_binary(scored, readmission, "readmission_prob")
    scored = score_stay_class(scored, stay_models)
    return scored.withColumns(
        {
            "mortality_tier": risk_tier(F.col("mortality_prob")),
            "readmission_tier": risk_tier(F.col("readmission_prob"), medium=None),
            "reasons": risk_reasons(
                F.col("dx_count"),
                F.col("has_sepsis"),
                F.col("shock_index"),
                F.col("is_emergency"),
            ),
        }
    )


def train_classifier(features: DataFrame, names: Sequence[str], label: str, path=None, **params):
    """Fit a logistic regression pipeline on the aligned feature vector and store it.

    The stored model is returned rather than the fitted object: that one holds its training
    summary and with it the session, which cannot be sent to tasks once a load has counted rows
    with observations.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    stages = [
        VectorAssembler(inputCols=list(names), outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol=label, probabilityCol="_probability", **params
        ),
    ]
    fitted = Pipeline(stages=stages).fit(align_features(features, names, keep=[label]))
    path = path or work_path(features.sparkSession, "model")
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def apply_classifier(model, features: DataFrame, names: Sequence[str], keep: Sequence[str]):
    """Class index and its probability for every row, whatever model the pipeline ends in."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(align_features(features, names, keep=keep))
    probs = vector_to_array(F.col("_probability"))
    picked = F.col("prediction").cast("int")
    return scored.select(
        *keep,
        picked.alias("predicted_class"),
        F.get(probs, picked).alias("confidence"),
        F.get(probs, F.lit(1)).alias("positive_prob"),
    )


def class_probabilities(
    model, features: DataFrame, names: Sequence[str], keep: Sequence[str], classes: int
) -> DataFrame:
    """``keep``, the predicted class and a column ``prob_k`` for each class of the model."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(align_features(features, names, keep=keep))
    probs = vector_to_array(F.col("_probability"))
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("predicted_class"),
        *[F.get(probs, F.lit(k)).alias(f"prob_{k}") for k in range(classes)],
    )


def class_names() -> dict[int, str]:
    return dict(STAY_CLASSES)
