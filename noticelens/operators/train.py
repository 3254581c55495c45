"""Classifiers on Spark ML: cross-validation, Platt scaling, soft-label students."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.fixed_values import SEED
from noticelens.functions.scoring import array_cells, total
from noticelens.operators.classes import class_weights, stratified_folds
from noticelens.operators.evaluate import classification_metrics, fold_summary
from noticelens.session import lookup, written


@dataclass
class CrossValidation:
    """Per-fold metrics and the model of the best fold."""

    metrics: DataFrame
    summary: DataFrame
    best_model: LogisticRegressionModel


def train_cv(
    df: DataFrame,
    key: str = "id",
    label: str = "label",
    features: str = "features",
    k: int = 5,
    weights: str = "auto",
    seed: int = SEED,
    max_iter: int = 20,
    reg: float = 0.01,
) -> CrossValidation:
    """Stratified k-fold training with class weights; keeps the earliest best fold.

    The fold and weight columns are materialised once in the shared folder; each
    fit then reads that table with a filter.
    """
    folded = stratified_folds(df.select(key, label, features), key, label, k, seed)
    per_class = class_weights(folded, label, weights).select(label, "weight")
    table = written(lookup(folded, per_class, [label]), "train")
    family = LogisticRegression(
        featuresCol=features, labelCol=label, weightCol="weight", maxIter=max_iter, regParam=reg
    )
    models = [family.fit(table.filter(F.col("fold") != i)) for i in range(k)]
    scored = [
        model.transform(table.filter(F.col("fold") == i)).select(
            "fold", F.col(label).cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred")
        )
        for i, model in enumerate(models)
    ]
    every = reduce(DataFrame.unionByName, scored)
    metrics = written(classification_metrics(every, "truth", "pred", ["fold"]), "train")
    summary = fold_summary(metrics)
    best = summary.first()["best_fold"]
    return CrossValidation(metrics, summary, models[best])


def platt_fit(
    df: DataFrame, logit: str = "logit", label: str = "label", c: float = 1.0
) -> LogisticRegressionModel:
    """Logistic curve on the positive-class logit, L2 penalty of strength 1/(c n)."""
    table = df.select(F.col(label).cast("double").alias(label), _vector(logit))
    n = table.count()
    curve = LogisticRegression(
        featuresCol="_logit", labelCol=label, regParam=1.0 / (c * max(1, n)), standardization=False,
        maxIter=200, tol=1e-12,
    )
    return curve.fit(table)


def _vector(logit: str):
    return array_to_vector(F.array(F.col(logit).cast("double"))).alias("_logit")


def platt_apply(
    df: DataFrame, model: LogisticRegressionModel, logit: str = "logit", out: str = "calibrated"
) -> DataFrame:
    """Adds the calibrated probability; the fitted curve is a plain column expression."""
    slope, shift = float(model.coefficients[0]), float(model.intercept)
    return df.withColumn(out, 1 / (1 + F.exp(-(F.col(logit).cast("double") * slope + shift))))


def distill_train(
    df: DataFrame,
    teacher: str,
    k: int,
    features: str = "features",
    temperature: float = 1.0,
    max_iter: int = 20,
    reg: float = 0.01,
) -> LogisticRegressionModel:
    """Student fitted on the teacher's probabilities.

    Each row becomes one row per class, weighted by the teacher's probability of
    that class, which makes the weighted fit the soft-label cross entropy.
    """
    cells = [c / temperature for c in array_cells(F.col(teacher), k)]
    top = F.greatest(*cells)
    exps = [F.exp(c - top) for c in cells]
    shares = df.select(features, F.array(*exps).alias("_e"), total(exps).alias("_z"))
    soft = shares.select(features, "_z", F.posexplode("_e").alias("label", "_p")).select(
        features, F.col("label").cast("double").alias("label"), (F.col("_p") / F.col("_z")).alias("weight")
    )
    student = LogisticRegression(
        featuresCol=features, labelCol="label", weightCol="weight", maxIter=max_iter, regParam=reg,
        family="multinomial",
    )
    return student.fit(soft)


def student_logits(df: DataFrame, model: LogisticRegressionModel, out: str = "logits") -> DataFrame:
    scored = model.transform(df).withColumn(out, vector_to_array(model.getRawPredictionCol()))
    return scored.drop(model.getRawPredictionCol(), model.getProbabilityCol())
