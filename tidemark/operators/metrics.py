"""Model scores as aggregates over (label, prediction) rows; nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import first_match
from ..functions.numeric import double, ratio


def regression_metrics(df: DataFrame, label: str, prediction: str | Column = "prediction") -> DataFrame:
    """RMSE, MAE and R² in one pass; R² is NULL for a constant label. A Column prediction may be a scalar subquery."""
    guess = F.expr(prediction) if isinstance(prediction, str) else prediction
    pairs = df.select(F.expr(double(label)).alias("actual"), guess.cast("double").alias("guess"))
    errors = pairs.selectExpr("actual", "actual - guess AS error")
    return errors.agg(
        F.expr("sqrt(avg(error * error)) AS rmse"),
        F.expr("avg(abs(error)) AS mae"),
        F.expr("1D - try_divide(avg(error * error), var_pop(actual)) AS r2"),
    )


def baseline_regression(test: DataFrame, label: str, train: DataFrame | None = None) -> DataFrame:
    """Scores of always predicting the mean label: of the test rows, or of the training rows if given."""
    mean = (test if train is None else train).agg(F.expr(f"avg({double(label)})")).scalar()
    return regression_metrics(test, label, mean).withColumn("method", F.lit("mean_predictor"))


def confusion_matrix(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows per (actual, predicted) class."""
    classes = df.selectExpr(f"CAST({label} AS INT) AS actual", f"CAST({prediction} AS INT) AS predicted")
    return classes.groupBy("actual", "predicted").agg(F.count("*").alias("count")).orderBy("actual", "predicted")


def _class_totals(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: rows that are it, rows predicted as it, and rows that are both."""
    as_actual = "named_struct('class', actual, 'support', count, 'guessed', 0L, 'hits', if(actual = predicted, count, 0L))"
    as_predicted = "named_struct('class', predicted, 'support', 0L, 'guessed', count, 'hits', 0L)"
    sides = confusion_matrix(df, label, prediction).selectExpr(f"inline(array({as_actual}, {as_predicted}))")
    return sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])


def per_class_metrics(
    df: DataFrame, label: str, prediction: str = "prediction", names: Mapping[int, str] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class. Classes only ever predicted are listed too, with support 0."""
    scored = _class_totals(df, label, prediction).selectExpr(
        "class", f"{ratio('hits', 'guessed')} AS precision", f"{ratio('hits', 'support')} AS recall", "support"
    )
    known = first_match([(f"class = {code}", name) for code, name in (names or {}).items()], None) if names else "NULL"
    return scored.selectExpr(
        "class",
        f"coalesce({known}, concat('Class_', class)) AS class_name",
        "precision",
        "recall",
        f"{ratio('2 * precision * recall', 'precision + recall')} AS f1",
        "support",
    ).orderBy("class")


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted F1."""
    f1 = ratio("2 * hits", "guessed + support")
    return _class_totals(df, label, prediction).agg(
        F.expr(f"{ratio('sum(hits)', 'sum(support)')} AS accuracy"),
        F.expr(f"{ratio(f'sum({f1} * support)', 'sum(support)')} AS f1"),
    )


def baseline_classification(test: DataFrame, label: str) -> DataFrame:
    """Scores of always predicting the most frequent class (the lowest of several equally frequent ones)."""
    counts = test.selectExpr(f"CAST({label} AS INT) AS class").groupBy("class").agg(F.count("*").alias("n"))
    most = counts.agg(
        F.expr(f"{ratio('max(n)', 'sum(n)')} AS accuracy"),
        F.expr("min_by(class, struct(-n, class)) AS majority_class"),
    )
    # Only the majority class scores: precision = accuracy, recall = 1, weighted by its share.
    return most.selectExpr(
        "accuracy",
        "accuracy * 2 * accuracy / (accuracy + 1) AS f1",
        "majority_class",
        "'majority_class' AS method",
    )
