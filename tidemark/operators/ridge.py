"""Linear regression with an L2 penalty, fitted and cross-validated from co-moments: one scan of the rows in all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import double
from .moments import Moments, grouped_moments


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        terms = [f"{double(f)} * {w!r}D" for f, w in zip(self.features, self.weights)]
        return df.withColumn("prediction", F.expr(" + ".join([f"{self.intercept!r}D", *terms])))


def solve(moments: Moments, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept; the last column is the target.

    The penalty is on weights of standardised columns, in units of the target; the intercept has none. A constant
    feature gets weight 0, and so does every feature of a constant target.
    """
    deviation = np.sqrt(np.maximum(np.diag(moments.spread), 0))
    target = deviation[-1]
    varied = np.flatnonzero(deviation[:-1] > 0)
    weights = np.zeros(len(deviation) - 1)
    if target > 0 and len(varied):
        inner = moments.spread[np.ix_(varied, varied)] / np.outer(deviation[varied], deviation[varied])
        outer = moments.spread[varied, -1] / (deviation[varied] * target)
        scaled = np.linalg.solve(inner + penalty / target * np.eye(len(varied)), outer)
        weights[varied] = scaled * target / deviation[varied]
    return weights, float(moments.mean[-1] - weights @ moments.mean[:-1])


def mean_squared_error(moments: Moments, weights: np.ndarray, intercept: float) -> float:
    """Of the rows that ``moments`` summarises."""
    contrast = np.append(-weights, 1.0)
    return float(contrast @ moments.spread @ contrast + (contrast @ moments.mean - intercept) ** 2)


def cross_validate(rows: DataFrame, features: Sequence[str], target: str, fold: str, penalty: float) -> tuple[float, LinearModel]:
    """Mean RMSE over the folds, each predicted by the fit on the others, and the fit on all rows.

    ``rows`` are complete. The driver gets one row of sums a fold.
    """
    columns = [*features, target]
    parts = {row[fold]: Moments.of_row(row, len(columns)) for row in grouped_moments(rows, [fold], columns).collect()}
    if not parts:
        raise ValueError("no complete rows to fit on")
    errors = []
    for own, held in sorted(parts.items()):
        others = [part for key, part in parts.items() if key != own]
        if others:
            errors.append(np.sqrt(max(0.0, mean_squared_error(held, *solve(Moments.merged(others), penalty)))))
    weights, intercept = solve(Moments.merged([parts[key] for key in sorted(parts)]), penalty)
    model = LinearModel(tuple(features), tuple(float(w) for w in weights), intercept)
    return float(np.mean(errors)) if errors else float("nan"), model
