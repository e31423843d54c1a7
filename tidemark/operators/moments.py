"""Counts, means and co-moments: one mergeable summary from which correlations and linear fits follow."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import double, literal


def grouped_moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group: ``n``, means ``m<i>`` and co-moments ``c<i>_<j>`` (i <= j, divided by n) of complete rows.

    One hash aggregate whose partial results merge by the parallel-variance rule, so large means cost no digits.
    """
    values = df.selectExpr(*keys, *[f"{double(c)} AS x{i}" for i, c in enumerate(columns)])
    places = range(len(columns))
    return values.groupBy(*keys).agg(
        F.expr("count(*) AS n"),
        *[F.expr(f"avg(x{i}) AS m{i}") for i in places],
        *[
            F.expr(f"{f'var_pop(x{i})' if i == j else f'covar_pop(x{i}, x{j})'} AS c{i}_{j}")
            for i, j in combinations_with_replacement(places, 2)
        ],
    )


def pair_moments(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(feature_1, feature_2, n, xx, yy, xy) of every pair of measures, over the rows that have both.

    Rows are summarised once per pattern of missing values (at most 2 ^ measures, mostly one); a pair then adds up
    the patterns that have both. A pair without such rows has n = 0.
    """
    places = range(len(measures))
    missing = " + ".join(f"if({m} IS NULL, {1 << i}, 0)" for i, m in zip(places, measures))
    table = grouped_moments(df.selectExpr("*", f"{missing} AS _missing"), ["_missing"], measures)
    cells = [
        f"named_struct('feature_1', {literal(measures[i])}, 'feature_2', {literal(measures[j])}, 'n', "
        f"if((_missing & {1 << i | 1 << j}) = 0, n, 0L), 'x', m{i}, 'y', m{j}, 'xx', c{i}_{i}, 'yy', c{j}_{j}, 'xy', c{i}_{j})"
        for i, j in combinations(places, 2)
    ]
    parts = table.selectExpr(f"inline(array({', '.join(cells)}))").where("n > 0")
    # a few rows a pair: one for each pattern
    pair = Window.partitionBy("feature_1", "feature_2")
    total = F.sum("n").over(pair)
    means = [(F.sum(F.expr(f"n * {v}")).over(pair) / total).alias(f"m{v}") for v in ("x", "y")]
    added = parts.select("*", *means).groupBy("feature_1", "feature_2").agg(
        F.expr("sum(n) AS n"),
        F.expr("sum(n * (xx + (x - mx) * (x - mx))) AS xx"),
        F.expr("sum(n * (yy + (y - my) * (y - my))) AS yy"),
        F.expr("sum(n * (xy + (x - mx) * (y - my))) AS xy"),
    )
    names = [f"({literal(a)}, {literal(b)})" for a, b in combinations(measures, 2)]
    pairs = df.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(names)} AS t(feature_1, feature_2)")
    return pairs.join(added, ["feature_1", "feature_2"], "left").na.fill(0, ["n"])


class Moments:
    """n, means and co-moments (divided by n) of some columns, on the driver: a few numbers whatever the rows."""

    def __init__(self, n: int, mean: np.ndarray, spread: np.ndarray):
        self.n, self.mean, self.spread = n, mean, spread

    @classmethod
    def of_row(cls, row, count: int) -> Moments:
        spread = np.empty((count, count))
        for i, j in combinations_with_replacement(range(count), 2):
            spread[i, j] = spread[j, i] = row[f"c{i}_{j}"]
        return cls(row["n"], np.array([row[f"m{i}"] for i in range(count)]), spread)

    @classmethod
    def merged(cls, parts: Sequence[Moments]) -> Moments:
        n = sum(p.n for p in parts)
        mean = sum(p.n * p.mean for p in parts) / n
        spread = sum(p.n * (p.spread + np.outer(p.mean - mean, p.mean - mean)) for p in parts) / n
        return cls(n, mean, spread)
