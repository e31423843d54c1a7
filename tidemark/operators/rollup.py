"""A stored rollup of the events by date and hour, from which coarser profiles follow without reading events.

A row holds, for each measure, the number of values, their mean and the sum of squared deviations from it. Such rows
add up by the parallel-variance rule, so any grouping by the rollup's keys is exact. There are at most 24 rows a date
(one for each hour), whatever the number of events; a date is replaced by itself when its events change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import double, stable_round
from ..functions.timeparts import TIME_KEYS
from .profiles import DIGITS, DIGITS_BY_MEASURE

KEYS = ("date", *TIME_KEYS)
MEASURES = ("valence", "energy", "danceability", "acousticness", "instrumentalness", "tempo")


def roll_up(df: DataFrame, keys: Sequence[str] = KEYS, measures: Sequence[str] = MEASURES) -> DataFrame:
    """(keys, n, and per measure count_<m>, mean_<m>, square_<m>) from one scan."""
    statistics = [
        text
        for m in measures
        for text in (
            f"count({m}) AS count_{m}",
            f"avg({double(m)}) AS mean_{m}",
            f"var_pop({double(m)}) * count({m}) AS square_{m}",
        )
    ]
    return df.groupBy(*keys).agg(F.expr("count(*) AS n"), *[F.expr(s) for s in statistics])


def with_date(df: DataFrame, ts: str = "played_at") -> DataFrame:
    return df if "date" in df.columns else df.withColumn("date", F.to_date(ts))


def refreshed(df: DataFrame, dates: DataFrame, keys: Sequence[str] = KEYS, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Rollup rows of the listed dates only; a date without events left gets one row with n = 0."""
    own = roll_up(df.join(F.broadcast(dates), "date", "left_semi"), keys, measures)
    gone = dates.join(own.select("date"), "date", "left_anti").withColumn("n", F.lit(0).cast("bigint"))
    return own.unionByName(gone, allowMissingColumns=True)


def merged(rolled: DataFrame, keys: Sequence[str], measures: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """Rollup rows added up to coarser keys: n, count_<m>, mean_<m>, square_<m>, and events under conditions on keys."""
    group = Window.partitionBy(*keys)
    placed = rolled.where("n > 0").select(
        "*",
        *[
            F.try_divide(F.sum(F.expr(f"count_{m} * mean_{m}")).over(group), F.sum(f"count_{m}").over(group)).alias(f"_mean_{m}")
            for m in measures
        ],
    )
    return placed.groupBy(*keys).agg(
        F.expr("sum(n) AS n"),
        *[
            F.expr(text)
            for m in measures
            for text in (
                f"sum(count_{m}) AS count_{m}",
                f"first(_mean_{m}) AS mean_{m}",
                f"sum(square_{m} + count_{m} * (mean_{m} - _mean_{m}) * (mean_{m} - _mean_{m})) AS square_{m}",
            )
        ],
        *[F.expr(f"coalesce(sum(n) FILTER (WHERE {condition}), 0L) AS {name}") for name, condition in counts.items()],
    )


def rolled_profile(
    rolled: DataFrame,
    keys: Sequence[str],
    means: Sequence[str],
    spreads: Mapping[str, str] | None = None,
    count_as: str = "play_count",
    counts: Mapping[str, str] | None = None,
    digits: Mapping[str, int] = DIGITS_BY_MEASURE,
) -> DataFrame:
    """What ``profiles.grouped_profile`` gives on the events, from their rollup."""
    spreads, counts = spreads or {}, counts or {}
    measures = list(dict.fromkeys([*means, *spreads]))

    def rounded(value: str, measure: str, name: str) -> str:
        return f"{stable_round(value, digits.get(measure, DIGITS))} AS {name}"

    return merged(rolled, keys, measures, counts).selectExpr(
        *keys,
        f"n AS {count_as}",
        *[rounded(f"mean_{m}", m, f"avg_{m}") for m in means],
        *[rounded(f"sqrt(try_divide(square_{m}, CAST(count_{m} - 1 AS DOUBLE)))", m, name) for m, name in spreads.items()],
        *counts,
    )
