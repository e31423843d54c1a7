"""Declarative data checks. All checks of a table share one aggregate; only key checks need their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import double, literal, percent
from ..schemas import schema


@dataclass(frozen=True)
class Check:
    """What is looked at, and the threshold the observation is held against (``kind``: at_most, at_least or near)."""

    name: str
    column: str | None
    threshold: float
    kind: str
    low: float = 0.0
    high: float = 0.0
    keys: tuple[str, ...] = field(default=())


def nulls_at_most(column: str, max_pct: float = 5.0) -> Check:
    return Check("nulls", column, max_pct, "at_most")


def within(column: str, low: float, high: float) -> Check:
    return Check("range", column, 0.0, "at_most", low=low, high=high)


def rows_at_least(minimum: int) -> Check:
    return Check("row_count", None, float(minimum), "at_least")


def unique(*keys: str) -> Check:
    return Check("duplicates", ",".join(keys), 0.0, "at_most", keys=keys)


def has_columns(*columns: str) -> Check:
    return Check("schema", None, 0.0, "at_most", keys=columns)


def mean_near(column: str, expected: float, tolerance: float = 0.3) -> Check:
    return Check("distribution", column, tolerance, "near", low=expected)


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return sorted(set(columns) - set(df.columns))


def extra_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return sorted(set(df.columns) - set(columns))


def _observed(df: DataFrame, check: Check) -> str:
    """The aggregate a check looks at."""
    if check.name == "nulls":
        fractional = dict(df.dtypes)[check.column] in ("float", "double")
        absent = f"`{check.column}` IS NULL" + (f" OR isnan(`{check.column}`)" if fractional else "")
        return percent(f"count_if({absent})", "count(*)", digits=4)
    if check.name == "range":
        return f"count_if(`{check.column}` < {check.low} OR `{check.column}` > {check.high})"
    if check.name == "row_count":
        return "count(*)"
    if check.name == "distribution":
        return f"coalesce(avg({double(f'`{check.column}`')}), 0D)"
    if check.name == "duplicates":
        return "coalesce(sum(_copies - 1), 0)"
    return str(len(missing_columns(df, check.keys)))


_VERDICTS = {"at_most": "{o} <= {t}", "at_least": "{o} >= {t}", "near": "abs({o} - {e}) <= {t}"}


def _row(layer: str, table: str, check: Check, observed: str) -> str:
    observed, limit = double(observed), literal(float(check.threshold))
    verdict = _VERDICTS[check.kind].format(o=observed, t=limit, e=literal(float(check.low)))
    return (
        f"named_struct('layer', {literal(layer)}, 'table', {literal(table)}, 'check', {literal(check.name)}, "
        f"'column', CAST({literal(check.column)} AS STRING), 'observed', {observed}, 'threshold', {limit}, "
        f"'passed', coalesce({verdict}, false))"
    )


def _runnable(df: DataFrame, check: Check) -> bool:
    wanted = check.keys if check.name == "duplicates" else [check.column] if check.column else []
    return not missing_columns(df, wanted)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str, layer: str = "table") -> DataFrame:
    """One row per check. A check on a column that does not exist fails with a NULL observation."""
    by_key = [c for c in checks if c.name == "duplicates" and _runnable(df, c)]
    shared = [c for c in checks if c not in by_key]
    parts = []
    if shared:
        rows = [_row(layer, table, c, _observed(df, c) if _runnable(df, c) else "NULL") for c in shared]
        # count(*) keeps this an aggregate even if every check is already decided.
        whole = df.agg(F.expr(f"array({', '.join(rows)}) AS _rows"), F.expr("count(*) AS _n"))
        parts.append(whole.selectExpr("inline(_rows)"))
    for check in by_key:
        per_key = df.groupBy(*check.keys).agg(F.expr("count(*) AS _copies"))
        row = _row(layer, table, check, _observed(df, check))
        parts.append(per_key.agg(F.expr(f"array({row}) AS _rows")).selectExpr("inline(_rows)"))
    return reduce(DataFrame.unionByName, parts)


def run_suite(
    spark: SparkSession, tables: Mapping[str, tuple[DataFrame | None, Sequence[Check]]], layer: str
) -> DataFrame:
    """Checks of several tables. A table that does not exist is one failed check."""
    parts = []
    for name, (df, checks) in tables.items():
        if df is None:
            row = (layer, name, "exists", None, 0.0, 1.0, False)
            parts.append(spark.createDataFrame([row], schema("check_results")))
        else:
            parts.append(run_checks(df, checks, name, layer))
    return reduce(DataFrame.unionByName, parts)


def report(results: DataFrame) -> DataFrame:
    """Totals per layer and overall (layer ``all``)."""
    both = results.selectExpr("explode(array(layer, 'all')) AS layer", "passed")
    passed = "count_if(passed)"
    return both.groupBy("layer").agg(
        F.expr("count(*) AS total_checks"),
        F.expr(f"{passed} AS passed_checks"),
        F.expr(f"count(*) - {passed} AS failed_checks"),
        F.expr(f"{percent(passed, 'count(*)')} AS pass_rate"),
    )


# --- the layer suites ----------------------------------------------------------------------------

# Expected floors, ranges and means of the stored tables. Days run from 1 to 7.
BRONZE_CHECKS = {
    "kaggle_tracks_bronze": (
        rows_at_least(100_000),
        has_columns(
            "track_id", "track_name", "artists", "valence", "energy", "danceability", "acousticness", "tempo"
        ),
        within("valence", 0.0, 1.0),
        within("energy", 0.0, 1.0),
        within("danceability", 0.0, 1.0),
        within("tempo", 40.0, 250.0),
        nulls_at_most("track_id", 0.0),
    ),
    "listening_history_bronze": (
        rows_at_least(100),
        has_columns("played_at", "track_id", "track_name", "artist_name"),
        nulls_at_most("played_at", 0.0),
        unique("played_at", "track_id"),
    ),
}
SILVER_CHECKS = {
    "listening_with_features": (
        rows_at_least(100),
        has_columns(
            "played_at", "track_name", "artist_name", "valence", "energy", "danceability", "hour_of_day",
            "day_of_week",
        ),
        within("valence", 0.0, 1.0),
        within("energy", 0.0, 1.0),
        within("hour_of_day", 0, 23),
        within("day_of_week", 1, 7),
        nulls_at_most("valence", 1.0),
        mean_near("valence", 0.5, 0.25),
        mean_near("energy", 0.525, 0.25),
    ),
}
GOLD_CHECKS = {
    "listening_patterns_by_time": (rows_at_least(1), has_columns("hour_of_day", "play_count")),
    "temporal_trends": (rows_at_least(1), has_columns("date", "total_plays")),
    "mood_time_correlations": (rows_at_least(1), has_columns("hour_of_day", "avg_valence")),
    "mood_predictions": (rows_at_least(1), has_columns("valence", "predicted_valence")),
    "mood_state_clusters": (rows_at_least(1), has_columns("cluster", "member_count")),
}
