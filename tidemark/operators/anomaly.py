"""Group baselines and deviations from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.buckets import ladder, lookup, position
from ..functions.numeric import abs_zscore, double, stable_round
from ..functions.timeparts import TIME_DOMAINS

# A baseline with at most this many rows is sent to every executor.
BROADCAST_ROWS = 10_000


def _largest(columns: Sequence[str]) -> str:
    """The greatest value, NULLs skipped: one undefined deviation does not hide the other."""
    return f"greatest({', '.join(columns)})" if len(columns) > 1 else columns[0]


def baseline(df: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each measure per group, and the group's size."""
    stats = [
        text
        for m in measures
        for text in (f"avg({double(m)}) AS typical_{m}", f"stddev_samp({double(m)}) AS {m}_std")
    ]
    grouped = df.groupBy(F.struct(*by).alias("_by")).agg(*[F.expr(s) for s in [*stats, "count(*) AS typical_count"]])
    # Grouped by a struct so that a join on the plain keys shuffles it afresh; see merge_sources.
    return grouped.select("_by.*", *[c for c in grouped.columns if c != "_by"])


def with_baseline(
    df: DataFrame, by: Sequence[str], measures: Sequence[str], domains: Mapping[str, int] = TIME_DOMAINS
) -> DataFrame:
    """Each row with its group's baseline. Rows with a NULL group key have none and drop out.

    If every key has a known small domain (hour, weekday...) the baseline has at most the product of
    those sizes as rows and is broadcast. Otherwise it grows with the data and is joined by a shuffle,
    whose hot keys AQE can split.
    """
    stats = baseline(df, by, measures)
    sizes = [domains.get(k) for k in by]
    if all(sizes) and prod(sizes) <= BROADCAST_ROWS:
        stats = F.broadcast(stats)
    return df.join(stats, list(by))


def deviations(
    df: DataFrame,
    by: Sequence[str] = ("hour_of_day",),
    measures: Sequence[str] = ("valence", "energy"),
    domains: Mapping[str, int] = TIME_DOMAINS,
) -> DataFrame:
    """Rows with the z-score of each measure against the baseline of their group."""
    scored = with_baseline(df, by, measures, domains)
    z = [f"{abs_zscore(double(m), f'typical_{m}', f'{m}_std')} AS {m}_deviation" for m in measures]
    return scored.selectExpr("*", *z)


def anomaly_events(
    df: DataFrame,
    by: Sequence[str] = ("hour_of_day",),
    measures: Sequence[str] = ("valence", "energy"),
    limit: float = 2.0,
    domains: Mapping[str, int] = TIME_DOMAINS,
) -> DataFrame:
    """Rows further than ``limit`` deviations from their baseline, with ``anomaly_score`` = the largest z-score."""
    scored = deviations(df, by, measures, domains)
    score = _largest([f"{m}_deviation" for m in measures])
    return scored.selectExpr("*", f"{score} AS anomaly_score").where(f"anomaly_score > {limit}")


def anomaly_summary(
    df: DataFrame,
    by: Sequence[str] = ("hour_of_day",),
    measures: Sequence[str] = ("valence", "energy"),
    limit: float = 2.0,
    severity_cuts: tuple[float, float] = (3.0, 2.5),
    names: Mapping[str, str] | None = None,
    domains: Mapping[str, int] = TIME_DOMAINS,
) -> DataFrame:
    """Anomalies per group with a severity, most severe first. ``names`` renames measures in the output."""
    names = names or {}
    means = {f"avg_{names.get(m, m)}_deviation": f"{m}_deviation" for m in measures}
    grouped = anomaly_events(df, by, measures, limit, domains).groupBy(*by).agg(
        F.expr("count(*) AS anomaly_count"), *[F.expr(f"avg({z}) AS {a}") for a, z in means.items()]
    )
    severity = ladder(_largest(list(means)), list(zip(severity_cuts, words.SEVERITY)), words.SEVERITY[-1], op=">")
    table = grouped.selectExpr("*", f"{severity} AS anomaly_severity").selectExpr(
        *by,
        "anomaly_count",
        *[f"{stable_round(a, 3)} AS {a}" for a in means],
        "anomaly_severity",
        f"{lookup('anomaly_severity', words.SEVERITY_TEXT, words.SEVERITY_TEXT_DEFAULT)} AS interpretation",
    )
    return table.orderBy(F.expr(position("anomaly_severity", words.SEVERITY)), F.desc("anomaly_count"), *by)
