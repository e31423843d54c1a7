"""Aggregate profiles. Each is one pass over its input with partial aggregation before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.buckets import ladder, position
from ..functions.numeric import double, literal, percent, ratio, stable_round
from ..functions.timeparts import DAY_PARTS, TIME_KEYS
from .moments import pair_moments

Profile = Callable[..., DataFrame]

DIGITS = 3
DIGITS_BY_MEASURE = {"tempo": 1}
DISTRIBUTION_MEASURES = (
    "valence", "energy", "danceability", "acousticness", "instrumentalness", "speechiness", "loudness", "tempo",
)
CORRELATION_MEASURES = (
    "valence", "energy", "danceability", "acousticness", "instrumentalness", "tempo", "loudness",
)


def grouped_profile(
    df: DataFrame,
    keys: Sequence[str],
    means: Sequence[str],
    spreads: Mapping[str, str] | None = None,
    count_as: str = "play_count",
    counts: Mapping[str, str] | None = None,
    extra: Sequence[str] = (),
    digits: Mapping[str, int] = DIGITS_BY_MEASURE,
) -> DataFrame:
    """Per group: row count, rounded means ``avg_<measure>``, sample standard deviations and counts of conditions
    under the given names."""

    def rounded(function: str, measure: str, name: str) -> str:
        return f"{stable_round(f'{function}({double(measure)})', digits.get(measure, DIGITS))} AS {name}"

    statistics = [
        f"count(*) AS {count_as}",
        *[rounded("avg", m, f"avg_{m}") for m in means],
        *[rounded("stddev_samp", m, name) for m, name in (spreads or {}).items()],
        *[f"count_if({condition}) AS {name}" for name, condition in (counts or {}).items()],
        *extra,
    ]
    return df.groupBy(*keys).agg(*[F.expr(e) for e in statistics])


# The next five take events, or with ``profile=rollup.rolled_profile`` their rollup by date and hour.


def patterns_by_time(df: DataFrame, keys: Sequence[str] = TIME_KEYS, profile: Profile = grouped_profile) -> DataFrame:
    means = ("valence", "energy", "danceability", "acousticness", "tempo")
    return profile(df, keys, means).orderBy("hour_of_day", "day_of_week")


def daily_trends(
    df: DataFrame, ts: str | None = "played_at", weekend: str = "is_weekend", profile: Profile = grouped_profile
) -> DataFrame:
    """``ts`` gives the date; None if there is a ``date`` already."""
    dated = df.withColumn("date", F.to_date(ts)) if ts else df
    means = ("valence", "energy", "tempo")
    return profile(dated, ["date"], means, count_as="total_plays", counts={"weekend_plays": weekend}).orderBy("date")


def hourly_profile(df: DataFrame, hour: str = "hour_of_day", profile: Profile = grouped_profile) -> DataFrame:
    means = ("valence", "energy", "danceability", "acousticness")
    spreads = {"valence": "valence_stddev", "energy": "energy_stddev"}
    # A NULL hour has no place in an hourly profile.
    timed = df.where(f"{hour} IS NOT NULL")
    return profile(timed, [hour], means, spreads, count_as="sample_size").orderBy(hour)


def period_compare(
    df: DataFrame, flag: str = "is_weekend", labels: tuple[str, str] = words.PERIOD, profile: Profile = grouped_profile
) -> DataFrame:
    """Weekend against weekday. The ``*_variance`` columns hold standard deviations; the name is historical."""
    means = ("valence", "energy", "danceability", "tempo", "acousticness")
    spreads = {"valence": "valence_variance", "energy": "energy_variance"}
    named = df.withColumn("period", F.expr(f"if({flag}, {literal(labels[0])}, {literal(labels[1])})"))
    found = profile(named, ["period"], means, spreads, count_as="total_plays")
    return found.orderBy(F.expr(position("period", labels)))


def part_of_day_profile(df: DataFrame, part: str = "part_of_day", profile: Profile = grouped_profile) -> DataFrame:
    """Per part of day. The ``*_consistency`` columns hold standard deviations; the name is historical."""
    means = ("valence", "energy", "danceability", "acousticness", "instrumentalness", "tempo")
    spreads = {"valence": "valence_consistency", "energy": "energy_consistency"}
    found = profile(df, [part], means, spreads, count_as="total_plays")
    return found.orderBy(F.expr(position(part, [name for _, _, name in DAY_PARTS])))


def _unfold(df: DataFrame, rows: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One aggregate over the whole table whose structs become rows."""
    table = df.agg(F.expr(f"array({', '.join(rows)}) AS _rows"), *[F.expr(k) for k in keep])
    return table.selectExpr(*[k.split(" AS ")[-1] for k in keep], "inline(_rows)")


def feature_profile(df: DataFrame, measures: Sequence[str] = DISTRIBUTION_MEASURES) -> DataFrame:
    """Mean, spread, min and max of every measure from one aggregate; a statistic that is NULL reads 0."""
    functions = {"mean": "avg", "std_dev": "stddev_samp", "min": "min", "max": "max"}

    def row(measure: str) -> str:
        values = [
            f"'{name}', {stable_round(f'coalesce({f}({double(measure)}), 0D)', DIGITS)}" for name, f in functions.items()
        ]
        return f"named_struct('feature_name', '{measure}', {', '.join(values)})"

    return _unfold(df, [row(m) for m in measures])


def pairwise_corr(
    df: DataFrame,
    measures: Sequence[str] = CORRELATION_MEASURES,
    cuts: tuple[float, float] = (0.7, 0.4),
    labels: tuple[str, str, str] = words.STRENGTH,
) -> DataFrame:
    """Pearson correlation of every pair (upper triangle) over the rows that have both, with its strength.

    From the co-moments of one scan; 0 where it is undefined (no rows, constant column).
    """
    r = ratio("xy", "(sqrt(xx) * sqrt(yy))")
    table = pair_moments(df, measures).selectExpr("feature_1", "feature_2", f"{r} AS r")
    strength = ladder("abs(r)", list(zip(cuts, labels)), labels[-1], op=">")
    return table.selectExpr(
        "feature_1", "feature_2", f"{stable_round('r', DIGITS)} AS correlation", f"{strength} AS strength"
    ).orderBy(F.desc("correlation"), "feature_1", "feature_2")


def category_counts(df: DataFrame, *keys: str, count_as: str = "record_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count_as))


def share_of_total(df: DataFrame, *keys: str, count_as: str = "record_count") -> DataFrame:
    """Rows per group and their share in percent.

    The total is a scalar subquery over the same counts, so nothing is gathered in one window partition
    however many groups there are.
    """
    counts = category_counts(df, *keys, count_as=count_as)
    total = counts.agg(F.sum(count_as)).scalar()
    shared = counts.withColumn("_total", total).selectExpr(
        *keys, count_as, f"{percent(count_as, '_total')} AS percentage"
    )
    return shared.orderBy(F.desc(count_as), *keys)


def distinct_count(df: DataFrame, *keys: str, approximate: bool = False, relative_error: float = 0.02) -> DataFrame:
    """Number of distinct keys (all-NULL keys not counted); optionally a HyperLogLog estimate without a wide shuffle."""
    target = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    if approximate:
        return df.agg(F.approx_count_distinct(target, relative_error).alias("distinct_count"))
    return df.agg(F.count_distinct(target).alias("distinct_count"))


def null_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """Columns with NULLs (all, or the first ``top``), most first, from one aggregate."""
    rows = [
        f"named_struct('column_name', {literal(c)}, 'null_count', count_if(`{c}` IS NULL))" for c in df.columns
    ]
    found = _unfold(df, rows, keep=["count(*) AS row_count"]).where("null_count > 0")
    shares = found.selectExpr("column_name", "null_count", f"{percent('null_count', 'row_count')} AS null_percentage")
    ordered = shares.orderBy(F.desc("null_count"), "column_name")
    return ordered if top is None else ordered.limit(top)
