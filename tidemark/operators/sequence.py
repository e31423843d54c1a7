"""Ordered operators: previous row, change patterns, state transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.buckets import Quadrants, change_class, first_match, lookup, quadrant
from ..functions.numeric import double, literal, stable_round


BUCKET_SECONDS = 600


def time_bucket(df: DataFrame, column: str, width: int) -> str:
    """Number of the stretch of ``width`` seconds (or units of a number) that a value falls in; never falls as it rises."""
    name, kind = f"`{column}`", df.schema[column].dataType.typeName()
    seconds = {
        "timestamp": f"unix_seconds({name})",
        "timestamp_ntz": f"(unix_date(CAST({name} AS DATE)) * 86400L + hour({name}) * 3600 + minute({name}) * 60 + second({name}))",
        "date": f"(unix_date({name}) * 86400L)",
    }.get(kind, name)
    return f"CAST(floor({seconds} / {width}) AS BIGINT)"


def with_previous(
    df: DataFrame,
    values: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = (),
    prefix: str = "prev_",
    width: int = BUCKET_SECONDS,
) -> DataFrame:
    """Append the value of each listed column in the previous row: over the whole table, or within ``by``.

    A plain window would sort the whole table, or all rows of the largest ``by`` group, in one task. Here
    the rows are dealt once by (by, time bucket) and ``lag`` runs inside a bucket. The last row of every bucket, an
    aggregate merged before its shuffle, is handed on to the next bucket that has rows: there it is one more row in
    front of the others. Buckets depend on the rows' times alone, so a recomputed task finds the same ones and nothing
    needs to be stored. The hand-over sorts one row a bucket (of the whole table, or of one ``by`` group).

    ``order`` starts with a time or a finite number and must be unique within ``by`` (end it with an id). A task sorts
    the rows of one bucket of one group: choose ``width`` for the densest stretch of time.
    """
    bucketed = df.selectExpr("*", f"{time_bucket(df, order[0], width)} AS _bucket", "1 AS _own")
    carried = F.struct(*values)
    last = bucketed.groupBy(*by, "_bucket").agg(F.max(F.struct(*order, carried.alias("_carried"))).alias("_last"))
    following = Window.partitionBy(*by).orderBy("_bucket")
    handed = last.select(*by, "_bucket", F.lag("_last._carried").over(following).alias("_carried")).where("_carried IS NOT NULL")
    front = [f"_carried.`{c}` AS `{c}`" for c in values if c not in by]
    missing = [
        f"CAST(NULL AS {df.schema[c].dataType.simpleString()}) AS `{c}`" for c in df.columns if c not in values and c not in by
    ]
    rows = bucketed.unionByName(handed.selectExpr(*[f"`{c}`" for c in by], "_bucket", "0 AS _own", *front, *missing))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_own", *order)
    lagged = rows.withColumn("_before", F.lag(carried).over(inside)).where("_own = 1")
    return lagged.selectExpr(*[f"`{c}`" for c in df.columns], *[f"_before.`{c}` AS `{prefix}{c}`" for c in values])


def lag_deltas(
    df: DataFrame,
    measures: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Change of each measure against the previous row; rows without a previous value are dropped."""
    needed = list(dict.fromkeys([*by, *order, *keep, *measures]))
    paired = with_previous(df.select(*needed), measures, order, by)
    changes = [f"{m} - prev_{m} AS {m}_change" for m in measures]
    return paired.where(f"prev_{measures[0]} IS NOT NULL").selectExpr("*", *changes)


def shift_patterns(
    df: DataFrame,
    order: Sequence[str] = ("played_at", "track_id"),
    hour: str = "hour_of_day",
    measures: Sequence[str] = ("valence", "energy"),
    labels: tuple[str, str, str] = words.SHIFT,
) -> DataFrame:
    """Per hour: how often and how far the measures move from one row to the next."""
    doubles = df.selectExpr(hour, *order, *[f"{double(m)} AS {m}" for m in measures])
    deltas = lag_deltas(doubles, measures, order, keep=[hour])
    changes = [f"{m}_change" for m in measures]
    classed = deltas.selectExpr("*", f"{change_class(changes, labels=labels)} AS shift_magnitude")
    patterns = classed.groupBy(hour, "shift_magnitude").agg(
        F.expr("count(*) AS shift_count"), *[F.expr(f"{stable_round(f'avg({c})', 3)} AS avg_{c}") for c in changes]
    )
    return patterns.orderBy(hour, F.desc("shift_count"), "shift_magnitude")


def state_counts(df: DataFrame, labels: Quadrants = words.SEQUENCE_STATE) -> DataFrame:
    """How often each state occurs, with its kind and meaning."""
    kinds = [(f"contains(mood_category, {literal(part)})", text) for part, text in words.SEQUENCE_TYPE.items()]
    stated = df.selectExpr(f"{quadrant('valence', 'energy', labels)} AS mood_category")
    counts = stated.groupBy("mood_category").agg(F.expr("count(*) AS occurrence_count"))
    insight = lookup("mood_category", words.SEQUENCE_INSIGHT, words.SEQUENCE_INSIGHT_DEFAULT)
    return counts.selectExpr(
        "mood_category",
        "occurrence_count",
        f"{first_match(kinds, words.SEQUENCE_TYPE_DEFAULT)} AS pattern_type",
        f"{insight} AS behavioral_insight",
    ).orderBy(F.desc("occurrence_count"), "mood_category")


def state_transitions(
    df: DataFrame,
    by: Sequence[str] = (),
    ts: str = "played_at",
    tie: Sequence[str] = ("track_id",),
    labels: Quadrants = words.SEQUENCE_STATE,
) -> DataFrame:
    """Moves from one state to the next: how often, and the mean hours between the two plays."""
    needed = dict.fromkeys([*by, ts, *tie])
    stated = df.selectExpr(*needed, f"{quadrant('valence', 'energy', labels)} AS state")
    paired = with_previous(stated, ["state", ts], [ts, *tie], by).where("prev_state IS NOT NULL")
    gap = f"timestampdiff(MICROSECOND, prev_{ts}, {ts})"
    moves = paired.groupBy(F.col("prev_state").alias("from_mood"), F.col("state").alias("to_mood")).agg(
        F.expr("count(*) AS transition_count"),
        F.expr(f"{stable_round(f'(avg({gap}) / 3.6E9D)', 3)} AS avg_time_between_hours"),
    )
    ordered = moves.selectExpr("*", "concat(from_mood, ' → ', to_mood) AS pattern")
    return ordered.orderBy(F.desc("transition_count"), "from_mood", "to_mood")
