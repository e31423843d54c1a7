"""Top-N, rule-based selections and recommendations. Every ranking ends in a unique tie-break."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.buckets import Quadrants, first_match, ladder, lookup, quadrant
from ..functions.numeric import double, literal, stable_round
from ..session import materialize

# Rankings compare means at this many digits: finer digits are summation noise, not order.
RANK_DIGITS = 6


def top_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, rank_as: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group by ``order`` (which must be total), ranked from 1.

    For reports: the optimizer cuts every group to n rows inside each task before the shuffle, and a task ranks n rows
    of each of those. For ranks without such a bound see ``global_ranks``.
    """
    ranked_by = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_as, F.row_number().over(ranked_by)).where(F.col(rank_as) <= n)


def global_ranks(
    df: DataFrame, group: str, order: Sequence[Column], n: int | None = None, rank_as: str = "rank"
) -> DataFrame:
    """The rank of every row in its group by ``order`` (which must be total), or of the first ``n`` of each.

    No task holds a group: rows are range-partitioned on (group, order) into even slices, a slice counts its rows of each
    group, and the running sum of the counts is where the ranks of the next slice begin. Slices that begin
    behind rank n are dropped before any row is ranked. The sliced rows are checkpointed, which fixes their slices.
    """
    sliced = materialize(df.repartitionByRange(F.col(group), *order).withColumn("_slice", F.spark_partition_id()))
    counts = sliced.groupBy(F.col(group).alias("_group"), F.col("_slice").alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_group", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_begin"))
    if n is not None:
        begins = begins.where(F.col("_begin") < n)
    placed = sliced.join(begins, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_part")))
    inside = Window.partitionBy(group, "_slice").orderBy(*order)
    ranked = placed.withColumn(rank_as, F.col("_begin") + F.row_number().over(inside))
    if n is not None:
        ranked = ranked.where(F.col(rank_as) <= n)
    return ranked.select(*df.columns, rank_as)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_by_bucket(
    df: DataFrame,
    entity: Sequence[str] = ("track_id", "track_name", "artist_name"),
    measures: Sequence[str] = ("valence", "energy", "danceability", "tempo"),
    n: int = 50,
    labels: Quadrants = words.MOOD,
) -> DataFrame:
    """Most played entities in each bucket of the first two measures."""
    bucket = f"{quadrant(measures[0], measures[1], labels)} AS mood_category"
    keys = [*entity, "mood_category", *measures]
    plays = df.selectExpr(*entity, bucket, *measures).groupBy(*keys).agg(F.count("*").alias("play_count"))
    order = [F.desc("play_count"), *[F.asc(c) for c in [*entity, *measures]]]
    ranked = top_n_per_group(plays, "mood_category", order, n, rank_as="rank_in_category")
    return ranked.orderBy("mood_category", "rank_in_category")


def recommend_top(
    df: DataFrame,
    entity: Sequence[str] = ("track_name", "artist_name"),
    at_least: float = 0.7,
    min_plays: int = 2,
    k: int = 20,
    reason_cut: float = 0.7,
    scenario: str = words.TARGET_SCENARIO,
) -> DataFrame:
    """Entities with high-valence plays, best mean first, with a reason taken from their other means."""
    measures = ("valence", "energy", "danceability")
    played = df.where(f"valence >= {at_least}").groupBy(*entity)
    profile = played.agg(
        *[F.expr(f"avg({double(m)}) AS avg_{m}") for m in measures], F.expr("count(*) AS play_count")
    )
    often = profile.where(f"play_count >= {min_plays}")
    best = top_k(often, [F.expr(stable_round("avg_valence", RANK_DIGITS)).desc(), *[F.asc(e) for e in entity]], k)
    reason = first_match(
        [
            (f"avg_energy >= {reason_cut}", words.REASON_ENERGY),
            (f"avg_danceability >= {reason_cut}", words.REASON_DANCE),
        ],
        words.REASON_DEFAULT,
    )
    return best.selectExpr(
        *entity,
        *[f"{stable_round(f'avg_{m}', 3)} AS avg_{m}" for m in measures],
        "play_count",
        f"{reason} AS recommendation_reason",
        f"{literal(scenario)} AS target_scenario",
    )


def best_hours(
    predictions: DataFrame,
    hour: str = "hour_of_day",
    predicted: str = "predicted_valence",
    energy: str = "energy",
    labels: Quadrants = words.MOOD_STATE,
) -> DataFrame:
    """Hourly mean prediction, its state, and what that state is good for."""
    hourly = predictions.groupBy(hour).agg(
        F.expr(f"avg({double(predicted)}) AS p"), F.expr(f"avg({double(energy)}) AS e")
    )
    state = hourly.selectExpr("*", f"{quadrant('p', 'e', labels)} AS mood_state")
    return state.selectExpr(
        hour,
        "mood_state",
        f"{stable_round('p', 3)} AS predicted_valence",
        f"{stable_round('e', 3)} AS avg_energy",
        f"{lookup('mood_state', words.STATE_ACTIVITY, words.STATE_ACTIVITY_DEFAULT)} AS recommended_activity",
        f"{lookup('mood_state', words.STATE_TIP, words.STATE_TIP_DEFAULT)} AS wellbeing_tip",
    ).orderBy(hour)


def intervention_hours(
    df: DataFrame,
    hour: str = "hour_of_day",
    low_value: float = 0.3,
    cuts: tuple[float, float] = (0.3, 0.4),
) -> DataFrame:
    """Hours whose mean valence is low, with their low plays, priority and suggestion."""
    hourly = df.groupBy(hour).agg(
        F.expr(f"avg({double('valence')}) AS v"),
        F.expr(f"avg({double('energy')}) AS e"),
        F.expr(f"count_if(valence < {low_value}) AS low_mood_count"),
        F.expr("count(*) AS total_plays"),
    )
    priority = ladder("v", list(zip(cuts, words.PRIORITY)), words.PRIORITY[-1])
    flagged = hourly.selectExpr("*", f"{priority} AS intervention_needed").where(
        f"intervention_needed <> {literal(words.PRIORITY[-1])}"
    )
    playlist = ladder("v", [(cuts[1], words.SUPPORT_PLAYLIST)], words.SUPPORT_PLAYLIST_DEFAULT)
    suggestion = lookup("intervention_needed", words.INTERVENTION_TEXT, words.INTERVENTION_TEXT_DEFAULT)
    return flagged.selectExpr(
        hour,
        f"{stable_round('v', 3)} AS avg_valence",
        f"{stable_round('e', 3)} AS avg_energy",
        "low_mood_count",
        "total_plays",
        "intervention_needed",
        f"{suggestion} AS suggested_intervention",
        f"{playlist} AS mood_support_playlist",
    ).orderBy("avg_valence", hour)


@dataclass(frozen=True)
class Rule:
    """A named selection: which rows count, and the measure whose mean ranks the entities."""

    name: str
    purpose: str
    where: str
    measure: str


# The four selections and their criteria.
PLAYLIST_RULES = (
    Rule(
        "Focus & Deep Work",
        "Enhance concentration and productivity",
        "instrumentalness >= 0.5 AND energy BETWEEN 0.4 AND 0.7 AND tempo BETWEEN 90 AND 130",
        "instrumentalness",
    ),
    Rule(
        "Energy Boost",
        "Increase energy and motivation",
        "energy >= 0.7 AND valence >= 0.6 AND tempo >= 120",
        "energy",
    ),
    Rule(
        "Relaxation & Calm",
        "Reduce stress and promote relaxation",
        "acousticness >= 0.6 AND energy < 0.5 AND valence BETWEEN 0.4 AND 0.7",
        "acousticness",
    ),
    Rule(
        "Mood Lift",
        "Improve mood and emotional wellbeing",
        "valence >= 0.7 AND danceability >= 0.6 AND energy >= 0.5",
        "valence",
    ),
)


def rule_playlists(
    df: DataFrame,
    rules: Sequence[Rule] = PLAYLIST_RULES,
    entity: Sequence[str] = ("track_name", "artist_name"),
    n: int = 10,
) -> DataFrame:
    """Top entities of every rule from a single scan.

    Rules are evaluated as conditional aggregates per entity, so rows are neither read once per rule nor
    multiplied by the rules they match; only the small per-entity result is unfolded by rule.
    """
    matched = df.where(" OR ".join(f"({r.where})" for r in rules))
    per_rule = [
        F.expr(text)
        for i, r in enumerate(rules)
        for text in (
            f"count_if({r.where}) AS n{i}",
            f"avg({double(r.measure)}) FILTER (WHERE {r.where}) AS m{i}",
        )
    ]
    rows = [
        f"named_struct('playlist_name', {literal(r.name)}, 'playlist_purpose', {literal(r.purpose)}, "
        f"'play_count', n{i}, '_mean', m{i})"
        for i, r in enumerate(rules)
    ]
    folded = matched.groupBy(*entity).agg(*per_rule)
    unfolded = folded.selectExpr(*entity, f"inline(array({', '.join(rows)}))").where("play_count > 0")
    order = [F.expr(stable_round("_mean", RANK_DIGITS)).desc(), *[F.asc(e) for e in entity]]
    ranked = top_n_per_group(unfolded, "playlist_name", order, n)
    return ranked.select("playlist_name", "playlist_purpose", *entity, "play_count")


def at_least_plays(df: DataFrame, keys: Sequence[str], minimum: int, count_as: str = "play_count") -> DataFrame:
    """Groups with enough rows (HAVING)."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_as)).where(f"{count_as} >= {minimum}")
