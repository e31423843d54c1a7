"""Gold tables and the aggregates, windows and sorts they are made of."""

from __future__ import annotations

from functools import partial
from itertools import combinations

from pyspark.sql import functions as F

from ...functions import vocabulary as words
from ...functions.buckets import position
from ...functions.numeric import stable_round
from ...operators import anomaly, profiles, ranking, rollup, segment, sequence
from ...operators.profiles import CORRELATION_MEASURES, DISTRIBUTION_MEASURES
from ...session import scratch_path
from ...sources import sinks
from ...sources.tables import read_table
from ..bindings import enriched, plays, table
from .registry import ORACLES, mapped, over_enriched, over_plays, pct, quad, query, rnd, steps, text


def _means(*measures: str, one_digit: tuple[str, ...] = ("tempo",)) -> str:
    parts = [f"{rnd(f'avg({m})', 1 if m in one_digit else 3)} AS avg_{m}" for m in measures]
    return ", ".join(parts)


def _spread(measure: str, name: str) -> str:
    return f"{rnd(f'stddev_samp({measure})')} AS {name}"


# --- descriptive ---------------------------------------------------------------------------------


@query(
    "patterns_by_time",
    over_plays(
        f"""SELECT hour_of_day, day_of_week, day_name, part_of_day, is_weekend, count(*) AS play_count,
            {_means('valence', 'energy', 'danceability', 'acousticness', 'tempo')}
            FROM plays GROUP BY 1, 2, 3, 4, 5"""
    ),
)
def patterns_by_time(spark, sf):
    return profiles.patterns_by_time(plays(spark, sf))


def _top_by_bucket_sql(source: str) -> str:
    keys = "track_id, track_name, artist_name, mood_category, valence, energy, danceability, tempo"
    tie = "track_id, track_name, artist_name, valence, energy, danceability, tempo"
    return f"""SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY mood_category ORDER BY play_count DESC, {tie}) AS rank_in_category
        FROM (SELECT {keys}, count(*) AS play_count
              FROM (SELECT *, {quad('valence', 'energy', words.MOOD)} AS mood_category FROM {source}) GROUP BY {keys}))
        WHERE rank_in_category <= 50"""


@query("top_by_bucket", over_enriched(_top_by_bucket_sql("enriched")))
def top_by_bucket(spark, sf):
    return ranking.top_by_bucket(enriched(spark, sf))


@query(
    "top_n_per_group",
    over_plays(
        """SELECT label, track_id, n, rank FROM (
           SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, track_id) AS rank
           FROM (SELECT label, track_id, count(*) AS n FROM plays GROUP BY 1, 2)) WHERE rank <= 3"""
    ),
)
def top_n_per_group(spark, sf):
    counts = profiles.category_counts(plays(spark, sf), "label", "track_id", count_as="n")
    return ranking.top_n_per_group(counts, "label", [F.desc("n"), F.asc("track_id")], 3)


@query(
    "top_n_salted",
    over_plays(
        """SELECT label, event_id, raw_energy, rank FROM (
           SELECT *, row_number() OVER (PARTITION BY label ORDER BY raw_energy DESC, event_id) AS rank FROM plays)
           WHERE rank <= 1500"""
    ),
)
def top_n_salted(spark, sf):
    """Many rows of a few hot groups (the name is from an earlier way to spread them)."""
    rows = plays(spark, sf).select("label", "event_id", "raw_energy")
    return ranking.global_ranks(rows, "label", [F.desc("raw_energy"), F.asc("event_id")], 1500)


@query(
    "global_ranks",
    over_plays("SELECT label, event_id, row_number() OVER (PARTITION BY label ORDER BY energy, event_id) AS rank FROM plays"),
)
def global_ranks(spark, sf):
    """The rank of every event."""
    return ranking.global_ranks(plays(spark, sf).select("label", "event_id", "energy"), "label", [F.asc("energy"), F.asc("event_id")]).drop("energy")


def _profile_sql(measure: str) -> str:
    def value(f: str) -> str:
        return f"coalesce({rnd(f'{f}({measure})')}, 0e0)"

    return (
        f"SELECT '{measure}' AS feature_name, {value('avg')} AS mean, {value('stddev_samp')} AS std_dev, "
        f"{value('min')} AS min, {value('max')} AS max FROM plays"
    )


@query("feature_profile", over_plays(" UNION ALL ".join(_profile_sql(m) for m in DISTRIBUTION_MEASURES)))
def feature_profile(spark, sf):
    return profiles.feature_profile(plays(spark, sf))


@query(
    "daily_trends",
    over_plays(
        f"""SELECT CAST(played_at AS DATE) AS date, count(*) AS total_plays, {_means('valence', 'energy', 'tempo')},
            count(*) FILTER (WHERE is_weekend) AS weekend_plays FROM plays GROUP BY 1"""
    ),
)
def daily_trends(spark, sf):
    return profiles.daily_trends(plays(spark, sf))


@query(
    "share_of_total",
    over_enriched(
        f"""SELECT feature_source, count(*) AS record_count,
            {pct('count(*)', '(SELECT count(*) FROM enriched)')} AS percentage FROM enriched GROUP BY 1"""
    ),
)
def share_of_total(spark, sf):
    return profiles.share_of_total(enriched(spark, sf), "feature_source")


# --- diagnostic ----------------------------------------------------------------------------------


@query(
    "hourly_profile",
    over_plays(
        f"""SELECT hour_of_day, {_means('valence', 'energy', 'danceability', 'acousticness')},
            count(*) AS sample_size, {_spread('valence', 'valence_stddev')}, {_spread('energy', 'energy_stddev')}
            FROM plays GROUP BY 1"""
    ),
)
def hourly_profile(spark, sf):
    return profiles.hourly_profile(plays(spark, sf))


def _pair_sql(a: str, b: str) -> str:
    r = f"coalesce(CASE WHEN isfinite(corr({a}, {b})) THEN corr({a}, {b}) END, 0e0)"
    return (
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {rnd(r)} AS correlation, "
        f"{steps(f'abs({r})', [(0.7, 'Strong'), (0.4, 'Moderate')], 'Weak', '>')} AS strength FROM plays"
    )


@query("pairwise_corr", over_plays(" UNION ALL ".join(_pair_sql(a, b) for a, b in combinations(CORRELATION_MEASURES, 2))))
def pairwise_corr(spark, sf):
    return profiles.pairwise_corr(plays(spark, sf))


@query(
    "period_compare",
    over_plays(
        f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period, count(*) AS total_plays,
            {_means('valence', 'energy', 'danceability', 'tempo', 'acousticness')},
            {_spread('valence', 'valence_variance')}, {_spread('energy', 'energy_variance')} FROM plays GROUP BY 1"""
    ),
)
def period_compare(spark, sf):
    return profiles.period_compare(plays(spark, sf))


_PART_PROFILE = f"""SELECT part_of_day, count(*) AS total_plays,
    {_means('valence', 'energy', 'danceability', 'acousticness', 'instrumentalness', 'tempo')},
    {_spread('valence', 'valence_consistency')}, {_spread('energy', 'energy_consistency')} FROM plays GROUP BY 1"""


@query("part_of_day_profile", over_plays(_PART_PROFILE))
def part_of_day_profile(spark, sf):
    return profiles.part_of_day_profile(plays(spark, sf))


# --- the same five from a rollup by date and hour --------------------------------------------------


def _rolled(spark, sf, table):
    return table(rollup.roll_up(rollup.with_date(plays(spark, sf))), profile=rollup.rolled_profile)


@query("rolled_patterns", ORACLES["patterns_by_time"])
def rolled_patterns(spark, sf):
    return _rolled(spark, sf, profiles.patterns_by_time)


@query("rolled_trends", ORACLES["daily_trends"])
def rolled_trends(spark, sf):
    return _rolled(spark, sf, partial(profiles.daily_trends, ts=None))


@query("rolled_hours", ORACLES["hourly_profile"])
def rolled_hours(spark, sf):
    return _rolled(spark, sf, profiles.hourly_profile)


@query("rolled_periods", ORACLES["period_compare"])
def rolled_periods(spark, sf):
    return _rolled(spark, sf, profiles.period_compare)


@query("rolled_parts", ORACLES["part_of_day_profile"])
def rolled_parts(spark, sf):
    return _rolled(spark, sf, profiles.part_of_day_profile)


@query("rollup_refresh", ORACLES["daily_trends"])
def rollup_refresh(spark, sf):
    """A stored rollup in which one date is out of date and one should not be there; both are refreshed."""
    path = scratch_path(spark, "rollup")
    dated = rollup.with_date(plays(spark, sf))
    wrong = F.when(F.col("date") == F.lit("2024-01-20").cast("date"), 0.0).otherwise(F.col("valence"))
    extra = dated.where("date = date'2024-01-05'").withColumn("date", F.lit("2031-05-05").cast("date"))
    sinks.write_table(rollup.roll_up(dated.withColumn("valence", wrong).unionByName(extra)), path, partition_by=["date"])
    dates = spark.sql("SELECT explode(array(date'2024-01-20', date'2031-05-05')) AS date")
    sinks.write_table(rollup.refreshed(dated, dates), path, partition_by=["date"])
    return profiles.daily_trends(read_table(spark, path), ts=None, profile=rollup.rolled_profile)


@query(
    "custom_sort",
    over_plays(
        """SELECT part_of_day, n, CAST(CASE part_of_day WHEN 'morning' THEN 1 WHEN 'afternoon' THEN 2
           WHEN 'evening' THEN 3 ELSE 4 END AS INT) AS place
           FROM (SELECT part_of_day, count(*) AS n FROM plays GROUP BY 1) ORDER BY place"""
    ),
)
def custom_sort(spark, sf):
    counts = profiles.category_counts(plays(spark, sf), "part_of_day", count_as="n")
    place = position("part_of_day", ("morning", "afternoon", "evening"))
    return counts.selectExpr("*", f"{place} AS place").orderBy("place")


_LAGGED = """SELECT event_id, valence - lag(valence) OVER o AS valence_change, energy - lag(energy) OVER o AS energy_change,
    hour_of_day FROM plays WINDOW o AS (ORDER BY played_at, event_id)"""


@query(
    "lag_delta",
    over_plays(
        f"""SELECT event_id, {rnd('valence_change', 6)} AS valence_change, {rnd('energy_change', 6)} AS energy_change
            FROM ({_LAGGED}) WHERE valence_change IS NOT NULL"""
    ),
)
def lag_delta(spark, sf):
    rows = plays(spark, sf).select("event_id", "played_at", "valence", "energy")
    deltas = sequence.lag_deltas(rows, ["valence", "energy"], ["played_at", "event_id"])
    changes = [f"{stable_round(f'{m}_change', 6)} AS {m}_change" for m in ("valence", "energy")]
    return deltas.selectExpr("event_id", *changes)


@query(
    "shift_patterns",
    over_plays(
        f"""SELECT hour_of_day, shift_magnitude, count(*) AS shift_count,
            {rnd('avg(valence_change)')} AS avg_valence_change, {rnd('avg(energy_change)')} AS avg_energy_change
            FROM (SELECT *, CASE WHEN abs(valence_change) <= 0.2e0 AND abs(energy_change) <= 0.2e0 THEN 'Stable'
                  WHEN abs(valence_change) > 0.5e0 OR abs(energy_change) > 0.5e0 THEN 'Major_Shift'
                  ELSE 'Minor_Shift' END AS shift_magnitude FROM ({_LAGGED}) WHERE valence_change IS NOT NULL)
            GROUP BY 1, 2"""
    ),
)
def shift_patterns(spark, sf):
    return sequence.shift_patterns(plays(spark, sf), order=("played_at", "event_id"))


# --- prescriptive --------------------------------------------------------------------------------


def _recommend_sql(source: str) -> str:
    inner = f"""SELECT track_name, artist_name, avg(valence) AS v, avg(energy) AS e, avg(danceability) AS d,
        count(*) AS play_count FROM {source} WHERE valence >= 0.7e0 GROUP BY 1, 2 HAVING count(*) >= 2
        ORDER BY {rnd('avg(valence)', 6)} DESC, track_name, artist_name LIMIT 20"""
    return f"""SELECT track_name, artist_name, {rnd('v')} AS avg_valence, {rnd('e')} AS avg_energy,
        {rnd('d')} AS avg_danceability, play_count,
        CASE WHEN e >= 0.7e0 THEN {text(words.REASON_ENERGY)} WHEN d >= 0.7e0 THEN {text(words.REASON_DANCE)}
             ELSE {text(words.REASON_DEFAULT)} END AS recommendation_reason,
        {text(words.TARGET_SCENARIO)} AS target_scenario FROM ({inner})"""


@query("recommend_top", over_plays(_recommend_sql("plays")))
def recommend_top(spark, sf):
    return ranking.recommend_top(plays(spark, sf))


@query(
    "best_hours",
    over_plays(
        f"""SELECT hour_of_day, mood_state, {rnd('p')} AS predicted_valence, {rnd('e')} AS avg_energy,
            {mapped('mood_state', words.STATE_ACTIVITY, words.STATE_ACTIVITY_DEFAULT)} AS recommended_activity,
            {mapped('mood_state', words.STATE_TIP, words.STATE_TIP_DEFAULT)} AS wellbeing_tip
            FROM (SELECT *, {quad('p', 'e', words.MOOD_STATE)} AS mood_state FROM (
              SELECT hour_of_day, avg(valence * 0.5e0 + danceability * 0.5e0) AS p, avg(energy) AS e
              FROM plays GROUP BY 1))"""
    ),
)
def best_hours(spark, sf):
    predicted = "valence * 0.5D + danceability * 0.5D AS predicted_valence"
    return ranking.best_hours(plays(spark, sf).selectExpr("hour_of_day", "energy", predicted))


_RULE_SQL = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT {text(r.name)} AS playlist_name, {text(r.purpose)} AS playlist_purpose, track_name,
        artist_name, count(*) AS play_count FROM plays WHERE {r.where} GROUP BY 3, 4
        ORDER BY {rnd(f'avg({r.measure})', 6)} DESC, track_name, artist_name LIMIT 10)"""
    for r in ranking.PLAYLIST_RULES
)


@query("rule_playlists", over_plays(_RULE_SQL))
def rule_playlists(spark, sf):
    return ranking.rule_playlists(plays(spark, sf))


@query(
    "intervention_hours",
    over_plays(
        f"""SELECT hour_of_day, {rnd('v')} AS avg_valence, {rnd('e')} AS avg_energy, low_mood_count, total_plays,
            intervention_needed,
            {mapped('intervention_needed', words.INTERVENTION_TEXT, words.INTERVENTION_TEXT_DEFAULT)}
              AS suggested_intervention,
            CASE WHEN v < 0.5e0 THEN {text(words.SUPPORT_PLAYLIST)} ELSE {text(words.SUPPORT_PLAYLIST_DEFAULT)} END
              AS mood_support_playlist
            FROM (SELECT *, {steps('v', [(0.48, 'High Priority'), (0.5, 'Medium Priority')], 'Low Priority')}
                  AS intervention_needed FROM (
              SELECT hour_of_day, avg(valence) AS v, avg(energy) AS e,
                     count(*) FILTER (WHERE valence < 0.3e0) AS low_mood_count, count(*) AS total_plays
              FROM plays GROUP BY 1)) WHERE intervention_needed <> 'Low Priority'"""
    ),
)
def intervention_hours(spark, sf):
    # The hourly means of the test data lie near 0.5, so the cuts are set there.
    return ranking.intervention_hours(plays(spark, sf), cuts=(0.48, 0.5))


@query("top_k", over_plays("SELECT event_id, raw_energy FROM plays ORDER BY raw_energy DESC, event_id LIMIT 20"))
def top_k(spark, sf):
    rows = plays(spark, sf).select("event_id", "raw_energy")
    return ranking.top_k(rows, [F.desc("raw_energy"), F.asc("event_id")], 20)


@query(
    "having_filter",
    over_plays("SELECT track_id, count(*) AS play_count FROM plays GROUP BY 1 HAVING count(*) >= 60"),
)
def having_filter(spark, sf):
    return ranking.at_least_plays(plays(spark, sf), ["track_id"], 60)


# --- cognitive -----------------------------------------------------------------------------------

_BASELINE = """hourly AS (
  SELECT hour_of_day, avg(valence) AS typical_valence, stddev_samp(valence) AS valence_std,
         avg(raw_energy) AS typical_raw_energy, stddev_samp(raw_energy) AS raw_energy_std, count(*) AS typical_count
  FROM plays GROUP BY 1),
scored AS (
  SELECT p.*, typical_valence, typical_raw_energy, typical_count,
         abs(valence - typical_valence) / nullif(valence_std, 0) AS valence_deviation,
         abs(raw_energy - typical_raw_energy) / nullif(raw_energy_std, 0) AS raw_energy_deviation
  FROM plays p JOIN hourly USING (hour_of_day))"""
_MEASURES = ("valence", "raw_energy")


@query(
    "baseline_join",
    over_plays(
        f""", {_BASELINE} SELECT event_id, hour_of_day, {rnd('typical_valence', 6)} AS typical_valence,
            {rnd('typical_raw_energy', 6)} AS typical_raw_energy, typical_count FROM scored"""
    ),
)
def baseline_join(spark, sf):
    joined = anomaly.with_baseline(plays(spark, sf), ["hour_of_day"], _MEASURES)
    typical = [f"{stable_round(f'typical_{m}', 6)} AS typical_{m}" for m in _MEASURES]
    return joined.selectExpr("event_id", "hour_of_day", *typical, "typical_count")


@query(
    "zscore_anomaly_events",
    over_plays(
        f""", {_BASELINE} SELECT event_id, hour_of_day, {rnd('valence_deviation', 6)} AS valence_deviation,
            {rnd('raw_energy_deviation', 6)} AS raw_energy_deviation,
            {rnd('greatest(valence_deviation, raw_energy_deviation)', 6)} AS anomaly_score
            FROM scored WHERE valence_deviation > 2 OR raw_energy_deviation > 2"""
    ),
)
def zscore_anomaly_events(spark, sf):
    found = anomaly.anomaly_events(plays(spark, sf), measures=_MEASURES)
    z = ("valence_deviation", "raw_energy_deviation", "anomaly_score")
    return found.selectExpr("event_id", "hour_of_day", *[f"{stable_round(c, 6)} AS {c}" for c in z])


@query(
    "zscore_by_entity",
    over_plays(
        f""", per_track AS (SELECT track_id, avg(raw_energy) AS m, stddev_samp(raw_energy) AS s FROM plays GROUP BY 1),
            z AS (SELECT event_id, track_id, abs(raw_energy - m) / nullif(s, 0) AS d FROM plays JOIN per_track USING (track_id))
            SELECT event_id, track_id, {rnd('d', 6)} AS anomaly_score FROM z WHERE d > 2.5e0"""
    ),
)
def zscore_by_entity(spark, sf):
    found = anomaly.anomaly_events(plays(spark, sf), by=["track_id"], measures=["raw_energy"], limit=2.5)
    return found.selectExpr("event_id", "track_id", f"{stable_round('anomaly_score', 6)} AS anomaly_score")


@query(
    "zscore_anomalies",
    over_plays(
        f""", {_BASELINE}, summary AS (
              SELECT hour_of_day, count(*) AS anomaly_count, avg(valence_deviation) AS v, avg(raw_energy_deviation) AS e
              FROM scored WHERE valence_deviation > 2 OR raw_energy_deviation > 2 GROUP BY 1),
            labelled AS (SELECT *, CASE WHEN v > 3 OR e > 3 THEN 'High' WHEN v > 2.5e0 OR e > 2.5e0 THEN 'Medium'
              ELSE 'Low' END AS anomaly_severity FROM summary)
            SELECT hour_of_day, anomaly_count, {rnd('v')} AS avg_valence_deviation, {rnd('e')} AS avg_energy_deviation,
              anomaly_severity,
              {mapped('anomaly_severity', words.SEVERITY_TEXT, words.SEVERITY_TEXT_DEFAULT)} AS interpretation
            FROM labelled"""
    ),
)
def zscore_anomalies(spark, sf):
    return anomaly.anomaly_summary(plays(spark, sf), measures=_MEASURES, names={"raw_energy": "energy"})


@query(
    "state_counts",
    over_plays(
        f"""SELECT mood_category, count(*) AS occurrence_count,
            CASE WHEN mood_category LIKE '%Positive%' THEN 'Positive Mood Sequence'
                 WHEN mood_category LIKE '%Negative%' THEN 'Negative Mood Sequence' ELSE 'Neutral Sequence' END
              AS pattern_type,
            {mapped('mood_category', words.SEQUENCE_INSIGHT, words.SEQUENCE_INSIGHT_DEFAULT)} AS behavioral_insight
            FROM (SELECT {quad('valence', 'energy', words.SEQUENCE_STATE)} AS mood_category FROM plays) GROUP BY 1"""
    ),
)
def state_counts(spark, sf):
    return sequence.state_counts(plays(spark, sf))


def _transitions_sql(partition: str) -> str:
    return f"""SELECT from_mood, to_mood, count(*) AS transition_count,
        {rnd('avg(gap) / 36e8')} AS avg_time_between_hours, from_mood || ' → ' || to_mood AS pattern
        FROM (SELECT lag(state) OVER o AS from_mood, state AS to_mood,
                     epoch_us(played_at) - epoch_us(lag(played_at) OVER o) AS gap
              FROM (SELECT *, {quad('valence', 'energy', words.SEQUENCE_STATE)} AS state FROM plays)
              WINDOW o AS ({partition} ORDER BY played_at, event_id))
        WHERE from_mood IS NOT NULL GROUP BY 1, 2"""


@query("state_transitions", over_plays(_transitions_sql("")))
def state_transitions(spark, sf):
    return sequence.state_transitions(plays(spark, sf), tie=("event_id",))


@query("state_transitions_by_track", over_plays(_transitions_sql("PARTITION BY track_id")))
def state_transitions_by_track(spark, sf):
    return sequence.state_transitions(plays(spark, sf), by=("track_id",), tie=("event_id",))


def _segment_sql(source: str, by: str) -> str:
    means = ", ".join(f"avg({m}) AS overall_{m}" for m in ("valence", "energy", "danceability", "acousticness"))
    rounded = ", ".join(
        f"{rnd(c)} AS {c}"
        for c in (
            "overall_valence", "overall_energy", "overall_danceability", "overall_acousticness", "mood_variability",
            "energy_variability",
        )
    )
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}{rounded}, total_listens, listening_archetype,
        {mapped('listening_archetype', words.ARCHETYPE_TEXT, words.ARCHETYPE_TEXT_DEFAULT)} AS archetype_description,
        CASE WHEN mood_variability > 0.3e0 THEN {text(words.WELLBEING_VARIABLE)}
             WHEN overall_valence < 0.4e0 THEN {text(words.WELLBEING_LOW)}
             ELSE {text(words.WELLBEING_DEFAULT)} END AS wellbeing_recommendation
        FROM (SELECT *, {quad('overall_valence', 'overall_energy', words.ARCHETYPE)} AS listening_archetype FROM (
          SELECT {lead}{means}, stddev_samp(valence) AS mood_variability, stddev_samp(energy) AS energy_variability,
                 count(*) AS total_listens FROM {source} {f'GROUP BY {by}' if by else ''}))"""


@query("behavior_segment", over_plays(_segment_sql("plays", "")))
def behavior_segment(spark, sf):
    return segment.behavior_segment(plays(spark, sf))


@query("behavior_segment_by_user", over_plays(_segment_sql("plays", "user_id")))
def behavior_segment_by_user(spark, sf):
    return segment.behavior_segment(plays(spark, sf), by=["user_id"])


# --- building blocks -----------------------------------------------------------------------------


@query("distinct_count", "SELECT count(*) AS distinct_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def distinct_count(spark, sf):
    return profiles.distinct_count(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("category_counts", "SELECT o_orderpriority, count(*) AS record_count FROM orders GROUP BY 1")
def category_counts(spark, sf):
    return profiles.category_counts(table(spark, sf, "orders"), "o_orderpriority")


def _null_sql(columns: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS null_count, count(*) AS n FROM enriched" for c in columns
    )
    return f"""SELECT column_name, null_count, {pct('null_count', 'n')} AS null_percentage FROM ({rows})
        WHERE null_count > 0 ORDER BY null_count DESC, column_name LIMIT 5"""


_NULLABLE = [
    "danceability", "energy", "valence", "acousticness", "instrumentalness", "speechiness", "liveness", "loudness",
    "tempo", "time_signature", "key", "mode",
]


@query("null_profile", over_enriched(_null_sql(_NULLABLE)))
def null_profile(spark, sf):
    return profiles.null_profile(enriched(spark, sf).select(*_NULLABLE), top=5)
