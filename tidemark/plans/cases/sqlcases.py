"""The SQL surface over registered views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.numeric import round_columns
from ...operators import anomaly, learn, profiles, ranking, sequence
from ...operators.segment import behavior_segment
from ...session import scratch_path
from ...sources import sinks
from ...sources.tables import read_table
from ..bindings import plays
from ..sqlviews import run_sql
from .gold import _recommend_sql, _segment_sql, _transitions_sql
from .models import LINEAR_FITS, fit, linear_guess
from .registry import CATALOG, ORACLES, PLAYS, over_plays, query, rnd

SILVER = "listening_with_features"


def _run(spark, name: str, tables: dict[str, DataFrame], digits: dict[str, int] | None = None, **args) -> DataFrame:
    result = run_sql(spark, name, tables, **args)
    return round_columns(result, digits or {})


def _silver(spark, sf):
    return {SILVER: plays(spark, sf)}


@query(
    "sql_hourly_avg",
    over_plays(
        f"""SELECT hour_of_day, {rnd('avg(valence * 0.5e0 + danceability * 0.5e0)', 6)} AS avg_mood,
            {rnd('avg(energy)', 6)} AS avg_energy FROM plays GROUP BY 1"""
    ),
)
def sql_hourly_avg(spark, sf):
    predicted = "valence * 0.5D + danceability * 0.5D AS predicted_valence"
    predictions = plays(spark, sf).selectExpr("hour_of_day", "energy", predicted)
    return _run(spark, "hourly_avg", {"mood_predictions": predictions}, {"avg_mood": 6, "avg_energy": 6})


@query(
    "sql_pred_error",
    f"""WITH {PLAYS}, {CATALOG}, {LINEAR_FITS},
        guessed AS (SELECT hour_of_day, energy, {linear_guess()} AS guess FROM plays, fits WHERE f = 3)
        SELECT hour_of_day, {rnd('guess', 6)} AS predicted_energy, {rnd('energy', 6)} AS actual_energy,
               {rnd('abs(guess - energy)', 6)} AS prediction_error
        FROM guessed ORDER BY abs(guess - energy), hour_of_day, energy LIMIT 10""",
)
def sql_pred_error(spark, sf):
    forecasts = fit(spark, sf, learn.ENERGY_LINEAR).predictions
    digits = {"predicted_energy": 6, "actual_energy": 6, "prediction_error": 6}
    return _run(spark, "pred_error", {"energy_forecasts": forecasts}, digits)


@query("sql_metrics")
def sql_metrics(spark, sf):
    long = learn.model_metrics([fit(spark, sf, spec) for spec in learn.MODELS])
    return _run(spark, "metrics", {"model_performance_metrics": learn.wide_metrics(long)})


@query(
    "sql_latest",
    over_plays(
        """SELECT track_name, artist_name, played_at, valence AS happiness, energy, danceability FROM plays
           ORDER BY played_at DESC, track_name LIMIT 20"""
    ),
)
def sql_latest(spark, sf):
    return _run(spark, "latest", _silver(spark, sf))


@query(
    "sql_strong_pairs",
    over_plays(
        " UNION ALL ".join(
            f"SELECT '{a}-{b}' AS feature_pair, {rnd(f'corr({a}, {b})')} AS correlation_value FROM plays "
            f"HAVING abs({rnd(f'corr({a}, {b})')}) > 0.3e0"
            for i, a in enumerate(profiles.CORRELATION_MEASURES)
            for b in profiles.CORRELATION_MEASURES[i + 1 :]
        )
    ),
)
def sql_strong_pairs(spark, sf):
    pairs = profiles.pairwise_corr(plays(spark, sf))
    return _run(spark, "strong_pairs", {"feature_correlations": pairs}, cut=0.3)


@query(
    "sql_reco",
    over_plays(
        f"""SELECT DISTINCT track_name, artist_name, avg_valence AS happiness_score, recommendation_reason
            FROM ({_recommend_sql('plays')}) WHERE target_scenario = 'When feeling down or low energy'
            ORDER BY happiness_score DESC, track_name, artist_name LIMIT 10"""
    ),
)
def sql_reco(spark, sf):
    reco = ranking.recommend_top(plays(spark, sf))
    return _run(
        spark, "reco", {"mood_improvement_recommendations": reco}, scenario="When feeling down or low energy"
    )


@query(
    "sql_summary",
    over_plays(
        f"""SELECT count(DISTINCT track_id) AS unique_tracks, count(*) AS total_plays,
            {rnd('avg(valence)', 6)} AS avg_happiness, {rnd('avg(energy)', 6)} AS avg_energy,
            {rnd('avg(danceability)', 6)} AS avg_danceability FROM plays"""
    ),
)
def sql_summary(spark, sf):
    return _run(spark, "summary", _silver(spark, sf), {"avg_happiness": 6, "avg_energy": 6, "avg_danceability": 6})


@query(
    "sql_top_groups",
    over_plays(
        f"""SELECT artist_name, count(*) AS play_count, {rnd('avg(valence)', 6)} AS avg_mood FROM plays
            GROUP BY 1 ORDER BY play_count DESC, artist_name LIMIT 10"""
    ),
)
def sql_top_groups(spark, sf):
    return _run(spark, "top_groups", _silver(spark, sf), {"avg_mood": 6})


@query(
    "sql_extract_hour",
    over_plays(
        f"""SELECT CAST(extract(HOUR FROM played_at) AS INT) AS hour, {rnd('avg(valence)', 6)} AS avg_mood,
            {rnd('avg(energy)', 6)} AS avg_energy, count(*) AS plays FROM plays GROUP BY 1"""
    ),
)
def sql_extract_hour(spark, sf):
    return _run(spark, "extract_hour", _silver(spark, sf), {"avg_mood": 6, "avg_energy": 6})


@query(
    "sql_group_distinct",
    over_plays(
        """SELECT track_name, artist_name, energy, danceability FROM plays WHERE energy > 0.7 AND danceability > 0.7
           GROUP BY 1, 2, 3, 4 ORDER BY energy DESC, danceability DESC, track_name, artist_name LIMIT 20"""
    ),
)
def sql_group_distinct(spark, sf):
    return _run(spark, "group_distinct", _silver(spark, sf))


@query(
    "sql_low_value",
    over_plays(
        """SELECT track_name, artist_name, valence AS sadness_score, count(*) AS play_count FROM plays
           WHERE valence < 0.3e0 GROUP BY 1, 2, 3 ORDER BY play_count DESC, track_name, artist_name, valence LIMIT 10"""
    ),
)
def sql_low_value(spark, sf):
    return _run(spark, "low_value", _silver(spark, sf))


@query(
    "sql_trailing_7d",
    over_plays(
        """SELECT track_name, artist_name, count(*) AS plays FROM plays
           WHERE played_at > DATE '2024-01-31' - INTERVAL 7 DAY GROUP BY 1, 2
           ORDER BY plays DESC, track_name, artist_name LIMIT 20"""
    ),
)
def sql_trailing_7d(spark, sf):
    """On a stored table, so that the filter on ``date`` reads a week of partitions only."""
    path = scratch_path(spark, "silver")
    sinks.write_table(plays(spark, sf).withColumn("date", F.to_date("played_at")), path, partition_by=["date"])
    return _run(spark, "trailing_7d", {"listening_with_features": read_table(spark, path)}, as_of="2024-01-31")


@query(
    "sql_chill",
    over_plays(
        """SELECT DISTINCT track_name, artist_name, energy, valence FROM plays
           WHERE energy < 0.4 AND valence > 0.5 AND acousticness > 0.5
           ORDER BY valence DESC, energy, track_name, artist_name LIMIT 30"""
    ),
)
def sql_chill(spark, sf):
    return _run(spark, "chill", _silver(spark, sf))


@query(
    "sql_point_filter",
    over_plays(
        f"""SELECT hour_of_day, day_of_week, day_name, part_of_day, is_weekend, count(*) AS play_count,
            {', '.join(f"{rnd(f'avg({m})', 1 if m == 'tempo' else 3)} AS avg_{m}"
              for m in ('valence', 'energy', 'danceability', 'acousticness', 'tempo'))}
            FROM plays WHERE hour_of_day = 14 GROUP BY 1, 2, 3, 4, 5"""
    ),
)
def sql_point_filter(spark, sf):
    patterns = profiles.patterns_by_time(plays(spark, sf))
    return _run(spark, "point_filter", {"listening_patterns_by_time": patterns}, hour=14)


@query("sql_row_count", over_plays("SELECT count(*) AS row_count FROM plays"))
def sql_row_count(spark, sf):
    return _run(spark, "row_count", _silver(spark, sf))


@query(
    "sql_feature_scatter",
    over_plays("SELECT valence, energy, danceability, tempo FROM plays ORDER BY played_at, track_id LIMIT 1000"),
)
def sql_feature_scatter(spark, sf):
    return _run(spark, "feature_scatter", _silver(spark, sf))


@query(
    "sql_energetic_hours",
    over_plays(
        f"SELECT hour_of_day, {rnd('avg(energy)', 6)} AS avg_energy, count(*) AS play_count FROM plays GROUP BY 1"
    ),
)
def sql_energetic_hours(spark, sf):
    return _run(spark, "energetic_hours", _silver(spark, sf), {"avg_energy": 6})


@query(
    "sql_anomalies",
    over_plays(
        f""", hourly AS (SELECT hour_of_day, avg(raw_energy) AS m, stddev_samp(raw_energy) AS s FROM plays GROUP BY 1)
            SELECT track_id, played_at, hour_of_day, {rnd('abs(raw_energy - m) / nullif(s, 0)', 6)} AS anomaly_score
            FROM plays JOIN hourly USING (hour_of_day)
            ORDER BY abs(raw_energy - m) / nullif(s, 0) DESC NULLS LAST, played_at, track_id LIMIT 10"""
    ),
)
def sql_anomalies(spark, sf):
    events = anomaly.anomaly_events(plays(spark, sf), measures=["raw_energy"])
    return _run(spark, "anomalies", {"listening_anomaly_events": events}, {"anomaly_score": 6})


@query(
    "sql_scatter",
    over_plays(
        f"""SELECT danceability AS x, {rnd('avg(energy)', 6)} AS avg_y, count(*) AS n FROM plays GROUP BY 1
            ORDER BY n DESC, x LIMIT 1000"""
    ),
)
def sql_scatter(spark, sf):
    return _run(spark, "scatter", _silver(spark, sf), {"avg_y": 6})


@query(
    "sql_plays_by_hour",
    over_plays("SELECT hour_of_day, CAST(count(*) AS BIGINT) AS plays FROM plays GROUP BY 1"),
)
def sql_plays_by_hour(spark, sf):
    return _run(spark, "plays_by_hour", {"listening_patterns_by_time": profiles.patterns_by_time(plays(spark, sf))})


@query(
    "sql_segments",
    over_plays(
        f"""SELECT listening_archetype AS segment_name, archetype_description AS interpretation,
            wellbeing_recommendation AS recommendation, overall_valence AS avg_valence, overall_energy AS avg_energy,
            overall_danceability AS avg_danceability FROM ({_segment_sql('plays', '')})"""
    ),
)
def sql_segments(spark, sf):
    return _run(spark, "segments", {"behavioral_segments": behavior_segment(plays(spark, sf))})


@query(
    "sql_busiest_hours",
    over_plays(
        f"""SELECT hour_of_day, day_of_week, count(*) AS play_count, {rnd('avg(valence)')} AS avg_valence
            FROM plays GROUP BY 1, 2"""
    ),
)
def sql_busiest_hours(spark, sf):
    return _run(spark, "busiest_hours", {"listening_patterns_by_time": profiles.patterns_by_time(plays(spark, sf))})


@query(
    "sql_transitions",
    over_plays(f"SELECT from_mood, to_mood, transition_count, avg_time_between_hours FROM ({_transitions_sql('')})"),
)
def sql_transitions(spark, sf):
    moves = sequence.state_transitions(plays(spark, sf), tie=("event_id",))
    return _run(spark, "transitions", {"state_transitions": moves})


@query(
    "sql_weekend_bars",
    over_plays(
        f"""SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period, {rnd('avg(valence)')} AS avg_valence,
            {rnd('avg(energy)')} AS avg_energy, {rnd('avg(danceability)')} AS avg_danceability FROM plays GROUP BY 1"""
    ),
)
def sql_weekend_bars(spark, sf):
    return _run(spark, "weekend_bars", {"weekend_vs_weekday": profiles.period_compare(plays(spark, sf))})


@query(
    "sql_heatmap",
    over_plays(
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {rnd(f'corr({a}, {b})')} AS correlation FROM plays"
            for i, a in enumerate(profiles.CORRELATION_MEASURES)
            for b in profiles.CORRELATION_MEASURES[i + 1 :]
        )
    ),
)
def sql_heatmap(spark, sf):
    return _run(spark, "heatmap", {"feature_correlations": profiles.pairwise_corr(plays(spark, sf))})


@query("sql_distributions", ORACLES["feature_profile"])
def sql_distributions(spark, sf):
    return _run(spark, "distributions", {"audio_feature_distributions": profiles.feature_profile(plays(spark, sf))})
