"""The ad-hoc SQL surface: query texts over the registered tables. Ties are broken, so results repeat."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

QUERIES = {
    "hourly_avg": """
        SELECT hour_of_day, avg(predicted_valence) AS avg_mood, avg(energy) AS avg_energy
        FROM mood_predictions GROUP BY hour_of_day ORDER BY hour_of_day""",
    "pred_error": """
        SELECT hour_of_day, predicted_energy, energy AS actual_energy,
               abs(predicted_energy - energy) AS prediction_error
        FROM energy_forecasts ORDER BY prediction_error, hour_of_day, actual_energy LIMIT 10""",
    "metrics": """
        SELECT model_name, model_type, test_r2, test_rmse, test_accuracy, test_f1, train_size, test_size
        FROM model_performance_metrics""",
    "latest": """
        SELECT track_name, artist_name, played_at, valence AS happiness, energy, danceability
        FROM listening_with_features ORDER BY played_at DESC, track_name LIMIT 20""",
    "distributions": "SELECT * FROM audio_feature_distributions",
    "busiest_hours": """
        SELECT hour_of_day, day_of_week, play_count, avg_valence
        FROM listening_patterns_by_time ORDER BY play_count DESC, hour_of_day, day_of_week""",
    "strong_pairs": """
        SELECT concat(feature_1, '-', feature_2) AS feature_pair, correlation AS correlation_value
        FROM feature_correlations WHERE abs(correlation) > :cut
        ORDER BY abs(correlation) DESC, feature_pair""",
    "transitions": """
        SELECT from_mood, to_mood, transition_count, avg_time_between_hours
        FROM state_transitions ORDER BY transition_count DESC, from_mood, to_mood""",
    "reco": """
        SELECT DISTINCT track_name, artist_name, avg_valence AS happiness_score, recommendation_reason
        FROM mood_improvement_recommendations WHERE target_scenario = :scenario
        ORDER BY happiness_score DESC, track_name, artist_name LIMIT 10""",
    "segments": """
        SELECT listening_archetype AS segment_name, archetype_description AS interpretation,
               wellbeing_recommendation AS recommendation, overall_valence AS avg_valence,
               overall_energy AS avg_energy, overall_danceability AS avg_danceability
        FROM behavioral_segments""",
    "summary": """
        SELECT count(DISTINCT track_id) AS unique_tracks, count(*) AS total_plays, avg(valence) AS avg_happiness,
               avg(energy) AS avg_energy, avg(danceability) AS avg_danceability
        FROM listening_with_features""",
    "top_groups": """
        SELECT artist_name, count(*) AS play_count, avg(valence) AS avg_mood
        FROM listening_with_features GROUP BY artist_name ORDER BY play_count DESC, artist_name LIMIT 10""",
    "extract_hour": """
        SELECT extract(HOUR FROM played_at) AS hour, avg(valence) AS avg_mood, avg(energy) AS avg_energy,
               count(*) AS plays
        FROM listening_with_features GROUP BY extract(HOUR FROM played_at) ORDER BY hour""",
    "group_distinct": """
        SELECT track_name, artist_name, energy, danceability
        FROM listening_with_features WHERE energy > 0.7 AND danceability > 0.7
        GROUP BY track_name, artist_name, energy, danceability
        ORDER BY energy DESC, danceability DESC, track_name, artist_name LIMIT 20""",
    "low_value": """
        SELECT track_name, artist_name, valence AS sadness_score, count(*) AS play_count
        FROM listening_with_features WHERE valence < 0.3
        GROUP BY track_name, artist_name, valence
        ORDER BY play_count DESC, track_name, artist_name, valence LIMIT 10""",
    "trailing_7d": """
        SELECT track_name, artist_name, count(*) AS plays
        FROM listening_with_features
        WHERE date >= CAST(:as_of AS DATE) - INTERVAL 7 DAYS AND played_at > CAST(:as_of AS DATE) - INTERVAL 7 DAYS
        GROUP BY track_name, artist_name ORDER BY plays DESC, track_name, artist_name LIMIT 20""",
    "chill": """
        SELECT DISTINCT track_name, artist_name, energy, valence
        FROM listening_with_features WHERE energy < 0.4 AND valence > 0.5 AND acousticness > 0.5
        ORDER BY valence DESC, energy, track_name, artist_name LIMIT 30""",
    "feature_scatter": """
        SELECT valence, energy, danceability, tempo FROM listening_with_features
        ORDER BY played_at, track_id LIMIT 1000""",
    "point_filter": """
        SELECT * FROM listening_patterns_by_time WHERE hour_of_day = :hour""",
    "row_count": "SELECT count(*) AS row_count FROM listening_with_features",
    "energetic_hours": """
        SELECT hour_of_day, avg(energy) AS avg_energy, count(*) AS play_count
        FROM listening_with_features GROUP BY hour_of_day ORDER BY avg_energy DESC, hour_of_day""",
    "anomalies": """
        SELECT track_id, played_at, hour_of_day, anomaly_score
        FROM listening_anomaly_events ORDER BY anomaly_score DESC, played_at, track_id LIMIT 10""",
    "scatter": """
        SELECT danceability AS x, avg(energy) AS avg_y, count(*) AS n
        FROM listening_with_features GROUP BY danceability ORDER BY n DESC, x LIMIT 1000""",
    "plays_by_hour": """
        SELECT hour_of_day, sum(play_count) AS plays
        FROM listening_patterns_by_time GROUP BY hour_of_day ORDER BY hour_of_day""",
    "weekend_bars": """
        SELECT period, avg_valence, avg_energy, avg_danceability FROM weekend_vs_weekday""",
    "heatmap": """
        SELECT feature_1, feature_2, correlation FROM feature_correlations""",
}


def run_sql(
    spark: SparkSession, name: str, tables: Mapping[str, DataFrame] | None = None, **args: Any
) -> DataFrame:
    """Run a named query over registered views; ``tables`` are registered first."""
    for view, frame in (tables or {}).items():
        frame.createOrReplaceTempView(view)
    return spark.sql(QUERIES[name], args=args or None)
