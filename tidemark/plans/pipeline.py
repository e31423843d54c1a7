"""Bronze, silver and gold in one session: layers pass tables by path, steps inside a layer pass frames."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..functions.timeparts import time_dimensions
from ..operators import anomaly, learn, profiles, quality, ranking, rollup, segment, sequence
from ..operators.conform import conform_catalog, stamp
from ..operators.enrich import any_present, attach_attributes, coverage_stats, generate_attributes, missing_keys
from ..operators.enrich import training_rows
from ..schemas import ATTRIBUTES, schema
from ..sources import payloads, sinks
from ..sources.counting import StepCounts
from ..sources.csvfiles import read_csv_strict
from ..sources.tables import read_optional, read_table


@dataclass(frozen=True)
class Lake:
    """Where each table lives under one root folder."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/listening_with_features"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def rollup(self) -> str:
        return f"{self.root}/silver/listening_by_hour"

    def gold_table(self, family: str, name: str) -> str:
        return f"{self.gold}/{family}/{name}"


# Names and labels that readers of the tables filter on.
HISTORY, TRACKS, CATALOG, GENERATED = (
    "listening_history_bronze",
    "my_tracks_features_bronze",
    "kaggle_tracks_bronze",
    "my_tracks_features_bronze_synthetic",
)
SILVER_NAME = "listening_with_features"
# Tables whose row count is bounded by their keys, not by the data: these may be exported as one file.
PREDICTION_TABLES = ("mood_predictions", "energy_forecasts", "mood_classifications", "listening_anomaly_events")


# --- bronze --------------------------------------------------------------------------------------


def ingest_events(lake: Lake, payload_rows: DataFrame, counts: StepCounts | None = None) -> str:
    """Append the new events of a frame of JSON payloads; ``counts`` gets the payloads read, kept and rejected."""
    return sinks.append_new(stamp(payloads.parse_events(payload_rows, counts=counts)), lake.bronze(HISTORY))


def ingest_tracks(
    lake: Lake, tracks: DataFrame, features: DataFrame, version: str, previous: str | None = None
) -> str:
    """Merge track payloads into the ``previous`` version of the track table; returns the new version's path."""
    rows = stamp(payloads.parse_entities(tracks, features))
    current = f"{lake.bronze(TRACKS)}/{previous}" if previous else None
    return sinks.upsert_table(rows, current, f"{lake.bronze(TRACKS)}/{version}")


def ingest_catalog(spark: SparkSession, lake: Lake, csv_path: str) -> str:
    """Replace the catalog from CSV. The header decides which columns there are; all are read as text."""
    header = spark.read.option("header", True).csv(csv_path).schema
    rows = read_csv_strict(spark, csv_path, header)
    return sinks.write_catalog(conform_catalog(rows, schema(CATALOG)), lake.bronze(CATALOG))


def populate_attributes(spark: SparkSession, lake: Lake, tracks_path: str | None, allow: bool = True) -> str | None:
    """Generate attributes for history keys that have none; does nothing if not allowed."""
    if not allow:
        return None
    history = read_table(spark, lake.bronze(HISTORY))
    tracks = read_optional(spark, tracks_path)
    generated = read_optional(spark, lake.bronze(GENERATED))
    covered = [f for f in (generated,) if f is not None]
    if tracks is not None:
        covered.append(any_present(tracks, ["danceability", "energy", "valence"]))
    made = generate_attributes(missing_keys(history, "track_id", covered))
    return sinks.append_generated(stamp(made, "_generated_at"), lake.bronze(GENERATED))


# --- silver --------------------------------------------------------------------------------------


def build_silver(spark: SparkSession, lake: Lake, tracks_path: str | None = None) -> DataFrame:
    """Every event with attributes (real, then synthetic, then catalog), provenance and time columns."""
    tracks = read_optional(spark, tracks_path)
    if tracks is not None:
        tracks = any_present(tracks, [a for a in ATTRIBUTES if a in tracks.columns])
    sources = {
        "real": tracks,
        "synthetic": read_optional(spark, lake.bronze(GENERATED)),
        "kaggle": read_optional(spark, lake.bronze(CATALOG)),
    }
    events = read_table(spark, lake.bronze(HISTORY))
    return stamp(time_dimensions(attach_attributes(events, sources)), "_silver_created_at")


def write_silver(df: DataFrame, lake: Lake) -> str:
    return sinks.write_table(df, lake.silver, partition_by=["date"], whole=True)


def write_rollup(spark: SparkSession, lake: Lake) -> str:
    """The rollup of all silver by date and hour."""
    return sinks.write_table(rollup.roll_up(read_table(spark, lake.silver)), lake.rollup, partition_by=["date"], whole=True)


def refresh_rollup(spark: SparkSession, lake: Lake, dates: DataFrame) -> str:
    """Replace the rollup of the listed dates; only their silver partitions are read."""
    fresh = rollup.refreshed(read_table(spark, lake.silver), dates)
    return sinks.write_table(fresh, lake.rollup, partition_by=["date"])


# --- gold ----------------------------------------------------------------------------------------

Builder = Callable[[DataFrame], DataFrame]

# Family and builder of each table made from silver alone; those in FROM_ROLLUP from its rollup by date and hour.
FROM_SILVER: dict[str, tuple[str, Builder]] = {
    "listening_patterns_by_time": ("descriptive", partial(profiles.patterns_by_time, profile=rollup.rolled_profile)),
    "top_tracks_by_mood": ("descriptive", ranking.top_by_bucket),
    "audio_feature_distributions": ("descriptive", profiles.feature_profile),
    "temporal_trends": ("descriptive", partial(profiles.daily_trends, ts=None, profile=rollup.rolled_profile)),
    "feature_source_coverage": ("descriptive", lambda df: profiles.share_of_total(df, "feature_source")),
    "mood_time_correlations": ("diagnostic", partial(profiles.hourly_profile, profile=rollup.rolled_profile)),
    "feature_correlations": ("diagnostic", profiles.pairwise_corr),
    "weekend_vs_weekday": ("diagnostic", partial(profiles.period_compare, profile=rollup.rolled_profile)),
    "mood_shift_patterns": ("diagnostic", sequence.shift_patterns),
    "part_of_day_drivers": ("diagnostic", partial(profiles.part_of_day_profile, profile=rollup.rolled_profile)),
    "mood_improvement_recommendations": ("prescriptive", ranking.recommend_top),
    "personalized_playlist_suggestions": ("prescriptive", ranking.rule_playlists),
    "mood_intervention_triggers": ("prescriptive", ranking.intervention_hours),
    "listening_anomalies": ("cognitive", anomaly.anomaly_summary),
    "listening_anomaly_events": ("cognitive", anomaly.anomaly_events),
    "sequential_patterns": ("cognitive", sequence.state_counts),
    "state_transitions": ("cognitive", sequence.state_transitions),
    "behavioral_segments": ("cognitive", segment.behavior_segment),
}
FROM_ROLLUP = (
    "listening_patterns_by_time",
    "temporal_trends",
    "mood_time_correlations",
    "weekend_vs_weekday",
    "part_of_day_drivers",
)
PREDICTIONS = {
    "mood_predictions": learn.VALENCE_FOREST,
    "energy_forecasts": learn.ENERGY_LINEAR,
    "mood_classifications": learn.MOOD_FOREST,
}
GOLD_FAMILIES = {
    **{name: family for name, (family, _) in FROM_SILVER.items()},
    **{name: "predictive" for name in PREDICTIONS},
    "model_performance_metrics": "predictive",
    "optimal_listening_times": "prescriptive",
    "mood_state_clusters": "cognitive",
}


def build_from_silver(spark: SparkSession, lake: Lake, names: Iterable[str] = FROM_SILVER) -> list[str]:
    def source(name: str) -> DataFrame:
        return read_table(spark, lake.rollup if name in FROM_ROLLUP else lake.silver)

    return [sinks.write_gold(build(source(n)), lake.gold, family, n) for n in names for family, build in [FROM_SILVER[n]]]


def build_predictions(spark: SparkSession, lake: Lake) -> list[str]:
    """Train the three models on the catalog, score silver, store predictions and metrics."""
    train = training_rows(read_table(spark, lake.bronze(CATALOG)), "track_id")
    silver = read_table(spark, lake.silver)
    runs = {name: learn.train_and_score(spec, train, silver, "track_id") for name, spec in PREDICTIONS.items()}
    written = [sinks.write_gold(run.predictions, lake.gold, "predictive", name) for name, run in runs.items()]
    stored = [read_table(spark, path) for path in written]
    metrics = learn.wide_metrics(learn.model_metrics(list(runs.values()), stored))
    return [*written, sinks.write_gold(metrics, lake.gold, "predictive", "model_performance_metrics")]


def build_best_hours(spark: SparkSession, lake: Lake) -> list[str]:
    predictions = read_table(spark, lake.gold_table("predictive", "mood_predictions"))
    return [sinks.write_gold(ranking.best_hours(predictions), lake.gold, "prescriptive", "optimal_listening_times")]


def build_clusters(spark: SparkSession, lake: Lake) -> list[str]:
    study = learn.cluster_study(read_table(spark, lake.silver))
    return [sinks.write_gold(study.profiles, lake.gold, "cognitive", "mood_state_clusters")]


# --- validation and publishing -------------------------------------------------------------------


def gold_paths(lake: Lake) -> dict[str, str]:
    return {name: lake.gold_table(family, name) for name, family in GOLD_FAMILIES.items()}


def validate(spark: SparkSession, lake: Lake) -> DataFrame:
    """Check results of all three layers; a table that is not there is a failed check."""

    def suite(checks: dict[str, Sequence[quality.Check]], path_of: Callable[[str], str], layer: str) -> DataFrame:
        return quality.run_suite(spark, {n: (read_optional(spark, path_of(n)), c) for n, c in checks.items()}, layer)

    gold = gold_paths(lake)
    return (
        suite(quality.BRONZE_CHECKS, lake.bronze, "bronze")
        .unionByName(suite(quality.SILVER_CHECKS, lambda _: lake.silver, "silver"))
        .unionByName(suite(quality.GOLD_CHECKS, gold.__getitem__, "gold"))
    )


def register(spark: SparkSession, lake: Lake, tracks_path: str | None = None) -> DataFrame:
    """Views for every bronze, silver and gold table that exists, by their names.

    The track table is versioned: ``tracks_path`` is the version to show.
    """
    bronze = {name: lake.bronze(name) for name in (HISTORY, CATALOG, GENERATED)}
    versions = {TRACKS: tracks_path} if tracks_path else {}
    return sinks.register_views(spark, {**bronze, **versions, SILVER_NAME: lake.silver, **gold_paths(lake)})


def export_gold(spark: SparkSession, lake: Lake, out: str) -> list[str]:
    """CSV of every gold table that exists: one file each, but prediction tables (a row per event) in parts."""
    written = []
    for name, path in gold_paths(lake).items():
        frame = read_optional(spark, path)
        if frame is not None:
            single = name not in PREDICTION_TABLES
            written.append(sinks.export_csv(frame, f"{out}/{name}", single_file=single))
    return written


def sync_gold(spark: SparkSession, lake: Lake, url: str, **options: str) -> list[str]:
    """Replace the database copy of every gold table that exists."""
    present = {n: read_optional(spark, p) for n, p in gold_paths(lake).items()}
    for name, frame in present.items():
        if frame is not None:
            sinks.write_jdbc(frame, url, name, **options)
    return [n for n, frame in present.items() if frame is not None]


# --- run -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """A named piece of work; if a critical one fails the run stops."""

    name: str
    run: Callable[[], object]
    critical: bool = False


@dataclass
class Outcome:
    rows: list[tuple[str, bool, float, str]] = field(default_factory=list)

    @property
    def succeeded(self) -> bool:
        return all(ok for _, ok, _, _ in self.rows)


def run_steps(steps: Sequence[Step]) -> Outcome:
    outcome = Outcome()
    for step in steps:
        started = time.monotonic()
        try:
            step.run()
            outcome.rows.append((step.name, True, time.monotonic() - started, ""))
        except Exception as error:  # a step that is not critical must not stop the others
            outcome.rows.append((step.name, False, time.monotonic() - started, str(error)))
            if step.critical:
                break
    return outcome


def layers(spark: SparkSession, lake: Lake, tracks_path: str | None = None) -> list[Step]:
    """Silver and gold from existing bronze tables."""
    silver_tables = [
        Step(f"gold:{n}", lambda n=n: build_from_silver(spark, lake, [n])) for n in FROM_SILVER
    ]
    return [
        Step("silver", lambda: write_silver(build_silver(spark, lake, tracks_path), lake), critical=True),
        Step("silver:rollup", lambda: write_rollup(spark, lake)),
        *silver_tables,
        Step("gold:predictions", lambda: build_predictions(spark, lake)),
        Step("gold:optimal_listening_times", lambda: build_best_hours(spark, lake)),
        Step("gold:mood_state_clusters", lambda: build_clusters(spark, lake)),
    ]


def silver_coverage(spark: SparkSession, lake: Lake) -> DataFrame:
    return coverage_stats(read_table(spark, lake.silver))
