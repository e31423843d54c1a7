"""The layers end to end on data derived from the test tables."""

import re

import pytest

from pyspark.sql import functions as F
from tidemark.plans import bindings, pipeline, sqlviews
from tidemark.schemas import schema
from tidemark.session import scratch_path
from tidemark.sources import sinks
from tidemark.sources.counting import StepCounts
from tidemark.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def event_payloads(spark):
    track = F.struct(
        F.col("track_id").alias("id"),
        F.col("track_name").alias("name"),
        F.array(F.struct(F.col("artist_name").alias("name"))).alias("artists"),
        F.struct(F.col("album_name").alias("name")).alias("album"),
        "duration_ms",
    )
    stamp = F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return bindings.history(spark, SF).select(F.to_json(F.struct(stamp.alias("played_at"), track.alias("track"))).alias("payload"))


@pytest.fixture(scope="module")
def built(spark):
    lake = pipeline.Lake(scratch_path(spark, "lake"))
    for _ in range(2):  # the second delivery is the first again
        pipeline.ingest_events(lake, event_payloads(spark))
    provided = bindings.provided(spark, SF)
    tracks = provided.select(F.to_json(F.struct(F.col("track_id").alias("id"))).alias("payload"))
    features = provided.select(
        F.to_json(F.struct(F.col("track_id").alias("id"), "danceability", "energy", "valence", "tempo")).alias("payload")
    )
    pipeline.ingest_tracks(lake, tracks, features, "v1")
    tracks_path = pipeline.ingest_tracks(lake, tracks, features, "v2", previous="v1")
    catalog = bindings.catalog(spark, SF).withColumnRenamed("track_id", "Track_ID").withColumn("Name", F.lit("n"))
    csv = sinks.export_csv(catalog, scratch_path(spark, "catalog-csv"))
    pipeline.ingest_catalog(spark, lake, csv)
    for _ in range(2):
        pipeline.populate_attributes(spark, lake, tracks_path)
    outcome = pipeline.run_steps(pipeline.layers(spark, lake, tracks_path))
    return lake, tracks_path, outcome


def test_every_step_succeeds(built):
    _, _, outcome = built
    assert outcome.succeeded, [r for r in outcome.rows if not r[1]]


def test_bronze_holds_each_row_once(spark, built):
    lake, tracks_path, _ = built
    events = bindings.table(spark, SF, "events")
    history = read_table(spark, lake.bronze(pipeline.HISTORY))
    assert history.count() == events.select("user_id", "ts").distinct().count()
    made = read_table(spark, lake.bronze(pipeline.GENERATED))
    assert made.count() == made.select("track_id").distinct().count()
    first = read_table(spark, tracks_path.replace("v2", "v1"))
    assert read_table(spark, tracks_path).count() == first.count() == first.select("track_id").distinct().count()
    catalog = read_table(spark, lake.bronze(pipeline.CATALOG))
    assert catalog.columns == schema(pipeline.CATALOG).names and catalog.count() == 6000


def test_silver_keeps_every_event(spark, built):
    lake, _, _ = built
    silver = read_table(spark, lake.silver)
    assert silver.count() == read_table(spark, lake.bronze(pipeline.HISTORY)).count()
    shares = {r.feature_source: r for r in pipeline.silver_coverage(spark, lake).collect()}
    assert set(shares) == {"real", "synthetic"}
    assert sum(r.record_count for r in shares.values()) == silver.count()


def test_gold_tables_agree_on_the_number_of_plays(spark, built):
    lake, _, _ = built
    plays = read_table(spark, lake.silver).count()
    paths = pipeline.gold_paths(lake)
    for name, column in {
        "listening_patterns_by_time": "play_count", "temporal_trends": "total_plays",
        "mood_time_correlations": "sample_size", "weekend_vs_weekday": "total_plays",
        "part_of_day_drivers": "total_plays", "feature_source_coverage": "record_count",
        "sequential_patterns": "occurrence_count",
    }.items():
        assert read_table(spark, paths[name]).agg(F.sum(column)).first()[0] == plays, name
    assert read_table(spark, paths["mood_shift_patterns"]).agg(F.sum("shift_count")).first()[0] == plays - 1
    correlations = read_table(spark, paths["feature_correlations"])
    assert correlations.count() == 21 and correlations.where("abs(correlation) > 1").count() == 0


def test_validation_registration_and_queries(spark, built):
    lake, tracks_path, _ = built
    failed = {(r.table, r.check) for r in pipeline.validate(spark, lake).where("NOT passed").collect()}
    # The test catalog is smaller than a real one, and its tempo column is not clean on purpose.
    assert failed == {("kaggle_tracks_bronze", "row_count"), ("kaggle_tracks_bronze", "range")}
    views = pipeline.register(spark, lake, tracks_path)
    bronze = {pipeline.HISTORY, pipeline.TRACKS, pipeline.CATALOG, pipeline.GENERATED}
    assert views.where("NOT registered").count() == 0
    assert {r.table_name for r in views.collect()} == {*bronze, pipeline.SILVER_NAME, *pipeline.GOLD_FAMILIES}
    for name in bronze:
        assert spark.table(name).count() > 0
    args = {
        "strong_pairs": {"cut": 0.3}, "trailing_7d": {"as_of": "2024-01-31"}, "point_filter": {"hour": 14},
        "reco": {"scenario": "When feeling down or low energy"},
    }
    for name in sqlviews.QUERIES:
        assert sqlviews.run_sql(spark, name, **args.get(name, {})).columns
    week = sqlviews.run_sql(spark, "trailing_7d", as_of="2024-01-31")
    scan = week._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date[^\]]*>=", scan)


def test_exports_read_back(spark, built):
    lake, _, _ = built
    out = scratch_path(spark, "exports")
    written = pipeline.export_gold(spark, lake, out)
    assert len(written) == len(pipeline.GOLD_FAMILIES)
    trends = spark.read.option("header", True).csv(f"{out}/temporal_trends")
    assert trends.columns == ["date", "total_plays", "avg_valence", "avg_energy", "avg_tempo", "weekend_plays"]
    assert trends.count() == read_table(spark, pipeline.gold_paths(lake)["temporal_trends"]).count()


def test_rollup_follows_silver(spark, built):
    lake, _, _ = built
    silver = read_table(spark, lake.silver)
    assert read_table(spark, lake.rollup).agg(F.sum("n")).first()[0] == silver.count()
    before = {r.date: r for r in read_table(spark, pipeline.gold_paths(lake)["temporal_trends"]).collect()}
    copy = pipeline.Lake(scratch_path(spark, "lake"))
    day = min(before)
    sinks.write_table(silver.where(F.col("date") != F.lit(day)), copy.silver, partition_by=["date"])
    sinks.write_table(read_table(spark, lake.rollup), copy.rollup, partition_by=["date"])
    pipeline.refresh_rollup(spark, copy, spark.createDataFrame([(day,)], "date date"))
    pipeline.build_from_silver(spark, copy, ["temporal_trends"])
    after = {r.date: r for r in read_table(spark, pipeline.gold_paths(copy)["temporal_trends"]).collect()}
    assert after == {d: r for d, r in before.items() if d != day}


def test_rejected_payloads_are_counted_while_they_are_stored(spark):
    lake, counts = pipeline.Lake(scratch_path(spark, "lake")), StepCounts()
    good = event_payloads(spark).limit(50).cache()
    bad = spark.createDataFrame([("{",), (None,), ('{"played_at": "x", "track": {"id": "1"}}',), ('{"track": {"id": ""}}',)], "payload string")
    pipeline.ingest_events(lake, good.unionByName(bad), counts)
    pipeline.ingest_events(lake, bad, counts)  # nothing is left of this one
    found = [(r.step, r.metric, r.value) for r in counts.table(spark).collect()]
    assert found == [("parse_events", m, v) for m, v in (("read", 54), ("kept", 50), ("rejected", 4), ("read", 4), ("kept", 0), ("rejected", 4))]
    assert read_table(spark, lake.bronze(pipeline.HISTORY)).count() == 50


def test_generation_can_be_switched_off(spark, built):
    lake, tracks_path, _ = built
    assert pipeline.populate_attributes(spark, lake, tracks_path, allow=False) is None


def test_a_critical_failure_stops_the_run():
    ran = []

    def fail():
        raise RuntimeError("no")

    steps = [
        pipeline.Step("a", lambda: ran.append("a")), pipeline.Step("b", fail), pipeline.Step("c", fail, critical=True),
        pipeline.Step("d", lambda: ran.append("d")),
    ]
    outcome = pipeline.run_steps(steps)
    assert ran == ["a"] and [r[1] for r in outcome.rows] == [True, False, False] and not outcome.succeeded
