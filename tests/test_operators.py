"""Operators on hand-made rows: NULLs, ties, duplicates, one-row groups, empty input."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F
from tidemark.functions.timeparts import time_dimensions
from tidemark.operators import anomaly, conform, enrich, metrics, profiles, ranking, rollup, segment, sequence
from tidemark.schemas import SCHEMAS, schema


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


# --- enrichment ----------------------------------------------------------------------------------


def test_sources_are_preferred_in_order_and_events_never_multiply(spark):
    events = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), (None, 6)], "k string, n int")
    real = spark.createDataFrame([("a", 1.0, None), ("b", None, 2.0)], "k string, x double, y double")
    made = spark.createDataFrame([("b", 5.0), ("b", 7.0), ("c", 9.0)], "k string, x double")
    late = spark.createDataFrame([("a", 99.0), ("c", 8.0)], "k string, y double")
    out = enrich.attach_attributes(
        events, {"real": real, "made": made, "gone": None, "late": late}, "k", {"x": "double", "y": "double"}, probe="x"
    )
    assert {(r.n, r.x, r.y, r.feature_source) for r in out.collect()} == {
        (1, 1.0, 99.0, "real"),
        (2, 1.0, 99.0, "real"),
        (3, 7.0, 2.0, "made"),
        (4, 9.0, 8.0, "made"),
        (5, None, None, "unknown"),
        (6, None, None, "unknown"),
    }


def test_no_sources_leave_typed_nulls(spark):
    out = enrich.attach_attributes(spark.createDataFrame([("a",)], "track_id string"), {"real": None})
    assert dict(out.dtypes)["valence"] == "float" and dict(out.dtypes)["key"] == "int"
    assert out.first().feature_source == "unknown"


def test_latest_row_of_a_source_is_taken_whole(spark):
    events = spark.createDataFrame([("a",)], "k string")
    source = spark.createDataFrame(
        [("a", 9.0, 1.0, dt.datetime(2024, 1, 1)), ("a", 2.0, None, dt.datetime(2024, 1, 2))],
        "k string, x double, y double, at timestamp",
    )
    attributes = {"x": "double", "y": "double"}
    out = enrich.attach_attributes(events, {"s": source}, "k", attributes, "x", latest_by="at")
    assert rows(out, "x", "y") == [(2.0, None)]
    # Any orderable type will do, and a source without the column has no order of its own.
    by_version = source.selectExpr("k", "x", "y", "day(at) AS at")
    both = {"s": by_version, "t": spark.createDataFrame([("a", 5.0)], "k string, y double")}
    assert rows(enrich.attach_attributes(events, both, "k", attributes, "x", latest_by="at"), "x", "y") == [(2.0, 5.0)]


def test_one_per_key_and_merge(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, None), (None, 3, "n")]
    df = spark.createDataFrame(data, "k string, v int, t string")
    assert set(enrich.one_per_key(df, ["k"], ["v"]).collect()) == {("a", 2, "z"), ("b", None, None), (None, 3, "n")}
    assert rows(enrich.one_per_key(df.select("k").where("k = 'a'"), ["k"])) == [("a",)]
    target = spark.createDataFrame([("a", 0, "old"), ("c", 0, "kept")], "k string, v int, t string")
    merged = enrich.merge_latest(target, df.where("k IS NOT NULL"), ["k"], ["v"])
    assert {(r.k, r.t) for r in merged.collect()} == {("a", "z"), ("b", None), ("c", "kept")}


def test_missing_keys_and_coverage(spark):
    history = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    real = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    made = spark.createDataFrame([("b",), ("b",)], "k string")
    assert rows(enrich.missing_keys(history, "k", [real, made])) == [("c",)]
    assert rows(enrich.missing_keys(history, "k", [])) == [("a",), ("b",), ("c",)]
    assert rows(enrich.key_coverage(history, "k", [real, made])) == [(3, 2, 1, 66.67)]


def test_range_clean_drops_nulls(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.1,), (None,)], "v double")
    assert rows(enrich.range_clean(df, {"v": (0, 1)})) == [(0.0,), (1.0,)]
    assert rows(enrich.range_clean_counts(df, {"v": (0, 1)})) == [(4, 2, 2)]


def test_generated_attributes_repeat_on_any_partitioning(spark):
    keys = spark.range(500).selectExpr("CAST(id AS STRING) AS track_id")
    one = rows(enrich.generate_attributes(keys.coalesce(1)))
    assert one == rows(enrich.generate_attributes(keys.repartition(7)))
    frame = enrich.generate_attributes(keys)
    spread = frame.selectExpr("min(tempo)", "max(tempo)", "min(loudness)", "max(loudness)").first()
    assert 60 <= spread[0] < spread[1] <= 180 and -25 <= spread[2] < spread[3] <= -3
    declared = {f.name: f.dataType for f in schema("my_tracks_features_bronze_synthetic").fields}
    assert all(declared[f.name] == f.dataType for f in frame.schema.fields)


# --- conforming ----------------------------------------------------------------------------------


def test_column_clash_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "Artist int, artist_name int")
    with pytest.raises(ValueError, match="artists"):
        conform.normalize_columns(df, SCHEMAS["kaggle_tracks_bronze"].names, conform.CATALOG_ALIASES)


def test_catalog_conforms_and_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("x", "abc", "0.5"), ("y", "7", None)], "Song_Name string, Popularity string, ENERGY string")
    out = conform.conform_catalog(df, schema("kaggle_tracks_bronze"))
    assert out.columns == schema("kaggle_tracks_bronze").names
    assert {(r.track_name, r.popularity, r.energy) for r in out.collect()} == {("x", None, 0.5), ("y", 7, None)}
    assert all(r.track_id and r._ingested_at for r in out.collect())


def test_unknown_schema_name():
    with pytest.raises(ValueError, match="unknown schema"):
        schema("nope")


# --- profiles ------------------------------------------------------------------------------------


def test_profile_of_nulls_and_nothing(spark):
    none = spark.createDataFrame([(None,)], "m double")
    assert rows(profiles.feature_profile(none, ["m"])) == [("m", 0.0, 0.0, 0.0, 0.0)]
    assert rows(profiles.feature_profile(none.limit(0), ["m"])) == [("m", 0.0, 0.0, 0.0, 0.0)]


def test_correlation_is_pairwise_and_zero_for_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (100.0, None, 5.0)], "a double, b double, c double"
    )
    found = {(r.feature_1, r.feature_2): (r.correlation, r.strength) for r in profiles.pairwise_corr(df, "abc").collect()}
    assert found == {("a", "b"): (1.0, "Strong"), ("a", "c"): (0.0, "Weak"), ("b", "c"): (0.0, "Weak")}


def test_correlation_adds_up_patterns_of_missing_values(spark):
    import math

    draw = random.Random(2)
    data = [tuple(None if draw.random() < 0.3 else 1e6 + draw.random() * (i + 1) for i in range(4)) for _ in range(400)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(7)
    found = {(r.feature_1, r.feature_2): r.correlation for r in profiles.pairwise_corr(df, "abcd").collect()}
    assert len(found) == 6
    for (one, other), r in found.items():
        i, j = "abcd".index(one), "abcd".index(other)
        both = [(row[i], row[j]) for row in data if row[i] is not None and row[j] is not None]
        mx, my = (sum(v) / len(both) for v in zip(*both))
        xy, xx, yy = (sum((x - mx) ** p * (y - my) ** q for x, y in both) for p, q in ((1, 1), (2, 0), (0, 2)))
        assert r == pytest.approx(xy / math.sqrt(xx * yy), abs=6e-4)
    empty = profiles.pairwise_corr(df.limit(0), "abcd")
    assert rows(empty, "correlation") == [(0.0,)] * 6


def test_own_attributes_of_events_come_first_and_once(spark):
    events = spark.createDataFrame([("a", 0.1, 1), ("b", None, 2), ("c", None, 3)], "track_id string, valence double, n int")
    source = spark.createDataFrame([("a", 0.5, 0.9), ("b", 0.6, 0.8)], "track_id string, danceability double, valence double")
    for sources, expected in (({"s": source}, [0.1, 0.8, None]), ({"s": None}, [0.1, None, None])):
        joined = enrich.attach_attributes(events, sources)
        assert joined.columns.count("valence") == 1
        found = joined.orderBy("n").collect()
        assert [None if r.valence is None else round(r.valence, 6) for r in found] == expected


def test_shares_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None), (None, None)], "k string, v int")
    assert [tuple(r) for r in profiles.share_of_total(df, "k").collect()] == [("a", 2, 50.0), (None, 1, 25.0), ("b", 1, 25.0)]
    assert [tuple(r) for r in profiles.null_profile(df).collect()] == [("v", 3, 75.0), ("k", 1, 25.0)]
    assert rows(profiles.distinct_count(df, "k", "v")) == [(4,)]
    assert abs(profiles.distinct_count(spark.range(1000), "id", approximate=True).first()[0] - 1000) < 60


# --- ranking -------------------------------------------------------------------------------------


@pytest.mark.parametrize("top_n", [ranking.top_n_per_group, ranking.global_ranks])
def test_top_n_breaks_ties_alike_by_both_ways(spark, top_n):
    df = spark.range(3000).selectExpr("if(id < 2900, 'hot', 'cold') AS g", "id", "id % 7 AS v")
    top = top_n(df, "g", [F.desc("v"), F.asc("id")], 5)
    expected = []
    for g, ids in (("hot", range(2900)), ("cold", range(2900, 3000))):
        order = sorted(ids, key=lambda i: (-(i % 7), i))[:5]
        expected += [(g, i, r) for r, i in enumerate(order, 1)]
    assert rows(top, "g", "id", "rank") == sorted(expected)


def test_global_ranks_of_nulls_and_nothing(spark, many_slices):
    data = [(None if i % 3 else "a", i * 37 % 101, i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(5)
    found = {r.id: r["rank"] for r in ranking.global_ranks(df, "g", [F.asc("v"), F.asc("id")]).collect()}
    expected = {}
    for group in (None, "a"):
        own = sorted((v, i) for g, v, i in data if g == group)
        expected |= {i: rank for rank, (_, i) in enumerate(own, 1)}
    assert found == expected
    assert ranking.global_ranks(df.limit(0), "g", [F.asc("id")], 3).count() == 0


def test_rollup_adds_up_to_the_profile_of_the_events(spark):
    draw = random.Random(8)
    data = [
        (f"2024-0{draw.randrange(1, 4)}-{draw.randrange(10, 28)} {draw.randrange(24):02}:30:00", *[None if draw.random() < 0.2 else 1e5 + draw.random() for _ in range(6)])
        for _ in range(700)
    ]
    events = spark.createDataFrame(data, "t string, " + ", ".join(f"{m} double" for m in rollup.MEASURES))
    events = time_dimensions(events.withColumn("played_at", F.expr("CAST(t AS TIMESTAMP)"))).repartition(6)
    rolled = rollup.roll_up(rollup.with_date(events))
    for table in (profiles.patterns_by_time, profiles.hourly_profile, profiles.period_compare, profiles.part_of_day_profile):
        assert table(rolled, profile=rollup.rolled_profile).collect() == table(events).collect()
    assert profiles.daily_trends(rolled, ts=None, profile=rollup.rolled_profile).collect() == profiles.daily_trends(events).collect()
    assert profiles.hourly_profile(rolled.limit(0), profile=rollup.rolled_profile).count() == 0


def test_rules_match_one_scan_per_rule(spark):
    rng = random.Random(5)
    data = [
        (f"t{rng.randrange(30)}", "a", *[rng.randrange(101) / 100 for _ in range(5)], float(rng.randrange(60, 181)))
        for _ in range(2000)
    ] + [("tn", "a", None, None, None, None, None, None)]
    measures = ["valence", "energy", "danceability", "acousticness", "instrumentalness", "tempo"]
    df = spark.createDataFrame(data, "track_name string, artist_name string, " + ", ".join(f"{m} double" for m in measures))
    found = rows(ranking.rule_playlists(df))
    expected = []
    for rule in ranking.PLAYLIST_RULES:
        best = (
            df.where(rule.where)
            .groupBy("track_name", "artist_name")
            .agg(F.expr(f"round(avg({rule.measure}), 6) AS m"), F.count("*").alias("n"))
            .orderBy(F.desc("m"), "track_name")
            .limit(10)
        )
        expected += [(rule.name, rule.purpose, r.track_name, r.artist_name, r.n) for r in best.collect()]
    assert found == sorted(expected)


def test_recommendation_reasons(spark):
    data = [("e", 0.9, 0.7, 0.1)] * 2 + [("d", 0.9, 0.1, 0.7)] * 2 + [("n", 0.8, 0.1, 0.1)] * 2 + [("once", 1.0, 1.0, 1.0)]
    data += [("low", 0.69, 1.0, 1.0)] * 3
    df = spark.createDataFrame([(t, "a", *m) for t, *m in data], "track_name string, artist_name string, valence double, energy double, danceability double")
    found = [(r.track_name, r.recommendation_reason.split()[0]) for r in ranking.recommend_top(df).collect()]
    assert sorted(found) == [("d", "Danceable"), ("e", "High"), ("n", "Positive")]


# --- sequences -----------------------------------------------------------------------------------


def brute_force_previous(data, by):
    last, out = {}, {}
    for key, ts, ident, value in sorted(data, key=lambda r: (r[1], r[2])):
        group = key if by else None
        out[ident] = last.get(group)
        last[group] = value
    return out


@pytest.fixture
def many_slices(spark):
    """Small test data would be merged into one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("partitions", [1, 13])
def test_previous_row_across_slices_and_hot_keys(spark, many_slices, by, partitions):
    rng = random.Random(11)
    # One key holds most rows, and one instant a third of them.
    data = [
        ("hot" if rng.random() < 0.7 else f"k{rng.randrange(40)}", 0 if rng.random() < 0.34 else rng.randrange(1000), i, i * 1.5)
        for i in range(4000)
    ]
    df = spark.createDataFrame(data, "k string, ts int, id int, v double").repartition(partitions)
    found = sequence.with_previous(df, ["v"], ["ts", "id"], by)
    assert {r.id: r.prev_v for r in found.collect()} == brute_force_previous(data, by)


def test_rows_of_one_key_are_spread_over_time_buckets(spark, many_slices):
    df = spark.range(8000).selectExpr("'hot' AS k", "timestamp_seconds(id * 60) AS ts", "id", "id AS v")
    found = sequence.with_previous(df, ["v"], ["ts", "id"], ["k"]).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in found.groupBy("task").count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 8000 / 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "bigint"])
def test_time_buckets_never_fall(spark, kind):
    draw = random.Random(5)
    seconds = sorted(draw.randrange(-4_000_000, 4_000_000) for _ in range(500))
    source = {"date": "date_add(date'1970-01-01', CAST(s / 86400 AS INT))", "double": "s / 7D", "bigint": "s"}.get(
        kind, f"CAST(timestamp_seconds(s) AS {kind})"
    )
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").selectExpr("s", f"{source} AS t")
    buckets = [r.b for r in df.selectExpr("t", f"{sequence.time_bucket(df, 't', 600)} AS b").orderBy("t").collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) > 50


def test_previous_of_null_values_and_short_input(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None)], "ts int, v double")
    assert rows(sequence.with_previous(df, ["v"], ["ts"]), "ts", "prev_v") == [(1, None), (2, None), (3, 5.0)]
    assert sequence.with_previous(df.limit(0), ["v"], ["ts"]).count() == 0


def test_shift_counts_sum_to_rows_minus_one(spark):
    rng = random.Random(3)
    data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), rng.random(), rng.random(), i % 24) for i in range(300)]
    df = spark.createDataFrame(data, "track_id int, played_at timestamp, valence double, energy double, hour_of_day int")
    assert sequence.shift_patterns(df).agg(F.sum("shift_count")).first()[0] == 299


def test_transition_gap_hours(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, t, 0.9, 0.9), (2, t + dt.timedelta(hours=2), 0.1, 0.1), (3, t + dt.timedelta(hours=3), 0.9, 0.9)]
    df = spark.createDataFrame(data, "track_id int, played_at timestamp, valence double, energy double")
    assert rows(sequence.state_transitions(df), "from_mood", "transition_count", "avg_time_between_hours") == [
        ("High_Energy_Positive", 1, 2.0),
        ("Low_Energy_Negative", 1, 1.0),
    ]


# --- anomalies and segments ----------------------------------------------------------------------


def test_constant_group_and_null_key_have_no_anomalies(spark):
    data = [(1, 0.5, 0.1)] * 30 + [(2, 0.5, 0.1)] * 30 + [(2, 0.5, 9.0), (None, 9.0, 9.0), (3, 7.0, 7.0)]
    df = spark.createDataFrame(data, "hour_of_day int, valence double, energy double")
    found = anomaly.anomaly_summary(df)
    assert rows(found, "hour_of_day", "anomaly_count", "anomaly_severity") == [(2, 1, "High")]
    assert found.first().avg_valence_deviation is None


def test_severe_anomalies_come_first(spark):
    data = [(1, float(i % 2), 0.0) for i in range(40)] + [(1, 2.7, 0.0)]
    data += [(2, float(i % 2), 0.0) for i in range(400)] + [(2, 50.0, 0.0)]
    df = spark.createDataFrame(data, "hour_of_day int, valence double, energy double")
    assert [r.anomaly_severity for r in anomaly.anomaly_summary(df).collect()][0] == "High"


def test_segment_edges(spark):
    df = spark.createDataFrame([("a", 0.6, 0.6), ("b", 0.1, 0.1), ("c", 0.0, 0.5), ("c", 1.0, 0.5)], "u string, valence double, energy double")
    df = df.selectExpr("*", "valence AS danceability", "valence AS acousticness")
    found = {r.u: (r.listening_archetype, r.wellbeing_recommendation.split()[0], r.mood_variability) for r in segment.behavior_segment(df, ["u"]).collect()}
    assert found == {
        "a": ("Energetic Optimist", "Healthy", None),
        "b": ("Contemplative Thinker", "Lower", None),
        "c": ("Balanced Explorer", "High", 0.707),
    }


# --- scores --------------------------------------------------------------------------------------


def test_scores_match_the_library_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    df = spark.range(500).selectExpr(
        "CAST(id % 5 AS DOUBLE) AS label", "CAST((id * id) % 5 AS DOUBLE) AS prediction", "id / 500D AS y", "(id % 37) / 37D AS guess"
    )
    ours = metrics.classification_metrics(df, "label").first()
    for name in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert ours[name] == pytest.approx(theirs.evaluate(df))
    ours = metrics.regression_metrics(df, "y", "guess").first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="guess", metricName=name)
        assert ours[name] == pytest.approx(theirs.evaluate(df))


def test_baselines_match_the_library_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    df = spark.range(100).selectExpr("CAST(if(id < 60, 2, id % 2) AS INT) AS label", "id / 100D AS y")
    constant = df.withColumn("prediction", F.lit(2.0))
    base = metrics.baseline_classification(df, "label").first()
    for name in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert base[name] == pytest.approx(theirs.evaluate(constant))
    mean = df.withColumn("prediction", F.lit(df.agg(F.avg("y")).first()[0]))
    base = metrics.baseline_regression(df, "y").first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=name)
        assert base[name] == pytest.approx(theirs.evaluate(mean), abs=1e-12)
    assert metrics.baseline_regression(df, "y", train=df.where("id < 0 OR y > 0.5")).first().r2 < 0


def test_tied_majority_takes_the_lowest_class(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,)], "label int")
    assert metrics.baseline_classification(df, "label").first().majority_class == 1


def test_classes_seen_on_one_side_only(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 7.0), (1, 0.0)], "label int, prediction double")
    found = {r["class"]: (r.class_name, r.precision, r.recall, r.f1, r.support) for r in metrics.per_class_metrics(df, "label", names={0: "zero"}).collect()}
    assert found == {0: ("zero", 0.5, 0.5, 0.5, 2), 1: ("Class_1", 0.0, 0.0, 0.0, 1), 7: ("Class_7", 0.0, 0.0, 0.0, 0)}
