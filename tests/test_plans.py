"""Physical plans: what is read, what is shuffled, what is never used."""

import re

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F
from tidemark.operators import anomaly, enrich, profiles, ranking, rollup, sequence
from tidemark.plans import bindings, cases
from tidemark.session import scratch_path
from tidemark.sources import sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


# Fitting runs jobs while the query is built, and takes long.
FITTED = {
    "predict_regression", "predict_linear", "predict_class", "model_metrics", "cv_metrics", "feature_importance",
    "cv_linear", "forest_class_decided", "forest_value_decided", "importance_decided", "clusters_decided", "elbow_table", "cluster_stability", "cluster_profiles", "cluster_embeddings", "sql_pred_error", "sql_metrics",
}


def test_no_python_rows_cross_joins_or_whole_table_windows(spark):
    for name, query in cases.QUERIES.items():
        if name in FITTED:
            continue
        text = plan(query(spark, SF))
        for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)
        # The only window without partition keys runs over the one row per time bucket of with_previous.
        for window in re.findall(r"Window \[.*", text):
            if re.search(r"windowspecdefinition\(_bucket", window):
                continue
            # an order column is followed by ASC or DESC, a partition key by a comma
            assert re.search(r"windowspecdefinition\(\w+#\d+L?, ", window), (name, window)


def test_scan_reads_only_needed_columns(spark):
    text = plan(profiles.hourly_profile(bindings.plays(spark, SF)))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"event_id", "ts", "value", "props"}
    text = plan(cases.QUERIES["sql_row_count"](spark, SF))
    assert "ReadSchema: struct<>" in text


def test_time_filter_reaches_the_scan(spark):
    week = plan(cases.QUERIES["sql_trailing_7d"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(played_at", week) and re.search(r"PartitionFilters: \[[^\]]*date", week)
    pushed = plan(enrich.range_clean(bindings.table(spark, SF, "lineitem"), {"l_quantity": (1, 10), "l_tax": (0, 1)}))
    assert "GreaterThanOrEqual(l_quantity" in pushed and "LessThanOrEqual(l_tax" in pushed


def test_date_filter_prunes_partitions(spark):
    path = scratch_path(spark, "dated")
    dated = bindings.history(spark, SF).withColumn("date", F.to_date("played_at"))
    sinks.write_table(dated, path, partition_by=["date"])
    text = plan(spark.read.parquet(path).where("date >= date'2024-01-25'"))
    assert re.search(r"PartitionFilters: \[[^\]]*date", text)


def test_one_aggregate_replaces_a_loop_of_jobs(spark):
    plays = bindings.plays(spark, SF)
    for frame in (profiles.feature_profile(plays), profiles.pairwise_corr(plays)):
        assert plan(frame).count("FileScan") == 1
    assert plan(ranking.rule_playlists(plays)).count("FileScan") == 1


def test_correlations_do_not_multiply_rows(spark):
    text = plan(profiles.pairwise_corr(bindings.plays(spark, SF)))
    # pairs are unfolded from the summaries, above the aggregate, not from the rows below it
    below = text[text.rindex("partial_covar_pop") :]
    assert "Generate" not in below and "FileScan" in below


def test_rank_limit_cuts_before_the_shuffle(spark):
    text = plan(cases.QUERIES["top_n_per_group"](spark, SF))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_ranks_of_a_hot_group_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(40000).selectExpr("'hot' AS g", "id", "id % 1000 AS v")
        ranked = ranking.global_ranks(rows, "g", [F.desc("v"), F.asc("id")], 5000)
        tasks = ranked.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n"))
        sizes = [r.n for r in tasks.collect()]
        ranks = ranking.global_ranks(rows, "g", [F.desc("v"), F.asc("id")])
        full = [r["count"] for r in ranks.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 5000
    # no task ranks much more than its share of the one group
    assert sum(full) == 40000 and max(full) < 40000 / 2
    assert re.search(r"windowspecdefinition\(g#\d+, _slice#\d+", plan(ranked))


def test_five_gold_tables_read_one_rollup_not_the_events(spark):
    path = scratch_path(spark, "rollup")
    sinks.write_table(rollup.roll_up(rollup.with_date(bindings.plays(spark, SF))), path, partition_by=["date"])
    text = plan(profiles.daily_trends(spark.read.parquet(path).where("date >= date'2024-01-25'"), ts=None, profile=rollup.rolled_profile))
    assert text.count("FileScan") == 1 and re.search(r"PartitionFilters: \[[^\]]*date", text)


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(cases.QUERIES["top_k"](spark, SF))


@pytest.mark.parametrize("by", [[], ["track_id"]])
def test_previous_row_needs_one_shuffle_of_the_rows_and_no_checkpoint(spark, by):
    plays = bindings.plays(spark, SF).select("track_id", "played_at", "event_id", "valence")
    text = plan(sequence.with_previous(plays, ["valence"], ["played_at", "event_id"], by))
    assert "ExistingRDD" not in text and "rangepartitioning" not in text and "Join" not in text
    # from the lag's window down to the union there is one shuffle; the other ones belong to the last rows
    first, rest = text.split("Union", 1)
    assert first.count("Exchange") == 1
    assert rest.count("Exchange") == 2 and "partial_max" in rest


def test_share_of_total_reuses_its_shuffle(spark):
    assert "ReusedExchange" in final_plan(profiles.share_of_total(bindings.plays(spark, SF), "label"))


def test_tables_in_the_same_buckets_join_in_place(spark):
    events, attributes = bindings.stored_in_buckets(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.attach_stored(events, attributes)
        text = final_plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == bindings.history(spark, SF).count()
    with pytest.raises(ValueError, match="already have"):
        enrich.attach_stored(events.withColumn("energy", F.lit(1)), attributes)


def test_only_bounded_baselines_are_broadcast(spark):
    plays = bindings.plays(spark, SF)
    assert "BroadcastHashJoin" in plan(anomaly.with_baseline(plays, ["hour_of_day"], ["valence"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(anomaly.with_baseline(plays, ["track_id"], ["valence"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


@pytest.fixture
def big_data_settings(spark):
    """Thresholds scaled down so that the test rows count as a large, skewed table."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def _hot_events(spark):
    """A third of the rows share one key."""
    return spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS track_id", "CAST(id % 3 AS DOUBLE) AS valence", "md5(CAST(id AS STRING)) AS body"
    ).repartition(8)


def test_hot_key_of_the_attribute_join_is_split(spark, big_data_settings):
    sources = {"s": spark.range(30000).selectExpr("CAST(id AS STRING) AS track_id", "1.0F AS danceability")}
    joined = enrich.attach_attributes(_hot_events(spark), sources)
    rows = joined.groupBy("feature_source").count()
    assert {r[0]: r[1] for r in rows.collect()} == {"unknown": 10000, "s": 20000}
    assert "skew=true" in final_plan(joined)


def test_hot_key_of_the_baseline_join_is_split(spark, big_data_settings):
    scored = anomaly.with_baseline(_hot_events(spark), ["track_id"], ["valence"])
    assert "skew=true" in final_plan(scored)
    assert scored.count() == 30000


def test_hot_key_of_the_anti_join_is_split(spark, big_data_settings):
    stored = spark.range(100).selectExpr("CAST(id AS STRING) AS track_id")
    fresh = enrich.new_rows(_hot_events(spark), stored, ["track_id"])
    assert "skew=true" in final_plan(fresh)


def test_copies_are_merged_before_the_shuffle(spark):
    text = plan(enrich.one_per_key(_hot_events(spark), ["track_id"]))
    assert "partial_max(" in text


def test_partitioned_write_is_rebalanced(spark):
    dated = bindings.history(spark, SF).withColumn("date", F.to_date("played_at"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(dated.hint("rebalance", F.col("date")))


def test_entry_has_a_stable_schema(spark):
    frame = entry.entry(spark)
    assert frame.columns[:2] == ["hour_of_day", "anomaly_count"] and frame.count() > 0
