"""Fitted models on planted signals."""

import pytest

from pyspark.sql import functions as F
from tidemark.operators import learn, ridge


def planted(spark, n, salt):
    """Valence follows danceability and energy; energy follows tempo."""
    u = lambda i: f"CAST(pmod(xxhash64(id, {salt}, {i}), 10000) AS DOUBLE) / 10000D"
    base = spark.range(n).selectExpr(
        "id", f"{u(1)} AS danceability", f"{u(2)} AS acousticness", f"{u(3)} AS instrumentalness",
        f"60D + 120D * {u(4)} AS tempo", f"{u(5)} AS noise", "CAST(id % 24 AS INT) AS hour_of_day",
        "CAST(1 + id % 7 AS INT) AS day_of_week", "id % 7 IN (0, 6) AS is_weekend",
    )
    energetic = base.withColumn("energy", F.expr("0.8D * (tempo - 60D) / 120D + 0.2D * noise"))
    return energetic.withColumn("valence", F.expr("0.5D * danceability + 0.4D * energy + 0.1D * noise"))


@pytest.fixture(scope="module")
def data(spark):
    return planted(spark, 3000, 1).cache(), planted(spark, 800, 2).cache()


@pytest.fixture(scope="module")
def runs(data):
    train, test = data
    return {spec.name: learn.train_and_score(spec, train, test, "id") for spec in learn.MODELS}


def metrics_of(run):
    return {r.metric: r.value for r in learn.run_metrics(run).collect()}


def test_regressions_beat_the_mean(runs):
    for name in ("mood_prediction", "energy_forecast"):
        m = metrics_of(runs[name])
        assert m["test_rmse"] < 0.5 * m["baseline_rmse"] and m["test_r2"] > 0.7
        assert m["cv_rmse"] == pytest.approx(m["test_rmse"], rel=0.3)
        assert (m["train_size"], m["test_size"]) == (3000, 800)
        assert m["baseline_r2"] == pytest.approx(0, abs=1e-9)


def test_classifier_beats_the_majority(runs):
    m = metrics_of(runs["mood_classifier"])
    assert m["baseline_accuracy"] < m["test_accuracy"] <= 1 and m["baseline_f1"] < m["test_f1"]


def test_predictions_have_the_stored_columns(runs):
    for run in runs.values():
        assert run.predictions.columns == list(run.spec.output) and run.predictions.count() == 800


def test_importance_ranks_the_planted_features(runs):
    found = learn.feature_importance(runs["mood_prediction"]).orderBy("rank").collect()
    assert {found[0].feature, found[1].feature} <= {"danceability", "energy", "tempo"}
    assert sum(r.importance for r in found) == pytest.approx(1)
    assert learn.feature_importance(runs["energy_forecast"]).count() == 0


def test_metrics_tables(runs):
    wide = learn.wide_metrics(learn.model_metrics(list(runs.values())))
    assert wide.count() == 3
    row = wide.where("model_name = 'mood_classifier'").first()
    assert row.test_rmse is None and row.test_accuracy > 0


def test_folds_do_not_depend_on_partitioning(spark, data):
    train, _ = data
    fold = F.expr(learn.fold_of("id")).alias("fold")
    one = {r.id: r.fold for r in train.coalesce(1).select("id", fold).collect()}
    assert one == {r.id: r.fold for r in train.repartition(9).select("id", fold).collect()}
    assert set(one.values()) == {0, 1, 2}


def test_rows_with_missing_features_are_left_out(data):
    _, test = data
    holes = test.withColumn("tempo", F.expr("if(id < 100, NULL, tempo)"))
    assert learn.model_frame(holes, learn.ENERGY_LINEAR).count() == 700


def blobs(spark):
    """Three well separated groups, each row twice or more."""
    return spark.range(600).selectExpr(
        "id % 3 AS g", "CAST(pmod(xxhash64(id % 200), 100) AS DOUBLE) / 5000D AS e"
    ).selectExpr(
        "0.1D + 0.4D * g + e AS valence", "0.1D + 0.4D * g - e AS energy", "0.1D + 0.4D * g AS danceability",
        "0.1D + 0.3D * g + e AS acousticness", "0.7D - 0.3D * g - e AS instrumentalness", "60D + 60D * g AS tempo",
        "-60D + 30D * g AS loudness",
    )


def test_clusters_find_the_groups(spark):
    study = learn.cluster_study(blobs(spark), ks=range(2, 6), runs=2)
    assert study.k == 3
    found = study.profiles.collect()
    assert [(r.cluster, r.member_count) for r in found] == [(0, 200), (1, 200), (2, 200)]
    assert [r.mood_state_name for r in found] == ["Melancholic Reflection", "Balanced Neutral", "Energetic Joy"]
    elbow = {r.k: r for r in study.elbow.collect()}
    assert set(elbow) == {2, 3, 4, 5} and all(-1 <= r.silhouette <= 1 for r in elbow.values())
    assert elbow[2].second_diff is None and elbow[5].second_diff is None
    assert elbow[3].second_diff == pytest.approx(elbow[2].wcss - 2 * elbow[3].wcss + elbow[4].wcss)
    assert tuple(learn.choose_k(study.elbow).first()) == (3, 3)
    assert study.stability.first().is_stable is not None


def test_weighted_points_equal_all_rows(spark):
    data = learn.cluster_input(blobs(spark))
    assert data.points.count() < data.rows.count() == data.points.agg(F.sum("weight")).first()[0]
    by_points, by_rows = learn.fit_kmeans(data.points, 3), learn.fit_kmeans(data.rows, 3)
    assert by_points.summary.trainingCost == pytest.approx(by_rows.summary.trainingCost, rel=1e-6)


def test_too_few_ks_take_the_middle(spark):
    elbow = spark.createDataFrame([(2, 9.0, 0.1, None), (3, 5.0, 0.2, None)], "k int, wcss double, silhouette double, second_diff double")
    assert tuple(learn.choose_k(elbow).first()) == (3, 3)


def test_linear_model_is_the_penalised_fit(spark, data):
    """Against the library's own solver: same penalty, same scaling, same folds."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    spec = learn.ENERGY_LINEAR
    rows = learn.model_frame(data[0], spec, [f"{learn.fold_of('id')} AS _fold"])
    vectors = VectorAssembler(inputCols=list(spec.features), outputCol="features").transform(rows).cache()
    library = LinearRegression(featuresCol="features", labelCol="energy", regParam=0.01, solver="normal")
    metric, model = learn.cross_validate(spec, data[0], "id")
    whole = library.fit(vectors)
    assert model.weights == pytest.approx(whole.coefficients.toArray().tolist(), abs=1e-9)
    assert model.intercept == pytest.approx(whole.intercept, abs=1e-9)
    judge = RegressionEvaluator(labelCol="energy", metricName="rmse")
    errors = [judge.evaluate(library.fit(vectors.where(f"_fold <> {k}")).transform(vectors.where(f"_fold = {k}"))) for k in range(3)]
    assert metric == pytest.approx(sum(errors) / 3, abs=1e-9)


def test_linear_model_of_constants_and_single_fold(spark):
    rows = spark.range(50).selectExpr("0 AS fold", "CAST(id AS DOUBLE) AS a", "3D AS b", "2D * id + 1D AS y", "4D AS z")
    error, model = ridge.cross_validate(rows, ["a", "b"], "y", "fold", 0.0)
    assert error != error and model.weights == pytest.approx((2.0, 0.0)) and model.intercept == pytest.approx(1.0)
    _, flat = ridge.cross_validate(rows, ["a", "b"], "z", "fold", 0.1)
    assert flat.weights == (0.0, 0.0) and flat.intercept == 4.0
    with pytest.raises(ValueError, match="no complete rows"):
        ridge.cross_validate(rows.limit(0), ["a"], "y", "fold", 0.1)


def test_linear_folds_take_one_scan(spark, data, monkeypatch):
    plans = []
    real = ridge.grouped_moments
    monkeypatch.setattr(ridge, "grouped_moments", lambda *a: plans.append(real(*a)) or plans[-1])
    learn.cross_validate(learn.ENERGY_LINEAR, data[0], "id")
    assert len(plans) == 1 and plans[0]._jdf.queryExecution().executedPlan().toString().count("InMemoryTableScan") >= 1


def test_every_fit_of_clusters_takes_few_tasks_and_keeps_its_own_vectors(spark, monkeypatch):
    seen = []
    real = learn.KMeans.fit
    monkeypatch.setattr(learn.KMeans, "fit", lambda self, rows: seen.append(rows) or real(self, rows))
    cores = spark.sparkContext.defaultParallelism
    spread = blobs(spark).repartition(16 * cores)
    data = learn.cluster_input(spread)
    points = data.points.repartition(16 * cores).persist()
    try:
        learn.elbow_table(points, ks=[2, 3])
        learn.cluster_stability(points, 3, runs=2)
        learn.cluster_profiles(learn.ClusterInput(data.rows, points), 3)
        assert len(seen) == 5
        assert all(rows.rdd.getNumPartitions() <= 2 * cores and not rows.storageLevel.useMemory for rows in seen)
    finally:
        points.unpersist()
