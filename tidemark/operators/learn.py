"""Supervised models with baselines and cross-validation, and the clustering study."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as words
from ..functions.buckets import ladder, lookup, quadrant
from ..functions.hashing import digest, pick
from ..functions.numeric import double, literal, min_max_scale, stable_round
from ..schemas import schema
from . import forest, ridge
from .metrics import (
    baseline_classification,
    baseline_regression,
    classification_metrics,
    regression_metrics,
)
from .profiles import grouped_profile

SEED = 42
FOLDS = 3
SCALED = "scaled_features"


def prepare_stages(features: Sequence[str], output: str = SCALED) -> list[Estimator]:
    """Assemble the columns into a vector and divide each by its standard deviation (no centring)."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="features")
    return [assembled, StandardScaler(inputCol="features", outputCol=output)]


# Size and depth of the forests.
FOREST = forest.Shape(trees=30, depth=8, least=10, seed=SEED)


@dataclass(frozen=True)
class ModelSpec:
    name: str
    kind: str
    target: str
    features: tuple[str, ...]
    output: tuple[str, ...]
    predicted_as: str
    classifier: bool = False
    # Penalty of a linear model, which is solved from co-moments; other models are forests.
    ridge: float | None = None


# Inputs, targets and hyper-parameters of the three models.
VALENCE_FOREST = ModelSpec(
    name="mood_prediction",
    kind="RandomForestRegressor",
    target="valence",
    features=("hour_of_day", "day_of_week", "energy", "tempo", "danceability", "is_weekend_int"),
    output=("hour_of_day", "day_of_week", "valence", "predicted_valence", "energy", "tempo"),
    predicted_as="predicted_valence",
)
ENERGY_LINEAR = ModelSpec(
    name="energy_forecast",
    kind="LinearRegression",
    target="energy",
    features=("hour_of_day", "day_of_week", "tempo", "danceability", "acousticness"),
    ridge=0.01,
    output=("hour_of_day", "day_of_week", "energy", "predicted_energy", "tempo", "danceability"),
    predicted_as="predicted_energy",
)
MOOD_FOREST = ModelSpec(
    name="mood_classifier",
    kind="RandomForestClassifier",
    target="mood_label",
    features=("hour_of_day", "day_of_week", "tempo", "danceability", "acousticness", "instrumentalness"),
    output=("hour_of_day", "day_of_week", "mood_label", "predicted_mood_label"),
    predicted_as="predicted_mood_label",
    classifier=True,
)
MODELS = (VALENCE_FOREST, ENERGY_LINEAR, MOOD_FOREST)


@dataclass(frozen=True)
class ModelRun:
    spec: ModelSpec
    model: forest.Forest | ridge.LinearModel
    scored: DataFrame
    cv_metric: float
    train: DataFrame

    @property
    def predictions(self) -> DataFrame:
        return self.scored.withColumnRenamed("prediction", self.spec.predicted_as).select(*self.spec.output)


def with_mood_label(df: DataFrame) -> DataFrame:
    """Integer class from valence and energy; both stay out of the classifier's features."""
    return df.withColumn("mood_label", F.expr(quadrant("valence", "energy", words.MOOD_CODE)))


def model_frame(df: DataFrame, spec: ModelSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Only the columns the model needs, without rows that lack one."""
    if spec.classifier and spec.target not in df.columns:
        df = with_mood_label(df)
    if "is_weekend_int" in spec.features and "is_weekend_int" not in df.columns:
        weekend = "coalesce(CAST(is_weekend AS INT), 0)" if "is_weekend" in df.columns else "0"
        df = df.withColumn("is_weekend_int", F.expr(weekend))
    needed = list(dict.fromkeys([*spec.features, spec.target, *[c for c in spec.output if c != spec.predicted_as]]))
    return df.selectExpr(*needed, *extra).na.drop(subset=[*spec.features, spec.target])


def fold_of(key: str, folds: int = FOLDS) -> str:
    """Fold number from the key's digest: the same rows are together on any partitioning and in any engine."""
    return pick(digest(key, "fold"), range(folds))


def cross_validate(
    spec: ModelSpec, train: DataFrame, key: str, folds: int = FOLDS, partitions: int | None = None
) -> tuple[float, forest.Forest | ridge.LinearModel]:
    """Mean metric over the folds (accuracy or RMSE), and the model fitted on all training rows.

    ``partitions`` spreads the binned rows of a forest; use it when the input has fewer splits than the cluster has
    cores. A linear model needs one aggregate over the rows, wherever they are.
    """
    fold = f"{fold_of(key, folds)} AS _fold"
    if spec.ridge is not None:
        return ridge.cross_validate(model_frame(train, spec, [fold]), spec.features, spec.target, "_fold", spec.ridge)
    rows = model_frame(train, spec, [fold, f"{key} AS _key"])
    return forest.cross_validate(rows, spec.features, spec.target, "_fold", folds, FOREST, spec.classifier, partitions)


def train_and_score(
    spec: ModelSpec, train: DataFrame, test: DataFrame, key: str, partitions: int | None = None
) -> ModelRun:
    metric, model = cross_validate(spec, train, key, partitions=partitions)
    return ModelRun(spec, model, model.transform(model_frame(test, spec)), metric, model_frame(train, spec))


def run_metrics(run: ModelRun, stored: DataFrame | None = None) -> DataFrame:
    """Long metrics rows of one model: test, cross-validation, baseline and sizes.

    Pass the ``stored`` predictions if they have been written: reading them back is cheaper than scoring
    the test rows again.
    """
    spec = run.spec
    scored = run.scored if stored is None else stored.withColumnRenamed(spec.predicted_as, "prediction")
    if spec.classifier:
        test = classification_metrics(scored, spec.target)
        base = baseline_classification(scored, spec.target)
        cv_name, base_names = "cv_accuracy", ("accuracy", "f1")
    else:
        test = regression_metrics(scored, spec.target)
        base = baseline_regression(scored, spec.target)
        cv_name, base_names = "cv_rmse", ("rmse", "r2")

    def unfold(df: DataFrame, names: Iterable[str], prefix: str) -> DataFrame:
        cells = [f"named_struct('metric', '{prefix}{n}', 'value', {double(n)})" for n in names]
        return df.selectExpr(f"inline(array({', '.join(cells)}))")

    def size(df: DataFrame, name: str) -> DataFrame:
        return unfold(df.agg(F.count("*").alias(name)), [name], "")

    parts = [
        unfold(test, test.columns, "test_"),
        run.scored.sparkSession.createDataFrame([(cv_name, float(run.cv_metric))], "metric string, value double"),
        unfold(base, base_names, "baseline_"),
        size(run.train, "train_size"),
        size(scored, "test_size"),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.selectExpr(
        f"{literal(spec.name)} AS model_name", f"{literal(spec.kind)} AS model_type", "metric", "value"
    )


def model_metrics(runs: Sequence[ModelRun], stored: Sequence[DataFrame | None] | None = None) -> DataFrame:
    """Metrics of all models in one long table with a fixed schema."""
    parts = [run_metrics(run, frame) for run, frame in zip(runs, stored or [None] * len(runs))]
    rows = reduce(DataFrame.unionByName, parts)
    assert rows.columns == schema("model_metrics").names
    return rows


WIDE_METRICS = (
    "test_rmse", "test_mae", "test_r2", "test_accuracy", "test_f1", "cv_rmse", "cv_accuracy",
    "baseline_rmse", "baseline_r2", "baseline_accuracy", "baseline_f1", "train_size", "test_size",
)


def wide_metrics(long: DataFrame, approach: str = "Kaggle_to_User_with_CrossVal") -> DataFrame:
    """One row per model; metrics a model does not have are NULL."""
    wide = long.groupBy("model_name", "model_type").pivot("metric", list(WIDE_METRICS)).agg(F.first("value"))
    return wide.withColumn("training_approach", F.lit(approach))


def feature_importance(run: ModelRun) -> DataFrame:
    """Importance and rank of each feature of a forest; no rows for other models."""
    weights = getattr(run.model, "importances", ())
    rows = [(f, float(w)) for f, w in zip(run.spec.features, weights)]
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
    spark = run.scored.sparkSession
    return spark.createDataFrame(
        [(f, w, i) for i, (f, w) in enumerate(ranked, 1)], "feature string, importance double, rank int"
    )


# --- clustering ----------------------------------------------------------------------------------

CLUSTER_MEASURES = (
    "valence", "energy", "danceability", "acousticness", "instrumentalness", "tempo", "loudness",
)
# Bounds used to bring tempo and loudness to the scale of the other measures.
CLUSTER_SCALES = {"tempo": (60.0, 180.0), "loudness": (-60.0, 0.0)}
MAX_ITER = 20
# Fewest points worth a task of their own in the many short passes over them.
POINTS_PER_TASK = 50_000


@dataclass(frozen=True)
class ClusterInput:
    """``rows``: every complete row with its scaled vector. ``points``: each different row once, weighted by its count.

    Fitting on the points costs passes over the different rows only (one per track, where a track's
    measures are fixed) and has the same objective as fitting on all rows.
    """

    rows: DataFrame
    points: DataFrame


def cluster_input(df: DataFrame, measures: Sequence[str] = CLUSTER_MEASURES) -> ClusterInput:
    complete = df.selectExpr(*[f"{double(m)} AS {m}" for m in measures]).na.drop()
    inputs = [f"{m}_normalized" if m in CLUSTER_SCALES else m for m in measures]
    normalized = complete.selectExpr(
        "*", *[f"{min_max_scale(m, *CLUSTER_SCALES[m])} AS {m}_normalized" for m in measures if m in CLUSTER_SCALES]
    )
    scaler = Pipeline(stages=prepare_stages(inputs)).fit(normalized)
    different = normalized.groupBy(*normalized.columns).agg(F.expr("CAST(count(*) AS DOUBLE) AS weight"))
    return ClusterInput(
        scaler.transform(normalized).select(*measures, SCALED), scaler.transform(different).select(SCALED, "weight")
    )


def in_few_tasks(points: DataFrame, size: int) -> DataFrame:
    """The same points in no more tasks than keep the cores busy.

    The aggregate that finds the different rows leaves them in ``spark.sql.shuffle.partitions`` parts, and every pass
    of every fit would start that many tasks twice. This is also a plan of its own over the stored points: the fit
    keeps its own vectors, instead of decoding the stored rows again on each pass.
    """
    tasks = max(2 * points.sparkSession.sparkContext.defaultParallelism, -(-size // POINTS_PER_TASK))
    # Merging deals parts to tasks anew even where there are few, and the seeding of the centres follows the parts.
    return points.coalesce(tasks) if points.rdd.getNumPartitions() > tasks else points.select("*")


def fit_kmeans(points: DataFrame, k: int, seed: int = SEED):
    """K-means with parallel seeding. Among few different points it may end up with fewer than k centres."""
    estimator = KMeans(featuresCol=SCALED, predictionCol="cluster", k=k, seed=seed, maxIter=MAX_ITER)
    if "weight" in points.columns:
        estimator = estimator.setWeightCol("weight")
    return estimator.fit(points)


def silhouette(clustered: DataFrame, centres: int) -> float | None:
    """Mean silhouette; undefined for a single centre."""
    if centres < 2:
        return None
    judge = ClusteringEvaluator(featuresCol=SCALED, predictionCol="cluster", metricName="silhouette")
    if "weight" in clustered.columns:
        judge = judge.setWeightCol("weight")
    return judge.evaluate(clustered)


def elbow_table(points: DataFrame, ks: Sequence[int] = range(2, 9)) -> DataFrame:
    """Cost and silhouette for each k, and the second difference of the cost whose maximum is the elbow.

    There is a row for every k; with more clusters than points its cost and silhouette are NULL.
    """
    size = points.count()
    points = in_few_tasks(points, size)
    rows = []
    for k in ks:
        if k > size:
            rows.append((k, None, None))
            continue
        model = fit_kmeans(points, k)
        rows.append((k, float(model.summary.trainingCost), silhouette(model.transform(points), len(model.clusterCenters()))))
    table = points.sparkSession.createDataFrame(rows, "k int, wcss double, silhouette double")
    by_k = Window.orderBy("k")
    bend = F.lag("wcss").over(by_k) - 2 * F.col("wcss") + F.lead("wcss").over(by_k)
    return table.withColumn("second_diff", bend)


def choose_k(elbow: DataFrame) -> DataFrame:
    """k at the elbow (the middle k if there are too few) and k with the best silhouette."""
    at_elbow = F.max_by("k", F.struct("second_diff", -F.col("k"))).alias("at_elbow")
    middle = F.element_at(F.sort_array(F.collect_list("k")), (F.count("*") / 2).cast("int") + 1)
    return elbow.agg(
        F.coalesce(F.when(F.count("second_diff") > 0, at_elbow), middle).alias("optimal_k_elbow"),
        F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("optimal_k_silhouette"),
    )


def cluster_stability(points: DataFrame, k: int, runs: int = 3) -> DataFrame:
    """Silhouette over several seeds: mean, population deviation and a verdict."""
    points = in_few_tasks(points, points.count())
    models = [(SEED + i, fit_kmeans(points, k, SEED + i)) for i in range(runs)]
    scores = [(seed, silhouette(model.transform(points), len(model.clusterCenters()))) for seed, model in models]
    table = points.sparkSession.createDataFrame(scores, "seed int, silhouette double")
    spread = table.agg(F.avg("silhouette").alias("mean_silhouette"), F.stddev_pop("silhouette").alias("std_silhouette"))
    verdict = ladder("std_silhouette", list(zip((0.05, 0.10), words.STABILITY)), words.STABILITY[-1])
    return spread.selectExpr(
        f"{k} AS k",
        "mean_silhouette",
        "std_silhouette",
        "std_silhouette < 0.10 AS is_stable",
        f"{verdict} AS stability",
    )


def cluster_profiles(data: ClusterInput, k: int, measures: Sequence[str] = CLUSTER_MEASURES[:5]) -> DataFrame:
    """Size, means, variability and name of each cluster; clusters are numbered by their centres."""
    points = data.points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_kmeans(in_few_tasks(points, points.count()), k)
    finally:
        points.unpersist()
    clustered = model.transform(data.rows)
    spreads = {"valence": "valence_variability", "energy": "energy_variability"}
    exact = grouped_profile(
        clustered, ["cluster"], [], count_as="member_count",
        extra=[f"avg({m}) AS avg_{m}" for m in measures]
        + [f"stddev_samp({m}) AS {name}" for m, name in spreads.items()],
    )
    # Numbering k rows, one per cluster.
    order = Window.orderBy("avg_valence", "avg_energy", "cluster")
    named = exact.withColumn("mood_state_name", F.expr(quadrant("avg_valence", "avg_energy", words.CLUSTER_NAME)))
    numbered = named.withColumn("cluster", F.row_number().over(order) - 1)
    rounded = [f"avg_{m}" for m in measures] + list(spreads.values())
    return numbered.selectExpr(
        "cluster",
        "member_count",
        *[f"{stable_round(c, 3)} AS {c}" for c in rounded],
        "mood_state_name",
        f"{lookup('mood_state_name', words.CLUSTER_TEXT, words.CLUSTER_TEXT_DEFAULT)} AS cluster_description",
    ).orderBy("cluster")


@dataclass(frozen=True)
class ClusterStudy:
    profiles: DataFrame
    elbow: DataFrame
    stability: DataFrame
    k: int


def cluster_study(df: DataFrame, ks: Sequence[int] = range(2, 9), runs: int = 3) -> ClusterStudy:
    """Choose k by silhouette, check its stability, and profile the final clusters."""
    data = cluster_input(df)
    points = data.points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        elbow = elbow_table(points, ks)
        k = choose_k(elbow).first()["optimal_k_silhouette"]
        stability = cluster_stability(points, k, runs)
        return ClusterStudy(cluster_profiles(data, k), elbow, stability, k)
    finally:
        points.unpersist()
