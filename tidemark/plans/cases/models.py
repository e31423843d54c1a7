"""Model arithmetic with oracles, and fitted models (checked by their row counts here, by value in the tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import vocabulary as words
from ...functions.buckets import quadrant
from ...functions.numeric import round_columns
from ...operators import learn, metrics
from ...operators.enrich import training_rows
from ..bindings import catalog, plays, table
from .columns import CLEAN, TIMED
from .registry import CATALOG, PLAYS, digest, hex_block, over_plays, quad, query, rnd

DIGITS = 6


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return round_columns(df, {n: DIGITS for n in names})


def _sql(**columns: str) -> str:
    return ", ".join(f"{rnd(expression, DIGITS)} AS {name}" for name, expression in columns.items())


# --- scores --------------------------------------------------------------------------------------

_GUESS = "valence * 0.5e0 + danceability * 0.5e0"


@query(
    "regression_metrics",
    over_plays(
        "SELECT "
        + _sql(rmse="sqrt(avg(d * d))", mae="avg(abs(d))", r2="1 - avg(d * d) / nullif(var_pop(energy), 0)")
        + f" FROM (SELECT *, energy - ({_GUESS}) AS d FROM plays)"
    ),
)
def regression_metrics(spark, sf):
    scores = metrics.regression_metrics(plays(spark, sf), "energy", "valence * 0.5D + danceability * 0.5D")
    return _rounded(scores, "rmse", "mae", "r2")


@query(
    "baseline_regression",
    over_plays(
        "SELECT "
        + _sql(rmse="stddev_pop(energy)", mae="avg(abs(energy - m))", r2="0e0")
        + ", 'mean_predictor' AS method FROM plays, (SELECT avg(energy) AS m FROM plays)"
    ),
)
def baseline_regression(spark, sf):
    return _rounded(metrics.baseline_regression(plays(spark, sf), "energy"), "rmse", "mae", "r2")


# A made-up classifier that looks at other measures: it is right on some rows and wrong on others.
_LABELLED = f"""labelled AS (SELECT {quad('valence', 'energy', words.MOOD_CODE)} AS mood_label,
    CAST({quad('valence', 'danceability', words.MOOD_CODE)} AS DOUBLE) AS prediction FROM plays)"""
_TOTALS = """totals AS (
  SELECT class, CAST(sum(support) AS DOUBLE) AS support, CAST(sum(guessed) AS DOUBLE) AS guessed, CAST(sum(hits) AS DOUBLE) AS hits FROM (
    SELECT mood_label AS class, 1 AS support, 0 AS guessed, CAST(mood_label = prediction AS INT) AS hits FROM labelled
    UNION ALL SELECT CAST(prediction AS INT), 0, 1, 0 FROM labelled) GROUP BY 1)"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return plays(spark, sf).selectExpr(
        f"{quadrant('valence', 'energy', words.MOOD_CODE)} AS mood_label",
        f"CAST({quadrant('valence', 'danceability', words.MOOD_CODE)} AS DOUBLE) AS prediction",
    )


@query(
    "confusion_matrix",
    over_plays(
        f""", {_LABELLED} SELECT mood_label AS actual, CAST(prediction AS INT) AS predicted, count(*) AS count
            FROM labelled GROUP BY 1, 2"""
    ),
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_labelled(spark, sf), "mood_label")


@query(
    "per_class_metrics",
    over_plays(
        f""", {_LABELLED}, {_TOTALS}, scored AS (
              SELECT class, coalesce(hits / nullif(guessed, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r,
                     CAST(support AS BIGINT) AS support FROM totals)
            SELECT class, list_extract(['Happy_Energetic', 'Happy_Calm', 'Sad_Energetic', 'Sad_Calm', 'Neutral'],
                     class + 1) AS class_name, {_sql(precision='p', recall='r')},
                   {rnd('coalesce(2 * p * r / nullif(p + r, 0), 0)', DIGITS)} AS f1, support FROM scored"""
    ),
)
def per_class_metrics(spark, sf):
    scores = metrics.per_class_metrics(_labelled(spark, sf), "mood_label", names=dict(enumerate(words.MOOD)))
    return _rounded(scores, "precision", "recall", "f1")


@query(
    "classification_metrics",
    over_plays(
        f""", {_LABELLED}, {_TOTALS} SELECT {_sql(accuracy='sum(hits) / sum(support)',
            f1='sum(support * 2 * hits / (guessed + support)) / sum(support)')} FROM totals"""
    ),
)
def classification_metrics(spark, sf):
    return _rounded(metrics.classification_metrics(_labelled(spark, sf), "mood_label"), "accuracy", "f1")


@query(
    "classification_metrics_labels",
    f"""WITH totals AS (
          SELECT class, CAST(sum(support) AS DOUBLE) AS support, CAST(sum(guessed) AS DOUBLE) AS guessed,
                 CAST(sum(hits) AS DOUBLE) AS hits FROM (
            SELECT quality AS class, 1 AS support, 0 AS guessed, CAST(quality <> toxic AS INT) AS hits FROM labels
            UNION ALL SELECT 1 - toxic, 0, 1, 0 FROM labels) GROUP BY 1)
        SELECT {_sql(accuracy='sum(hits) / sum(support)',
            f1='sum(support * 2 * hits / (guessed + support)) / sum(support)')} FROM totals""",
)
def classification_metrics_labels(spark, sf):
    guessed = table(spark, sf, "labels").withColumn("prediction", 1 - F.col("toxic"))
    return _rounded(metrics.classification_metrics(guessed, "quality"), "accuracy", "f1")


@query(
    "baseline_classification",
    over_plays(
        f""", {_LABELLED}, counts AS (SELECT mood_label, count(*) AS n FROM labelled GROUP BY 1),
            best AS (SELECT mood_label AS majority_class, n / (SELECT sum(n) FROM counts) AS a FROM counts
                     ORDER BY n DESC, mood_label LIMIT 1)
            SELECT {_sql(accuracy='a', f1='a * 2 * a / (a + 1)')}, majority_class, 'majority_class' AS method FROM best"""
    ),
)
def baseline_classification(spark, sf):
    return _rounded(metrics.baseline_classification(_labelled(spark, sf), "mood_label"), "accuracy", "f1")


# --- fitted models -------------------------------------------------------------------------------


def fit(spark: SparkSession, sf: str, spec: learn.ModelSpec) -> learn.ModelRun:
    """Train on the catalog, score the plays."""
    train = training_rows(catalog(spark, sf), "track_id")
    # The test files are single row groups, that is, single splits.
    cores = spark.sparkContext.defaultParallelism
    return learn.train_and_score(spec, train, plays(spark, sf), key="track_id", partitions=cores)


@query("predict_regression")
def predict_regression(spark, sf):
    return fit(spark, sf, learn.VALENCE_FOREST).predictions


# --- the linear model, solved again by elimination ------------------------------------------------

_INPUTS = ("hour_of_day", "day_of_week", "tempo", "danceability", "acousticness")
_PENALTY = "0.01e0"


def _fits() -> str:
    """Weights and intercept of the fit without fold f (0 to 2), and of the one on all rows (f = 3)."""
    n = len(_INPUTS)
    columns = [f"x{i}" for i in range(n)] + ["y"]
    means = ", ".join(f"avg({c}) AS m_{c}" for c in columns)
    spreads = ", ".join(f"covar_pop({a}, {b}) AS c_{a}_{b}" for i, a in enumerate(columns) for b in columns[i:])
    cells = [
        f"c_x{min(i, j)}_x{max(i, j)} / sqrt(c_x{i}_x{i} * c_x{j}_x{j}){f' + {_PENALTY} / sqrt(c_y_y)' if i == j else ''} AS a{i}_{j}"
        for i in range(n)
        for j in range(n)
    ]
    sides = [f"c_x{i}_y / sqrt(c_x{i}_x{i} * c_y_y) AS b{i}" for i in range(n)]
    steps = [f"e0 AS (SELECT *, {', '.join(cells + sides)} FROM sums)"]
    for k in range(n - 1):
        below = [
            part
            for i in range(k + 1, n)
            for part in (*[f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}" for j in range(k, n)], f"b{i} - a{i}_{k} / a{k}_{k} * b{k} AS b{i}")
        ]
        steps.append(f"e{k + 1} AS (SELECT * REPLACE ({', '.join(below)}) FROM e{k})")
    last = f"e{n - 1}"
    for k in reversed(range(n)):
        known = "".join(f" - a{k}_{j} * w{j}" for j in range(k + 1, n))
        steps.append(f"s{k} AS (SELECT *, (b{k}{known}) / a{k}_{k} AS w{k} FROM {last})")
        last = f"s{k}"
    weights = [f"w{i} * sqrt(c_y_y / c_x{i}_x{i}) AS v{i}" for i in range(n)]
    steps.append(f"v AS (SELECT *, {', '.join(weights)} FROM {last})")
    steps.append(f"fits AS (SELECT *, m_y - ({' + '.join(f'v{i} * m_x{i}' for i in range(n))}) AS v FROM v)")
    inputs = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(_INPUTS))
    return f"""train AS (SELECT {inputs}, energy AS y, {hex_block(digest('track_id', 'fold'))} % 3 AS fold FROM ({TIMED}) WHERE {CLEAN}),
      sums AS (SELECT f, {means}, {spreads} FROM train, (VALUES (0), (1), (2), (3)) AS t(f) WHERE fold <> f GROUP BY f),
      {', '.join(steps)}"""


LINEAR_FITS = _fits()


def linear_guess(columns=_INPUTS) -> str:
    return " + ".join(["v", *[f"v{i} * {c}" for i, c in enumerate(columns)]])


@query(
    "predict_linear",
    f"""WITH {PLAYS}, {CATALOG}, {LINEAR_FITS}
        SELECT hour_of_day, day_of_week, {_sql(energy='energy', predicted_energy=linear_guess(), tempo='tempo', danceability='danceability')}
        FROM plays, fits WHERE f = 3""",
)
def predict_linear(spark, sf):
    predicted = fit(spark, sf, learn.ENERGY_LINEAR).predictions
    return _rounded(predicted, "energy", "predicted_energy", "tempo", "danceability")


@query(
    "cv_linear",
    f"""WITH {CATALOG}, {LINEAR_FITS}, errors AS (
          SELECT f, sqrt(avg((y - ({linear_guess([f'x{i}' for i in range(len(_INPUTS))])})) ** 2)) AS rmse FROM train JOIN fits ON fold = f GROUP BY f)
        SELECT 'energy_forecast' AS model_name, {rnd('avg(rmse)', DIGITS)} AS cv_rmse, CAST(count(*) AS INT) AS folds FROM errors""",
)
def cv_linear(spark, sf):
    """The mean error of the left-out folds, from the folds' co-moments alone."""
    train = training_rows(catalog(spark, sf), "track_id")
    metric, _ = learn.cross_validate(learn.ENERGY_LINEAR, train, "track_id")
    return _rounded(spark.createDataFrame([("energy_forecast", metric, learn.FOLDS)], "model_name string, cv_rmse double, folds int"), "cv_rmse")


@query("predict_class")
def predict_class(spark, sf):
    return fit(spark, sf, learn.MOOD_FOREST).predictions


@query("model_metrics")
def model_metrics(spark, sf):
    return learn.model_metrics([fit(spark, sf, spec) for spec in learn.MODELS])


@query("cv_metrics")
def cv_metrics(spark, sf):
    train = training_rows(catalog(spark, sf), "track_id")
    cores = spark.sparkContext.defaultParallelism
    scores = [
        (s.name, learn.cross_validate(s, train, "track_id", partitions=cores)[0], learn.FOLDS) for s in learn.MODELS
    ]
    return spark.createDataFrame(scores, "model_name string, cv_metric double, folds int")


@query("feature_importance")
def feature_importance(spark, sf):
    forests = [fit(spark, sf, spec) for spec in (learn.VALENCE_FOREST, learn.MOOD_FOREST)]
    parts = [learn.feature_importance(run).withColumn("model_name", F.lit(run.spec.name)) for run in forests]
    return parts[0].unionByName(parts[1])


# --- fitted models with an exact answer -----------------------------------------------------------

# Events whose danceability follows from their type; nothing else tells types apart.
_KINDS = "(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END)"

_FAR = f"if({_KINDS} > 1, 0.9e0, 0.1e0)"


def _decided(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id", f"{_KINDS} AS mood_label", f"0.1D + 0.2D * {_KINDS} AS danceability", f"0.05D + 0.2D * {_KINDS} AS valence",
        "12 AS hour_of_day", "3 AS day_of_week", "0.5D AS energy", "100D AS tempo", "0.5D AS acousticness",
        "0.5D AS instrumentalness", "0 AS is_weekend_int", "-5D AS loudness",
    )


def _fit_decided(spark: SparkSession, sf: str, spec: learn.ModelSpec, everywhere: bool = False) -> learn.ModelRun:
    rows = _decided(spark, sf)
    for feature in spec.features if everywhere else ():
        rows = rows.withColumn(feature, F.col("mood_label"))
    return learn.train_and_score(spec, rows, rows, "event_id", partitions=spark.sparkContext.defaultParallelism)


@query(
    "forest_class_decided",
    f"SELECT mood_label, CAST(mood_label AS DOUBLE) AS predicted, count(*) AS n FROM (SELECT {_KINDS} AS mood_label FROM events) GROUP BY 1",
)
def forest_class_decided(spark, sf):
    """A class that one feature decides is predicted for every event."""
    found = _fit_decided(spark, sf, learn.MOOD_FOREST).predictions
    return found.groupBy("mood_label", F.col("predicted_mood_label").alias("predicted")).agg(F.count("*").alias("n"))


@query(
    "forest_value_decided",
    f"""SELECT {rnd('v', DIGITS)} AS valence, {rnd('v', DIGITS)} AS predicted, count(*) AS n
        FROM (SELECT 0.05e0 + 0.2e0 * {_KINDS} AS v FROM events) GROUP BY ALL""",
)
def forest_value_decided(spark, sf):
    """A value that every feature decides is predicted for every event, whichever features a tree may look at."""
    found = _rounded(_fit_decided(spark, sf, learn.VALENCE_FOREST, everywhere=True).predictions, "valence", "predicted_valence")
    return found.groupBy("valence", F.col("predicted_valence").alias("predicted")).agg(F.count("*").alias("n"))


@query(
    "importance_decided",
    """SELECT * FROM (VALUES ('mood_prediction', 'danceability'), ('mood_classifier', 'danceability')) t(model_name, feature)
       WHERE (SELECT count(DISTINCT event_type) FROM events) > 1""",
)
def importance_decided(spark, sf):
    """The only feature that any tree can use."""
    parts = []
    for spec in (learn.VALENCE_FOREST, learn.MOOD_FOREST):
        ranked = learn.feature_importance(_fit_decided(spark, sf, spec))
        parts.append(ranked.where("importance > 0").select(F.lit(spec.name).alias("model_name"), "feature"))
    return parts[0].unionByName(parts[1])


@query(
    "clusters_decided",
    f"""SELECT CAST(far AS INT) AS cluster, count(*) AS member_count, {rnd('avg(valence)')} AS avg_valence,
            {rnd('avg(danceability)')} AS avg_danceability
        FROM (SELECT {_KINDS} > 1 AS far, {_FAR} + (event_id % 50) * 0.001e0 AS valence,
              {_FAR} + (event_id % 40) * 0.001e0 AS danceability FROM events) GROUP BY far""",
)
def clusters_decided(spark, sf):
    """Two groups far apart are the clusters, numbered by their mean valence."""
    far = _FAR.replace("e0", "D")
    rows = _decided(spark, sf)
    for feature, modulus in (("valence", 50), ("danceability", 40), ("acousticness", 30)):
        rows = rows.withColumn(feature, F.expr(f"{far.replace(_KINDS, 'mood_label')} + (event_id % {modulus}) * 0.001D"))
    found = learn.cluster_profiles(learn.cluster_input(rows), k=2)
    return found.select("cluster", "member_count", "avg_valence", "avg_danceability")


@query("elbow_table")
def elbow_table(spark, sf):
    points = learn.cluster_input(plays(spark, sf)).points.persist()
    try:
        return learn.elbow_table(points)
    finally:
        points.unpersist()


@query("cluster_stability")
def cluster_stability(spark, sf):
    points = learn.cluster_input(plays(spark, sf)).points.persist()
    try:
        return learn.cluster_stability(points, k=5)
    finally:
        points.unpersist()


@query("cluster_profiles")
def cluster_profiles(spark, sf):
    return learn.cluster_study(plays(spark, sf)).profiles


@query("cluster_embeddings")
def cluster_embeddings(spark, sf):
    """K-means over the embeddings: rows and label mix of each cluster."""
    from pyspark.ml.functions import array_to_vector

    embeddings = table(spark, sf, "embeddings")
    vectors = embeddings.select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias(learn.SCALED))
    clustered = learn.fit_kmeans(vectors, k=10).transform(vectors)
    return clustered.groupBy("cluster").agg(
        F.count("*").alias("member_count"), F.count_distinct("label").alias("label_count")
    )
