"""The forests against the library's, and what they may not depend on."""

import numpy as np
import pytest

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from tests.test_learn import planted
from tidemark.operators import forest, learn

SMALL = forest.Shape(trees=5, depth=4, least=10)


@pytest.fixture(scope="module")
def train(spark):
    return planted(spark, 2000, 3).cache()


def fitted(train, spec, monkeypatch, **args):
    monkeypatch.setattr(learn, "FOREST", SMALL)
    return learn.cross_validate(spec, train, "id", **args)


@pytest.mark.parametrize("spec", [learn.VALENCE_FOREST, learn.MOOD_FOREST])
def test_forests_do_not_depend_on_partitioning(train, spec, monkeypatch):
    one, first = fitted(train.coalesce(1), spec, monkeypatch)
    many, second = fitted(train.repartition(7), spec, monkeypatch, partitions=3)
    assert one == pytest.approx(many, abs=1e-12) and first.importances == pytest.approx(second.importances, abs=1e-9)
    assert (first.feature == second.feature).all() and (first.split == second.split).all()
    assert np.allclose(first.value, second.value, atol=1e-12)


def test_all_folds_grow_in_one_pass_a_level(train, monkeypatch):
    passes = []
    real = forest._level
    monkeypatch.setattr(forest, "_level", lambda *a: passes.append(a) or real(*a))
    fitted(train, learn.MOOD_FOREST, monkeypatch)
    assert 0 < len(passes) <= SMALL.depth


def test_forest_is_as_good_as_the_library(spark, train):
    spec = learn.MOOD_FOREST
    rows = learn.model_frame(train, spec, [f"{learn.fold_of('id')} AS _fold", "id AS _key"]).cache()
    metric, model = forest.cross_validate(rows, spec.features, spec.target, "_fold", 3, learn.FOREST, True)
    vectors = VectorAssembler(inputCols=list(spec.features), outputCol="v").transform(rows).cache()
    library = RandomForestClassifier(featuresCol="v", labelCol=spec.target, numTrees=30, maxDepth=8, minInstancesPerNode=10, seed=1)
    hits = [
        library.fit(vectors.where(f"_fold <> {k}")).transform(vectors.where(f"_fold = {k}"))
        .agg(F.expr(f"avg(CAST(prediction = {spec.target} AS DOUBLE))")).first()[0]
        for k in range(3)
    ]
    assert metric == pytest.approx(sum(hits) / 3, abs=0.03)
    assert model.importances == pytest.approx(library.fit(vectors).featureImportances.toArray().tolist(), abs=0.05)


def test_a_tree_is_the_best_split(spark):
    """The only border that tells the two values apart, half-way between its neighbours."""
    rows = spark.range(600).selectExpr("id % 3 AS fold", "CAST(id % 20 AS DOUBLE) AS a", "1D AS b", "if(id % 20 < 13, 2D, 5D) AS y", "id")
    error, model = forest.cross_validate(rows, ["a"], "y", "fold", 3, forest.Shape(trees=3, depth=2, least=1), False)
    assert error == pytest.approx(0, abs=1e-12) and model.importances == (1.0,)
    assert [model.edges[0][s[1]] for s in model.split] == [12.5] * 3
    found = model.transform(rows.withColumn("a", F.expr("a + 0.4D"))).selectExpr("max(abs(prediction - y))").first()[0]
    assert found == pytest.approx(0, abs=1e-12)


def test_constant_columns_and_empty_folds(spark):
    rows = spark.range(90).selectExpr("id % 3 AS fold", "1D AS a", "CAST(id % 2 AS INT) AS y", "id")
    accuracy, model = forest.cross_validate(rows, ["a"], "y", "fold", 3, SMALL, True)
    assert 0.4 <= accuracy <= 0.6 and model.importances == (0.0,) and model.transform(rows).where("prediction IN (0, 1)").count() == 90
    for held, word in (("fold < 2", "validation"), ("fold = 0", "training"), ("false", "validation")):
        with pytest.raises(ValueError, match=word):
            forest.cross_validate(rows.where(held), ["a"], "y", "fold", 3, SMALL, True)
