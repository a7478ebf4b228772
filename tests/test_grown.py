"""Fits by scans of rows in bins give MLlib's models, without a fit of MLlib that keeps all rows as objects."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import models
from shelfcast.session import new_path

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    values = [(i, rng.randint(0, 9), None if i % 7 == 0 else rng.gauss(0, 1), rng.random()) for i in range(900)]
    made = [(i, a, b, c, None if i % 50 == 49 else int(a * 2 + 10 * (b or 0) * c)) for i, a, b, c in values]
    return spark.createDataFrame(made, "row_id long, a int, b double, c double, sales_quantity long").persist()


def by_mllib(df, learner):
    known = df.where("sales_quantity is not null").withColumn("sales_quantity", F.col("sales_quantity").cast("double"))
    return models.regression_pipeline(learner, NAMES, *models.input_means(known, NAMES)).fit(known)


LEARNERS = [
    (models.boosted_trees, {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3}),
    (models.boosted_trees, {"maxIter": 2, "maxDepth": 0}),
    (models.random_forest, {"numTrees": 2, "maxDepth": 4, "bootstrap": False, "minInstancesPerNode": 5}),
]


@pytest.mark.parametrize("make, params", LEARNERS)
def test_a_grown_model_is_that_of_mllib(spark, rows, monkeypatch, make, params):
    learner = make(**params)
    want = by_mllib(rows, learner)
    monkeypatch.setattr(type(learner), "_fit", lambda *a: pytest.fail("a fit of MLlib keeps all rows as objects"))
    got = models.train(rows, learner, NAMES)
    a, b = want.stages[-1], got.stages[-1]
    assert type(a) is type(b) and got.stages[-2].getInputCols() == want.stages[-2].getInputCols()
    assert (a.getNumTrees, a.treeWeights, a.numFeatures) == (b.getNumTrees, b.treeWeights, b.numFeatures)
    assert b.featureImportances.toArray() == pytest.approx(a.featureImportances.toArray(), abs=1e-9)
    assert b.getPredictionCol() == "prediction" and b.uid == learner.uid
    values = lambda m: [r.prediction for r in models.predict(m, rows).orderBy("row_id").collect()]
    assert values(got) == pytest.approx(values(want), rel=1e-9)
    path = new_path(spark, "grown")
    models.save_model(got, path)
    assert values(models.load_model(spark, path)) == values(got)


def test_a_forest_of_drawn_rows(spark, rows, monkeypatch):
    learner = models.random_forest(numTrees=5, maxDepth=5, seed=3)
    monkeypatch.setattr(type(learner), "_fit", lambda *a: pytest.fail("a fit of MLlib keeps all rows as objects"))
    got = models.train(rows, learner, NAMES)
    forest = got.stages[-1]
    assert forest.getNumTrees == 5 and len({t.toDebugString for t in forest.trees}) == 5
    assert sum(forest.featureImportances) == pytest.approx(1)
    assert models.evaluate(got, rows).first()["test_explained_variance"] > 0.8


def test_larger_ensembles_are_left_to_mllib(rows):
    learner = models.boosted_trees(maxIter=17, maxDepth=1)
    assert models.train(rows, learner, NAMES).stages[-1].getNumTrees == 17


def test_nothing_to_fit(rows):
    with pytest.raises(ValueError):
        models.train(rows.limit(0), models.boosted_trees(maxIter=2), NAMES)
