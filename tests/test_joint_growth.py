"""Trials grown together in shared scans, against MLlib's fits of one trial and fold after the other."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from shelfcast.operators import level_growth
from shelfcast.operators.rows import with_fold
from shelfcast.plans import models, tuning


def rows(spark, n: int = 300):
    rng = random.Random(8)
    values = [(i, float(rng.randint(0, 9)), None if i % 7 == 0 else rng.gauss(0, 1), rng.random()) for i in range(n)]
    return spark.createDataFrame([(i, a, b, c, a * 2 + (b or 0) * c) for i, a, b, c in values], "row_id long, a double, b double, c double, sales_quantity double").persist()


def one_by_one(df, learner, params: dict) -> float:
    names, data, found = ["a", "b", "c"], with_fold(df, 2), []
    for i in range(2):
        pipeline = models.regression_pipeline(learner.copy({learner.getParam(k): v for k, v in params.items()}), names, *models.input_means(df, names))
        scored = models.predict(pipeline.fit(data.where(F.col("fold") != i)), data.where(F.col("fold") == i))
        found.append(scored.agg(F.avg(F.abs(F.col("prediction") - F.col("sales_quantity")))).first()[0])
    return sum(found) / 2


BOOSTED = {
    "maxIter": tuning.Ints(1, 3),
    "stepSize": tuning.Floats(1e-2, 1.0, log=True),
    "maxDepth": tuning.Ints(0, 3),
    "minWeightFractionPerNode": tuning.Floats(1e-3, 1e-1, log=True),
    "maxBins": tuning.Choice((6, 32)),
}
FOREST = {"maxDepth": tuning.Ints(1, 4), "minInstancesPerNode": tuning.Ints(1, 30), "minInfoGain": tuning.Floats(0.0, 0.5)}


@pytest.mark.parametrize("make, given, space", [(models.boosted_trees, {}, BOOSTED), (models.random_forest, {"bootstrap": False, "numTrees": 2}, FOREST)])
def test_losses_are_those_of_own_fits_and_one_model_is_fitted(spark, monkeypatch, make, given, space):
    df, learner = rows(spark), make(**given)
    fits, fit = [], type(learner)._fit
    with monkeypatch.context() as patched:
        patched.setattr(type(learner), "_fit", lambda self, data: fits.append(1) or fit(self, data))
        named = with_fold(df, 2, name="part").drop("row_id")
        best, trials = tuning.search(named, learner, ["a", "b", "c"], space, trials=6, folds=2, fold="part", seed=3)
    assert fits == [1] and isinstance(best.stages[-1].getNumTrees, int)
    for row in trials.collect():
        assert row.mae == pytest.approx(one_by_one(df, learner, json.loads(row.params)), rel=1e-9)


def test_a_level_of_all_trials_and_folds_is_one_scan(spark, monkeypatch):
    scans, scan = [], level_growth._scan
    monkeypatch.setattr(level_growth, "_scan", lambda *a: scans.append(len(a[3])) or scan(*a))
    space = {"numTrees": tuning.Ints(1, 4), "maxDepth": tuning.Ints(2, 3)}
    # Without sampled rows: draws hang on where rows lie in the stored table, which two runs need not share.
    learner = models.random_forest(bootstrap=False, featureSubsetStrategy="0.7")
    table = tuning.search(rows(spark), learner, ["a", "b", "c"], space, trials=4, folds=3)[1].collect()
    assert len(table) == 4 and len(scans) == max(json.loads(r.params)["maxDepth"] for r in table)
    first = len(scans)
    # Sums that do not fit are collected in several scans, with the same losses.
    monkeypatch.setattr(level_growth, "SUMS_BYTES", 2 * 4 * 32 * 8 * 5)
    again = tuning.search(rows(spark), learner, ["a", "b", "c"], space, trials=4, folds=3)[1].collect()
    assert [r.mae for r in again] == pytest.approx([r.mae for r in table], rel=1e-9) and len(scans) > 2 * first


def test_sampled_rows_and_features_score_like_those_of_own_fits(spark):
    df = rows(spark, 3000)
    for learner in (models.random_forest(numTrees=12, maxDepth=4, featureSubsetStrategy="0.7"), models.boosted_trees(maxIter=3, subsamplingRate=0.6, stepSize=0.5)):
        trial = tuning.search(df, learner, ["a", "b", "c"], {"maxDepth": tuning.Choice((4,))}, trials=1, folds=2)[1].first()
        assert trial.mae == pytest.approx(one_by_one(df, learner, {"maxDepth": 4}), rel=0.1)


def test_draws_with_replacement_have_the_share_as_their_mean():
    draw = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 200_000)
    for share in (0.4, 1.0):
        got = level_growth._Sample(5, share, True).weights(draw)
        assert got.mean() == pytest.approx(share, rel=0.02) and got.var() == pytest.approx(share, rel=0.02)


def test_candidates_are_all_middles_or_even_parts():
    np.testing.assert_array_equal(level_growth.split_points(np.array([3.0, 1.0, 0.0]), np.array([1, 1, 5]), 3), [0.5, 2.0])
    many = level_growth.split_points(np.arange(100.0), np.ones(100, dtype=int), 5)
    np.testing.assert_array_equal(many, [19.5, 39.5, 59.5, 79.5])
    assert not len(level_growth.split_points(np.array([7.0]), np.array([4]), 32))


def test_other_learners_are_fitted_by_themselves(spark):
    for learner in (
        models.random_forest(numTrees=tuning.MAX_TREES + 1), models.random_forest(maxDepth=tuning.MAX_DEPTH + 1), models.boosted_trees(lossType="absolute"),
        models.boosted_trees(maxIter=2, maxBins=300), models.leafwise_boosting(), models.random_forest(numTrees=2, weightCol="w"),
    ):
        assert tuning.joint_growth(learner, 3) is None


def test_a_large_forest_is_still_searched(spark):
    learner = RandomForestRegressor(featuresCol="__features", labelCol="sales_quantity", predictionCol="prediction", numTrees=tuning.MAX_TREES + 1, bootstrap=False)
    trial = tuning.search(rows(spark), learner, ["a", "b", "c"], {"maxDepth": tuning.Choice((2,))}, trials=1, folds=2)[1].first()
    assert trial.mae == pytest.approx(one_by_one(rows(spark), learner, {"maxDepth": 2}), rel=0.1)
