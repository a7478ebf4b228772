"""Trials that share the bins of their fold, against fits and scores of their own."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.rows import with_fold
from shelfcast.plans import ensembles, models, tuning


@pytest.mark.parametrize(
    "learner, space, tables",
    [
        (models.leafwise_boosting(rounds=1, minDataInLeaf=30), {"numLeaves": tuning.Ints(2, 4), "learningRate": tuning.Floats(0.1, 1.0)}, 5),
        (models.leafwise_boosting(rounds=1, minDataInLeaf=30), {"maxBin": tuning.Ints(200, 255)}, 13),
        (models.histogram_forest(bootstrap=False, numTrees=1), {"maxDepth": tuning.Ints(1, 2)}, 5),
    ],
)
def test_losses_are_those_of_fits_of_their_own(spark, monkeypatch, learner, space, tables):
    rng = random.Random(4)
    rows = [(i, float(rng.randint(0, 9)), None if i % 7 == 0 else rng.random()) for i in range(300)]
    df = spark.createDataFrame([(i, a, b, a * 2 + (b or 0)) for i, a, b in rows], "row_id long, a double, b double, sales_quantity double").persist()
    stored = []
    store = ensembles.binned
    monkeypatch.setattr(ensembles, "binned", lambda *a: stored.append(1) or store(*a))
    data = with_fold(df, 2, name="part").drop("row_id")
    _, trials = tuning.adaptive_search(data, learner, ["a", "b"], space, trials=3, folds=2, fold="part", startup=3)
    assert len(stored) == tables
    for row in trials.collect():
        found = []
        for i in range(2):
            own = learner.copy({learner.getParam(k): v for k, v in json.loads(row.params).items()})
            model = models.train(data.where(F.col("part") != i), own, ["a", "b"])
            scored = models.predict(model, data.where(F.col("part") == i))
            found.append(scored.agg(F.avg(F.abs(F.col("prediction") - F.col("sales_quantity")))).first()[0])
        assert row.mae == pytest.approx(sum(found) / 2, rel=1e-9)
