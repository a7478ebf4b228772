"""Histogram trees against a plain learner that looks at all rows and thresholds for every split."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from shelfcast.operators.binning import MISSING, bin_edges, bin_numbers
from shelfcast.operators.tree_growth import Limits, Sample, draws, uniform
from shelfcast.plans import models

INPUTS = ["a", "b", "c"]
SCHEMA = "a double, b long, c double, sales_quantity double"


def make_rows(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a = rng.choice([None, float("nan"), *map(float, range(8))])
        b, c = rng.choice([None, *range(5)]), float(rng.randint(0, 30))
        missing = a is None or math.isnan(a)
        rows.append((a, b, c, (3.0 if missing else a) * (b or 0.5) + (c > 11) * 4 + rng.random()))
    return rows


def matrix(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    x = np.array([[np.nan if v is None else v for v in r[:3]] for r in rows], dtype=float)
    return x, np.array([r[3] for r in rows])


def plain_split(x, g, h, limits):
    """(gain, feature, threshold, missing left, rows on the left) with the greatest gain."""
    worth = lambda g_, h_: limits.shrunk(g_) ** 2 / (h_ + limits.l2) if h_ + limits.l2 > 0 else 0.0
    best = None
    for f in range(x.shape[1]):
        lost = np.isnan(x[:, f])
        for t in np.unique(x[~lost, f]):
            for missing_left in (False, True) if lost.any() else (False,):
                left = np.where(lost, missing_left, x[:, f] <= t)
                n, m = left.sum(), (~left).sum()
                if min(n, m) < max(1, limits.leaf_rows) or min(h[left].sum(), h[~left].sum()) < limits.leaf_hessian:
                    continue
                gain = worth(g[left].sum(), h[left].sum()) + worth(g[~left].sum(), h[~left].sum()) - worth(g.sum(), h.sum())
                if gain > limits.gain and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, t, missing_left, left)
    return best if len(g) >= limits.split_rows else None


def plain_tree(x, g, h, limits):
    """Value of every row, splitting the leaf of the greatest gain one at a time."""
    leaves = [(np.arange(len(g)), 0)]
    while limits.leaves is None or len(leaves) < limits.leaves:
        options = []
        for i, (rows, depth) in enumerate(leaves):
            if limits.depth is None or depth < limits.depth:
                found = plain_split(x[rows], g[rows], h[rows], limits)
                if found:
                    options.append((found[0], -i, found))
        if not options:
            break
        _, i, found = max(options, key=lambda o: o[:2])
        rows, depth = leaves.pop(-i)
        leaves += [(rows[found[4]], depth + 1), (rows[~found[4]], depth + 1)]
    value = np.empty(len(g))
    for rows, _ in leaves:
        value[rows] = limits.value(g[rows].sum(), h[rows].sum())
    return value, len(leaves)


@pytest.mark.parametrize(
    "params",
    [
        {"numLeaves": 7, "minDataInLeaf": 5},
        {"numLeaves": 12, "minDataInLeaf": 3, "lambdaL1": 4.0, "lambdaL2": 2.0},
        {"numLeaves": 31, "maxDepth": 3, "minDataInLeaf": 1, "minGainToSplit": 2.0},
        {"numLeaves": 9, "minDataInLeaf": 1, "minSumHessianInLeaf": 30.0},
    ],
)
def test_boosting_equals_a_plain_learner(spark, params):
    rows = make_rows(400, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = models.train(df, models.leafwise_boosting(rounds=3, learningRate=0.4, **params), INPUTS)
    x, y = matrix(rows)
    limits = Limits(
        leaves=params["numLeaves"], depth=params.get("maxDepth"), leaf_rows=params["minDataInLeaf"], gain=params.get("minGainToSplit", 0.0),
        l1=params.get("lambdaL1", 0.0), l2=params.get("lambdaL2", 0.0), leaf_hessian=params.get("minSumHessianInLeaf", 1e-3),
    )
    score = np.full(len(y), y.mean())
    for _ in range(3):
        value, n_leaves = plain_tree(x, score - y, np.ones(len(y)), limits)
        assert n_leaves > 2
        score += 0.4 * value
    got = models.predict(model, spark.createDataFrame(rows, SCHEMA)).collect()
    np.testing.assert_allclose([r.prediction for r in got], score, atol=1e-9)


def test_scores_are_stored_on_the_way(spark, monkeypatch):
    """However often scores are stored, the trees are the same."""
    from shelfcast.plans import ensembles

    df = spark.createDataFrame(make_rows(200, 2), SCHEMA)
    nodes = []
    for every in (1, 2, 50):
        monkeypatch.setattr(ensembles, "STORE_EVERY", every)
        model = models.train(df, models.leafwise_boosting(rounds=5, numLeaves=4, minDataInLeaf=5, baggingFraction=0.6, baggingFreq=2), INPUTS)
        nodes.append(model.stages[-1].nodes)
    for other in nodes[1:]:
        assert (other.drop(columns=["value", "gain"]) == nodes[0].drop(columns=["value", "gain"])).all().all()
        np.testing.assert_allclose(other["value"], nodes[0]["value"], atol=1e-9)


@pytest.mark.parametrize("split_rows", [2, 60, 1000])
def test_a_node_is_split_from_its_least_rows_on(spark, split_rows):
    rows = make_rows(300, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    forest = models.histogram_forest(numTrees=2, bootstrap=False, maxDepth=4, minSamplesSplit=split_rows)
    got = models.predict(models.train(df, forest, INPUTS), df).collect()
    x, y = matrix(rows)
    limits = Limits(leaves=None, depth=4, split_rows=split_rows, leaf_rows=1, leaf_hessian=0.0)
    value, n_leaves = plain_tree(x, -y, np.ones(len(y)), limits)
    assert (n_leaves == 1) == (split_rows == 1000)
    np.testing.assert_allclose([r.prediction for r in got], value, atol=1e-9)


def test_a_bootstrapped_forest_is_stored_and_loaded(spark, tmp_path):
    df = spark.createDataFrame(make_rows(300, 4), SCHEMA).coalesce(1)
    model = models.train(df, models.histogram_forest(numTrees=10, maxDepth=5, minSamplesSplit=4), INPUTS)
    trees = model.stages[-1].trees()
    assert len(trees) == 10 and len({len(t[0]) for t in trees}) > 1
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    own, other = ([r.prediction for r in models.predict(m, df).collect()] for m in (model, again))
    assert own == other
    metrics = models.evaluate(model, df).first()
    assert metrics.test_explained_variance > 0.9
    shares = {r.feature: r.importance for r in models.feature_importance(model, spark).collect()}
    assert shares.keys() == set(INPUTS) and abs(sum(shares.values()) - 1) < 1e-9


def test_cross_validation_and_search_take_them(spark):
    from shelfcast.plans import tuning

    rows = [(*r, i) for i, r in enumerate(make_rows(240, 5))]
    df = spark.createDataFrame(rows, SCHEMA + ", row_id long")
    scores = models.cross_validate(df, models.leafwise_boosting(rounds=3, numLeaves=4), INPUTS).collect()
    assert len(scores) == 3 and all(r.test_explained_variance > 0 for r in scores)
    space = {"numLeaves": tuning.Ints(2, 6), "lambdaL1": tuning.Floats(1e-8, 1.0, log=True)}
    best, trials = tuning.search(df, models.leafwise_boosting(rounds=2), INPUTS, space, trials=2)
    assert trials.count() == 2 and "prediction" in models.predict(best, df).columns


def test_no_labels_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        models.train(empty, models.leafwise_boosting(), INPUTS)
    one = spark.createDataFrame([(1.0, None, 2.0, 7.0), (None, 1, 2.0, None)], SCHEMA)
    for learner in (models.leafwise_boosting(rounds=2), models.histogram_forest(numTrees=2, bootstrap=False)):
        assert [r.prediction for r in models.predict(models.train(one, learner, INPUTS), one).collect()] == [7.0, 7.0]


def test_bins_are_values_or_quantiles(spark):
    rows = [(float(i % 5), i, i / 7, 1.0) for i in range(1000)] + [(None, None, float("nan"), 1.0)]
    edges = bin_edges(spark.createDataFrame(rows, SCHEMA), INPUTS, 10)
    assert edges[0].tolist() == [0, 1, 2, 3, 4] and len(edges[1]) == 10 and abs(edges[1][4] - 500) < 20
    bins = bin_numbers([np.array([0.0, 4.0, 9.0, np.nan])], edges[:1])
    assert bins[:, 0].tolist() == [0, 4, 4, MISSING]


def test_draws_are_those_of_a_sample_with_replacement():
    draw = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 200_000)
    for k, chance in ((0, math.exp(-1)), (1, math.exp(-1)), (2, math.exp(-1) / 2), (3, math.exp(-1) / 6)):
        assert abs((draws(draw, 5) == k).mean() - chance) < 0.005
    assert abs(np.corrcoef(uniform(draw, 1), uniform(draw, 2))[0, 1]) < 0.01
    assert Sample().weights(draw) is None and abs(Sample(3, 0.25).weights(draw).mean() - 0.25) < 0.005
