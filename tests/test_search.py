"""Adaptive search against a plain sampler, and against random draws; the elbow in shared passes against numpy."""

from __future__ import annotations

import json
import math
import random
from statistics import NormalDist, mean

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.plans import clusters, models, parzen, tuning

SPACE = {"x": tuning.Floats(-3.0, 5.0), "y": tuning.Floats(1e-3, 1.0, log=True), "n": tuning.Ints(1, 20), "c": tuning.Choice(("a", "b", "d"))}
BOUNDS = {"x": (-3.0, 5.0), "y": (math.log(1e-3), 0.0), "n": (0.5, 20.5)}


def loss(t: dict) -> float:
    return (t["x"] - 2) ** 2 + (math.log(t["y"]) + 3) ** 2 + (t["n"] - 7) ** 2 / 20 + {"a": 1.0, "b": 0.0, "d": 2.0}[t["c"]]


def normals(values: list[float], low: float, high: float) -> list[tuple[float, float]]:
    centres = [(v, i) for i, v in enumerate([*values, (low + high) / 2])]
    out = {}
    ranked = sorted(centres)
    for at, (c, i) in enumerate(ranked):
        left = c - (ranked[at - 1][0] if at else low)
        right = (ranked[at + 1][0] if at + 1 < len(ranked) else high) - c
        out[i] = (c, min(max(left, right, (high - low) / min(100, 1 + len(centres))), high - low))
    out[len(values)] = ((low + high) / 2, high - low)
    return [out[i] for i in range(len(centres))]


def density(parts: list[tuple[float, float]], x: float, low: float, high: float) -> float:
    return mean(NormalDist(c, w).pdf(x) / (NormalDist(c, w).cdf(high) - NormalDist(c, w).cdf(low)) for c, w in parts)


def plain_sampler(trials: int, startup: int, seed: int, group: int) -> list[dict]:
    rng = np.random.default_rng(seed)
    done: list[dict] = []
    losses: list[float | None] = []
    while len(done) < trials:
        first = len(done)
        for _ in range(min(group, trials - first)):
            known = [v for v in losses if v is not None]
            order = sorted((max(known) if v is None else v, i) for i, v in enumerate(losses)) if known else []
            n_good = min(max(1, math.ceil(0.1 * len(order))), 25)
            good, bad = sorted(i for _, i in order[:n_good]), sorted(i for _, i in order[n_good:])
            trial = {}
            for name in SPACE:
                u = rng.random(48)
                if len(done) < startup:
                    if name == "c":
                        trial[name] = "abd"[int(u[0] * 3)]
                        continue
                    low, high = BOUNDS[name]
                    v = low + u[0] * (high - low)
                elif name == "c":
                    p, q = ([([done[i]["c"] for i in side].count(o) + 1 / 3) / (len(side) + 1) for o in "abd"] for side in (good, bad))
                    drawn = [next((k for k in range(3) if x < sum(p[: k + 1])), 2) for x in u[:24]]
                    trial[name] = "abd"[max(drawn, key=lambda k: math.log(p[k] / q[k]))]
                    continue
                else:
                    low, high = BOUNDS[name]
                    there = lambda v: math.log(v) if name == "y" else float(v)
                    p, q = (normals([there(done[i][name]) for i in side], low, high) for side in (good, bad))
                    drawn = []
                    for a, b in zip(u[:24], u[24:]):
                        c, w = p[int(a * len(p))]
                        d = NormalDist(c, w)
                        drawn.append(min(max(d.inv_cdf(d.cdf(low) + b * (d.cdf(high) - d.cdf(low))), low), high))
                    v = max(drawn, key=lambda x: math.log(density(p, x, low, high)) - math.log(density(q, x, low, high)))
                trial[name] = math.exp(v) if name == "y" else min(max(round(v), 1), 20) if name == "n" else v
            done.append(trial)
            losses.append(None)
        for i in range(first, len(done)):
            losses[i] = loss(done[i])
    return done


@pytest.mark.parametrize("group", [1, 3])
def test_trials_equal_a_plain_sampler(group):
    got = tuning.optimise(loss, SPACE, trials=30, parallelism=group, seed=5, startup=8).trials
    want = plain_sampler(30, 8, 5, group)
    for a, b in zip(got, want, strict=True):
        assert (a["n"], a["c"]) == (b["n"], b["c"])
        assert a["x"] == pytest.approx(b["x"], abs=1e-6) and a["y"] == pytest.approx(b["y"], rel=1e-6)


def test_it_beats_random_draws_on_twenty_seeds():
    better = 0
    own, blind = [], []
    for seed in range(20):
        found = min(tuning.optimise(loss, SPACE, trials=80, seed=seed).losses)
        drawn = min(loss(t) for t in tuning.draw_trials(SPACE, 80, seed))
        own.append(found)
        blind.append(drawn)
        better += found < drawn
    assert better > 10 and mean(own) < 0.75 * mean(blind)


def test_pending_trials_keep_others_away():
    sampler = parzen.Sampler({"x": tuning.Floats(0.0, 1.0)}, seed=1, startup=0)
    assert 0 <= sampler.ask()["x"] <= 1
    sampler.tell(0, 1.0)
    assert all(0 <= sampler.ask()["x"] <= 1 for _ in range(5)) and sampler._placed() == [1.0] * 6


def test_search_refits_the_best_trial(spark):
    rng = random.Random(1)
    rows = [(i, float(rng.randint(0, 9)), rng.random()) for i in range(200)]
    df = spark.createDataFrame([(i, a, b, a * 2 + b) for i, a, b in rows], "row_id long, a double, b double, sales_quantity double")
    space = {"numLeaves": tuning.Ints(2, 8), "lambdaL2": tuning.Floats(1e-3, 10.0, log=True)}
    best, trials = tuning.adaptive_search(df, models.leafwise_boosting(rounds=2, learningRate=0.5), ["a", "b"], space, trials=4, folds=2, startup=2)
    table = trials.collect()
    assert len(table) == 4 and table[0].mae == min(r.mae for r in table)
    leaves = (best.stages[-1].nodes.query("feature < 0").groupby("tree").size()).max()
    assert leaves <= json.loads(table[0].params)["numLeaves"]


def numpy_lloyd(points: np.ndarray, centres: np.ndarray, steps: int, tolerance: float) -> tuple[np.ndarray, float]:
    for step in range(steps + 1):
        squares = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        nearest = squares.argmin(axis=1)
        cost = squares.min(axis=1).sum()
        new = np.stack([points[nearest == i].mean(axis=0) if (nearest == i).any() else c for i, c in enumerate(centres)])
        if step == steps or np.sqrt(((new - centres) ** 2).sum(axis=1)).max() <= tolerance:
            return centres, cost
        centres = new


def test_shared_passes_equal_runs_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(3)
    raw = np.concatenate([rng.normal(m, 1, (80, 3)) * [1, 5, 0.1] for m in (0, 6, 12)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in raw], "a double, b double, c double").repartition(4)
    _, mean_, std = clusters._moments(df, ["a", "b", "c"])
    points = (raw - raw.mean(axis=0)) / raw.std(axis=0)
    centres = {k: points[rng.choice(len(points), k, replace=False)] for k in range(1, 8)}
    centres[7][6] = 50.0  # a centre that no row is near
    scans = []
    step = clusters.shared_step
    monkeypatch.setattr(clusters, "shared_step", lambda *a: scans.append(1) or step(*a))
    got = clusters.shared_lloyd(df, mean_, std, centres, steps=9, tolerance=1e-6)
    assert len(scans) <= 10
    for k, (found, cost) in got.items():
        want, least = numpy_lloyd(points, centres[k], 9, 1e-6)
        np.testing.assert_allclose(found, want, atol=1e-9)
        assert cost == pytest.approx(least)


def test_elbow_costs_fall(spark):
    rng = np.random.default_rng(4)
    raw = np.concatenate([rng.normal(m, 0.5, (100, 2)) for m in (0, 10, 20)])
    rows = [tuple(map(float, r)) for r in raw] + [(None, 1.0), (float("nan"), 2.0)]
    costs = [r.wcss for r in clusters.elbow(spark.createDataFrame(rows, "a double, b double"), max_k=5).orderBy("k").collect()]
    assert costs[0] == pytest.approx(600) and costs[2] < 0.05 * costs[0] and all(a >= b - 1e-6 for a, b in zip(costs, costs[1:3]))
    with pytest.raises(ValueError):
        clusters.elbow(spark.createDataFrame(rows[-2:], "a double, b double"))


def test_trials_of_a_fold_are_scored_in_one_scan(spark, monkeypatch):
    """The losses are those of one model after the other, and inputs that are never missing get no flag."""
    rng = random.Random(2)
    rows = [(i, float(rng.randint(0, 9)), None if i % 7 == 0 else rng.random()) for i in range(300)]
    df = spark.createDataFrame([(i, a, b, a * 2 + (b or 0)) for i, a, b in rows], "row_id long, a double, b double, sales_quantity double").persist()
    scans = []
    together = tuning._losses
    monkeypatch.setattr(tuning, "_losses", lambda fitted, *more: scans.append(len(fitted)) or together(fitted, *more))
    space = {"numTrees": tuning.Ints(1, 3), "maxDepth": tuning.Ints(1, 3)}
    best, trials = tuning.search(df, models.random_forest(bootstrap=False), ["a", "b"], space, trials=3, folds=2)
    assert scans == [3, 3]
    assert best.stages[-2].getInputCols() == ["__filled_a", "__filled_b", "__missing_b"]
    data = tuning.with_fold(df, 2, ("row_id",))
    for row in trials.collect():
        found = []
        for i in range(2):
            forest = models.random_forest(bootstrap=False, **json.loads(row.params))
            model = models.regression_pipeline(forest, ["a", "b"], *models.input_means(df, ["a", "b"])).fit(data.where(F.col("fold") != i))
            scored = models.predict(model, data.where(F.col("fold") == i))
            found.append(scored.agg(F.avg(F.abs(F.col("prediction") - F.col("sales_quantity")))).first()[0])
        assert row.mae == pytest.approx(sum(found) / 2, rel=1e-9)
