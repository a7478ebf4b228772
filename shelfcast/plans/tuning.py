"""Random and adaptive search over tree parameters, scored by cross-validated MAE."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, functions as F

from shelfcast.operators import level_growth
from shelfcast.operators.level_growth import Ensemble, FoldBins
from shelfcast.operators.rows import with_fold
from shelfcast.plans.ensembles import BinnedRows, binned_error, is_histogram_learner
from shelfcast.plans.grown import joint_growth
from shelfcast.plans.models import input_means, regression_pipeline
from shelfcast.plans.parzen import STARTUP, Ranged, Sampler, better_choice
from shelfcast.schema import PREDICTION, ROW_ID
from shelfcast.session import cut_lineage, drop_path, small_splits


#: Models that are scored in the same scan.
TOGETHER = 10

#: Most folds whose trials are grown in shared scans.
MAX_FOLDS = 10


@dataclass(frozen=True)
class Ints(Ranged):
    """Whole numbers from ``low`` to ``high``; ``log`` draws their logarithms evenly."""

    low: int
    high: int
    log: bool = False

    def draw(self, rng: random.Random) -> int:
        if not self.log:
            return rng.randint(self.low, self.high)
        return round(math.exp(rng.uniform(math.log(self.low), math.log(self.high))))

    def ends(self) -> tuple[float, float]:
        low, high = self.low - 0.5, self.high + 0.5
        return (math.log(low), math.log(high)) if self.log else (low, high)

    def place(self, value: object) -> float:
        return math.log(value) if self.log else float(value)

    def value(self, place: float) -> int:
        return min(max(round(math.exp(place) if self.log else place), self.low), self.high)


@dataclass(frozen=True)
class Floats(Ranged):
    low: float
    high: float
    log: bool = False

    def draw(self, rng: random.Random) -> float:
        if not self.log:
            return rng.uniform(self.low, self.high)
        return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))

    def ends(self) -> tuple[float, float]:
        return (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)

    def place(self, value: object) -> float:
        return math.log(value) if self.log else float(value)

    def value(self, place: float) -> float:
        return min(max(math.exp(place) if self.log else place, self.low), self.high)


@dataclass(frozen=True)
class Fraction(Ranged):
    """A share of the features, which Spark takes as text."""

    low: float
    high: float

    def draw(self, rng: random.Random) -> str:
        return f"{rng.uniform(self.low, self.high):.4f}"

    def ends(self) -> tuple[float, float]:
        return self.low, self.high

    def place(self, value: object) -> float:
        return float(value)

    def value(self, place: float) -> str:
        return f"{place:.4f}"


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random) -> object:
        return rng.choice(self.values)

    def at(self, share: float) -> object:
        return self.values[min(int(share * len(self.values)), len(self.values) - 1)]

    def place(self, value: object) -> int:
        return self.values.index(value)

    def better(self, good: Sequence[int], bad: Sequence[int], choices: np.ndarray, quantiles: np.ndarray) -> object:
        return self.values[better_choice(len(self.values), good, bad, choices)]


# Fixed search ranges.
RANDOM_FOREST_SPACE = {
    "numTrees": Ints(100, 2000),
    "maxDepth": Ints(2, 30, log=True),
    "minInstancesPerNode": Ints(1, 16),
    "bootstrap": Choice((True, False)),
}
BOOSTED_TREES_SPACE = {
    "maxIter": Ints(100, 2000),
    "stepSize": Floats(1e-3, 1e-1, log=True),
    "maxDepth": Ints(1, 30),
    "minInstancesPerNode": Ints(10, 100),
    "minWeightFractionPerNode": Floats(1e-6, 1e-2, log=True),
    "featureSubsetStrategy": Fraction(0.4, 1.0),
    "subsamplingRate": Floats(0.4, 1.0),
    "minInfoGain": Floats(0.0, 1.0),
    "maxBins": Ints(10, 255),
}
HISTOGRAM_FOREST_SPACE = {
    "numTrees": Ints(100, 2000),
    "maxDepth": Ints(2, 32, log=True),
    "minSamplesSplit": Ints(2, 16),
    "minDataInLeaf": Ints(1, 16),
    "bootstrap": Choice((True, False)),
}
LEAFWISE_SPACE = {
    "rounds": Ints(100, 2000),
    "learningRate": Floats(1e-3, 1e-1, log=True),
    "numLeaves": Ints(2, 256),
    "maxDepth": Ints(1, 64),
    "minDataInLeaf": Ints(10, 100),
    "lambdaL1": Floats(1e-8, 10.0, log=True),
    "lambdaL2": Floats(1e-8, 10.0, log=True),
    "featureFraction": Floats(0.4, 1.0),
    "baggingFraction": Floats(0.4, 1.0),
    "baggingFreq": Ints(1, 7),
    "minGainToSplit": Floats(0.0, 1.0),
    "maxBin": Ints(10, 255),
    "minSumHessianInLeaf": Floats(1e-5, 10.0),
}


def draw_trials(space: Mapping[str, object], trials: int = 10, seed: int = 42) -> list[dict[str, object]]:
    rng = random.Random(seed)
    return [{name: choice.draw(rng) for name, choice in space.items()} for _ in range(trials)]


def _folded(df: DataFrame, label: str, features: Sequence[str], folds: int, row_key: Sequence[str], fold: str | None = None) -> DataFrame:
    """What the fits need of the rows with a label, stored; ``fold`` names a column that holds the folds already."""
    known = df.where(F.col(label).isNotNull())
    data = with_fold(known, folds, row_key) if fold is None else known.withColumnRenamed(fold, "fold")
    return cut_lineage(data.select(*dict.fromkeys(features), F.col(label).cast("double").alias(label), "fold"))


def _pipeline(regressor: Estimator, data: DataFrame, features: Sequence[str]) -> Pipeline:
    means, flagged = ({}, []) if is_histogram_learner(regressor) else input_means(data, features)
    return regression_pipeline(regressor, features, means, flagged)


def _trial_table(df: DataFrame, settings: Sequence[dict[str, object]], losses: Sequence[float]) -> DataFrame:
    rows = [(i, json.dumps(s), float(m)) for i, (s, m) in enumerate(zip(settings, losses, strict=True))]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, mae double").orderBy("mae", "trial")


def optimise(
    loss: Callable[[dict[str, object]], float],
    space: Mapping[str, object],
    *,
    trials: int,
    parallelism: int = 1,
    seed: int = 42,
    startup: int = STARTUP,
    run: Callable | None = None,
) -> Sampler:
    """A sampler after ``trials`` trials, ``parallelism`` of which run at the same time.

    The trials of a group are drawn one after the other, each with those before it pending, and their losses
    are told when the group is done, so the result does not depend on which of them ends first.
    """
    sampler = Sampler(space, seed, startup)
    with ThreadPool(parallelism) as pool:
        while len(sampler.trials) < trials:
            first = len(sampler.trials)
            group = [sampler.ask() for _ in range(min(parallelism, trials - first))]
            for i, found in enumerate(pool.map(run(loss) if run else loss, group, chunksize=1)):
                sampler.tell(first + i, found)
    return sampler


def adaptive_search(
    df: DataFrame,
    regressor: Estimator,
    features: Sequence[str],
    space: Mapping[str, object],
    *,
    trials: int = 10,
    folds: int = 3,
    parallelism: int = 2,
    row_key: Sequence[str] = (ROW_ID,),
    fold: str | None = None,
    seed: int = 42,
    startup: int = STARTUP,
) -> tuple[PipelineModel, DataFrame]:
    """Like :func:`search`, but trials after the first ``startup`` are drawn near the good ones so far."""
    label = regressor.getLabelCol()
    data = _folded(df, label, features, folds, row_key, fold)
    pipeline = _pipeline(regressor, data, features)
    learner = pipeline.getStages()[-1]
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=PREDICTION, metricName="mae")

    def params(setting: dict[str, object]) -> dict:
        return {learner.getParam(name): value for name, value in setting.items()}

    def outside(i: int) -> DataFrame:
        return data.where(F.col("fold") != i).drop("fold")

    def score(setting: dict[str, object], i: int) -> float:
        return evaluator.evaluate(pipeline.fit(outside(i), params(setting)).transform(data.where(F.col("fold") == i)))

    def halves(estimator: Estimator, i: int) -> tuple[BinnedRows, BinnedRows]:
        training = estimator.binned(outside(i))
        return training, estimator.binned(data.where(F.col("fold") == i), training.edges)

    def binned_score(setting: dict[str, object], i: int) -> float:
        estimator = learner.copy(params(setting))
        training, held_out = shared[i] if shared else halves(estimator, i)
        found = binned_error(held_out, *estimator.grow(training))
        if not shared:
            training.drop()
            held_out.drop()
        return found

    histogram = is_histogram_learner(learner)
    # Bins depend on the training rows and on the most bins of a feature alone: trials that agree on these share them.
    shared = [halves(learner, i) for i in range(folds)] if histogram and "maxBin" not in space else []
    one = binned_score if histogram else score
    threaded = inheritable_thread_target(df.sparkSession)
    sampler = optimise(
        lambda setting: sum(one(setting, i) for i in range(folds)) / folds,
        space, trials=trials, parallelism=parallelism, seed=seed, startup=startup, run=threaded,
    )
    for rows in (r for both in shared for r in both):
        rows.drop()
    best = min(range(trials), key=lambda i: (sampler.losses[i], i))
    return pipeline.fit(data.drop("fold"), params(sampler.trials[best])), _trial_table(df, sampler.trials, sampler.losses)


def search(
    df: DataFrame,
    regressor: Estimator,
    features: Sequence[str],
    space: Mapping[str, object],
    *,
    trials: int = 10,
    folds: int = 3,
    parallelism: int = 2,
    row_key: Sequence[str] = (ROW_ID,),
    fold: str | None = None,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """The best of ``trials`` random settings refitted on all rows, and the table (trial, params, mae).

    Small forests and boosted trees of MLlib (:func:`joint_growth`) are grown for all trials and folds in the same scans,
    others are fitted one by one. ``fold`` names a column of folds to be used instead of the row key.
    """
    label = regressor.getLabelCol()
    settings = draw_trials(space, trials, seed)
    data = _folded(df, label, features, folds, row_key, fold)
    *inputs, learner = _pipeline(regressor, data, features).getStages()
    # The inputs are the same for every trial: they are made once, not in every fit.
    made = PipelineModel(inputs).transform(data)
    ready = made.select("__features", label, "fold") if inputs else made
    params = [{learner.getParam(name): value for name, value in s.items()} for s in settings]
    losses = np.zeros(trials)
    threaded = inheritable_thread_target(df.sparkSession)
    columns = inputs[-1].getInputCols() if inputs else []
    growths = [joint_growth(learner.copy(p), len(columns)) for p in params]
    joint = all(growths) and folds <= MAX_FOLDS
    with small_splits(df.sparkSession), ThreadPool(parallelism) as pool:
        for bins in sorted({g.bins for g in growths}) if joint else ():
            own = [t for t, g in enumerate(growths) if g.bins == bins]
            rows = level_growth.fold_bins(made, columns, label, folds, bins, growths[own[0]].seed)
            for ensembles in level_growth.grow(rows, bins, [growths[t] for t in own]):
                losses[own] += _losses(ensembles, rows, label)
            drop_path(df.sparkSession, rows.path)
        for i in () if joint else range(folds):
            training = ready.where(F.col("fold") != i).drop("fold").persist()
            fitted = pool.map(threaded(lambda p: learner.fit(training, p)), params, chunksize=1)
            training.unpersist()
            losses += _losses(fitted, ready.where(F.col("fold") == i), label)
        best = learner.fit(ready.drop("fold"), params[int(np.argmin(losses))])
    return PipelineModel([*inputs, best]), _trial_table(df, settings, losses / folds)


def _losses(fitted: Sequence[Model | Ensemble], rows: DataFrame | FoldBins, label: str) -> np.ndarray:
    """Mean absolute error of every model, TOGETHER of them in one scan of the rows, or of ensembles grown together."""
    if isinstance(rows, FoldBins):
        return np.array(level_growth.mean_errors(fitted, rows))
    found: list[float] = []
    for at in range(0, len(fitted), TOGETHER):
        scored, names = rows, [f"__p{i}" for i in range(len(fitted[at : at + TOGETHER]))]
        for model, name in zip(fitted[at : at + TOGETHER], names):
            scored = model.copy({model.predictionCol: name}).transform(scored)
        found += scored.agg(*[F.avg(F.abs(F.col(name) - F.col(label))) for name in names]).first()
    return np.array(found)
