"""Small forests and boosted trees of MLlib grown by scans of rows in bins, and given back as MLlib's models.

MLlib's own fits keep a row as objects several times as large as its bins, for all rows and all the time of the fit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import level_growth
from shelfcast.operators.level_growth import Ensemble, Growth, NodeSums, Seen
from shelfcast.session import drop_path

#: The largest ensembles that are grown in scans.
MAX_TREES, MAX_DEPTH = 16, 8


def joint_growth(learner: Estimator, width: int) -> Growth | None:
    """What a forest or boosted trees of MLlib on ``width`` columns depend on; None for other learners, settings that
    growing in shared scans knows nothing of, and ensembles so large that fits of their own, which keep rows and predictions, are better."""
    forest = isinstance(learner, RandomForestRegressor)
    if not forest and not isinstance(learner, GBTRegressor):
        return None
    get = lambda name: learner.getOrDefault(learner.getParam(name))
    trees, depth, bins = get("numTrees" if forest else "maxIter"), get("maxDepth"), get("maxBins")
    known = not learner.isDefined(learner.getParam("weightCol")) and (
        forest or (get("lossType") == "squared" and not learner.isDefined(learner.getParam("validationIndicatorCol")))
    )
    if not known or trees > MAX_TREES or depth > MAX_DEPTH or bins > level_growth.MAX_BINS:
        return None
    return Growth(
        trees=trees, depth=depth, boosted=not forest, rate=1.0 if forest else get("stepSize"), node_rows=get("minInstancesPerNode"),
        node_share=get("minWeightFractionPerNode"), gain=get("minInfoGain"), bins=bins, share=get("subsamplingRate"),
        features=_features_of_a_node(get("featureSubsetStrategy"), width, trees if forest else 1), replace=forest and get("bootstrap"), seed=get("seed"),
    )


def _features_of_a_node(strategy: str, width: int, trees: int) -> int:
    named = {
        "all": width, "auto": width if trees == 1 else math.ceil(width / 3), "onethird": math.ceil(width / 3),
        "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))),
    }
    if strategy.lower() in named:
        return named[strategy.lower()]
    return min(int(strategy), width) if strategy.isdigit() else math.ceil(float(strategy) * width)


def seen_rows(df: DataFrame, learner: Estimator, features: Sequence[str]) -> Seen:
    """What the bins of ``df`` depend on."""
    get = lambda name: learner.getOrDefault(learner.getParam(name))
    return level_growth.seen_rows(df, features, get("maxBins"), get("seed"))


def fit_grown(df: DataFrame, learner: Estimator, growth: Growth, features: Sequence[str], flagged: Sequence[str], seen: Seen) -> Model:
    """MLlib's model of the rows of ``df``, whose inputs are the features and a 0/1 column for each of the ``flagged``."""
    draws = growth.replace or growth.share < 1
    rows = level_growth.whole_bins(df, features, learner.getLabelCol(), seen, [list(features).index(c) for c in flagged], growth.bins, draws)
    [[ensemble]] = level_growth.grow(rows, growth.bins, [growth])
    model = as_mllib(df.sparkSession, learner, ensemble, level_growth.node_sums(rows, ensemble), rows.edges[0])
    drop_path(df.sparkSession, rows.path)
    return model


def as_mllib(spark: SparkSession, learner: Estimator, ensemble: Ensemble, sums: Sequence[Sequence[NodeSums]], edges: Sequence) -> Model:
    """The model that the learner's own fit returns, of the trees of ``ensemble``."""
    java, gateway = spark._jvm, spark.sparkContext._gateway
    ml, width = java.org.apache.spark.ml, len(edges)

    def impurity(of: NodeSums) -> float:
        return max(of.squares / of.n - (of.g / of.n) ** 2, 0.0) if of.n else 0.0

    def below(tree: level_growth.Tree, own: Sequence[NodeSums], node: int) -> JavaObject:
        of = own[node]
        stats = gateway.new_array(java.double, 3)
        stats[0], stats[1], stats[2] = of.n, of.g, of.squares
        known = java.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, of.rows)
        if tree.feature[node] < 0:
            return ml.tree.LeafNode(float(tree.value[node]), impurity(of), known)
        sides = tree.left[node], tree.right[node]
        gain = impurity(of) - sum(own[s].n / of.n * impurity(own[s]) for s in sides)
        split = ml.tree.ContinuousSplit(int(tree.feature[node]), float(edges[tree.feature[node]][tree.bin[node]]))
        return ml.tree.InternalNode(float(tree.value[node]), impurity(of), gain, *[below(tree, own, s) for s in sides], split, known)

    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(ensemble.trees))
    for t, (tree, own) in enumerate(zip(ensemble.trees, sums, strict=True)):
        trees[t] = ml.regression.DecisionTreeRegressionModel(below(tree, own, 0), width)
    learner._transfer_params_to_java()
    if ensemble.growth.boosted:
        weights = gateway.new_array(java.double, len(trees))
        for t in range(len(trees)):
            weights[t] = ensemble.growth.rate if t else 1.0
        made = ml.regression.GBTRegressionModel(learner.uid, trees, weights, width)
    else:
        made = ml.regression.RandomForestRegressionModel(learner.uid, trees, width)
    made.setParent(learner._java_obj)
    model = learner._copyValues(learner._create_model(made))
    model._transfer_params_to_java()
    return model
