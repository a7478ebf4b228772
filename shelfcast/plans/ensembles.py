"""Histogram-tree ensembles as ML estimators: leaf-wise boosting and forests with a minimum split size."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.operators import tree_growth
from shelfcast.operators.binning import BINNED, BINS, DRAW, LABEL, LABEL_SUM, N_LABELS, SCORE, bin_edges, binned, number
from shelfcast.operators.blocks import chunks, packed
from shelfcast.operators.tree_growth import Limits, Sample, Tree
from shelfcast.schema import PREDICTION, QUANTITY
from shelfcast.session import cut_lineage, drop_path, new_path, ship

#: Trees of a boosted ensemble after which the rows' scores are stored anew.
STORE_EVERY = 8

#: Trees of a forest that grow together.
TOGETHER = 8

_NODES = "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double"


class _Columns(HasInputCols, HasLabelCol, HasPredictionCol):
    def setInputCols(self, value: Sequence[str]):  # noqa: N802
        return self._set(inputCols=list(value))


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


@dataclass(frozen=True)
class BinnedRows:
    """Rows as bins, stored at ``path``, and the upper edges of the bins. Several fits may read them."""

    table: DataFrame
    edges: list[np.ndarray]
    path: str

    def drop(self) -> None:
        drop_path(self.table.sparkSession, self.path)


class _TreeEstimator(Estimator, _Columns, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """What both learners share: bins, and the limits of a leaf."""

    maxBin = _param("maxBin", "most bins of a feature", TypeConverters.toInt)
    maxDepth = _param("maxDepth", "most splits above a leaf, -1: no limit", TypeConverters.toInt)
    minDataInLeaf = _param("minDataInLeaf", "least rows of a leaf", TypeConverters.toInt)

    def binned(self, df: DataFrame, edges: list[np.ndarray] | None = None) -> BinnedRows:
        """The rows of ``df`` as bins, in those of other rows where ``edges`` are given. Of the parameters only
        ``maxBin`` matters."""
        features, label = self.getInputCols(), self.getLabelCol()
        if not features:
            raise ValueError("name the input columns")
        edges = bin_edges(df.where(number(label).isNotNull()), features, self.getOrDefault(self.maxBin)) if edges is None else edges
        table, path = binned(df, features, label, edges)
        return BinnedRows(table, edges, path)

    def _fit(self, df: DataFrame) -> TreeEnsembleModel:
        rows = self.binned(df)
        trees, base, factor = self.grow(rows)
        rows.drop()
        return self._copyValues(TreeEnsembleModel(_node_table(trees, rows.edges), base, factor))

    def _depth(self) -> int | None:
        depth = self.getOrDefault(self.maxDepth)
        return None if depth < 0 else depth


def _node_table(trees: Sequence[Tree], edges: Sequence[np.ndarray]) -> pd.DataFrame:
    """One row a node; a split holds rows up to its threshold on the left, the last bin being open."""
    rows = []
    for t, tree in enumerate(trees):
        for i, (feature, bin_) in enumerate(zip(tree.feature, tree.bin)):
            last = feature >= 0 and bin_ >= len(edges[feature]) - 1
            threshold = float("inf") if last else float(edges[feature][bin_]) if feature >= 0 else 0.0
            rows.append((t, i, feature, threshold, tree.missing_left[i], tree.left[i], tree.right[i], tree.value[i], tree.gain[i]))
    return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _NODES.split(", ")])


def _scored(columns: Sequence[np.ndarray], trees: Sequence[tuple[np.ndarray, ...]], base: float, factor: float) -> np.ndarray:
    values = np.stack(columns, axis=1)
    rows = np.arange(len(values))
    out = np.full(len(values), base)
    for feature, threshold, missing_left, left, right, value in trees:
        node = np.zeros(len(values), dtype=np.int64)
        while True:
            own = feature[node]
            inner = own >= 0
            if not inner.any():
                break
            x = values[rows, np.maximum(own, 0)]
            goes_left = np.where(np.isnan(x), missing_left[node], x <= threshold[node])
            node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
        out += factor * value[node]
    return out


class TreeEnsembleModel(Model, _Columns, MLWritable, MLReadable):
    """``base`` plus ``factor`` times the sum of the trees; its state is a table with a row for every node."""

    def __init__(self, nodes: pd.DataFrame | None = None, base: float = 0.0, factor: float = 1.0):
        super().__init__()
        self.nodes, self.base, self.factor = nodes, base, factor

    def trees(self) -> list[tuple[np.ndarray, ...]]:
        columns = ["feature", "threshold", "missing_left", "left", "right", "value"]
        ordered = self.nodes.sort_values(["tree", "node"])
        return [tuple(g[c].to_numpy() for c in columns) for _, g in ordered.groupby("tree", sort=True)]

    def importance(self) -> dict[str, float]:
        """Each input's share of the gain of all splits."""
        splits = self.nodes[self.nodes["feature"] >= 0].groupby("feature")["gain"].sum()
        total = float(splits.sum())
        return {c: float(splits.get(i, 0.0)) / total if total > 0 else 0.0 for i, c in enumerate(self.getInputCols())}

    def _transform(self, df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        trees, base, factor = self.trees(), self.base, self.factor

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            return pd.Series(_scored([c.to_numpy(dtype=np.float64) for c in columns], trees, base, factor))

        return df.withColumn(self.getPredictionCol(), score(*[number(c) for c in self.getInputCols()]))

    def write(self) -> MLWriter:
        return _EnsembleWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EnsembleReader()


class _EnsembleWriter(MLWriter):
    def __init__(self, model: TreeEnsembleModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        spark = SparkSession.active()
        extra = {"base": self.model.base, "factor": self.model.factor}
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata=extra)
        spark.createDataFrame(self.model.nodes, _NODES).coalesce(1).write.parquet(f"{path}/nodes")


class _EnsembleReader(MLReader):
    def load(self, path: str) -> TreeEnsembleModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        model = TreeEnsembleModel(nodes, metadata["base"], metadata["factor"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class LeafwiseBoosting(_TreeEstimator):
    """Boosting of the squared error with trees that split the leaf of the greatest gain next.

    A leaf's value is shrunk by the L1 and L2 penalties; a split needs ``minGainToSplit`` and leaves of
    ``minDataInLeaf`` rows and ``minSumHessianInLeaf``. Every tree may use a share of the features, and
    every ``baggingFreq`` trees another share of the rows is drawn. Null and NaN inputs go to the side that
    gained most in training. Rows take a byte a feature; from them every growth step collects histograms
    of the open leaves in one aggregate, and every few trees the rows' scores are stored.
    """

    rounds = _param("rounds", "number of trees", TypeConverters.toInt)
    learningRate = _param("learningRate", "factor of every tree", TypeConverters.toFloat)
    numLeaves = _param("numLeaves", "most leaves of a tree", TypeConverters.toInt)
    lambdaL1 = _param("lambdaL1", "L1 penalty of a leaf", TypeConverters.toFloat)
    lambdaL2 = _param("lambdaL2", "L2 penalty of a leaf", TypeConverters.toFloat)
    featureFraction = _param("featureFraction", "share of the features of a tree", TypeConverters.toFloat)
    baggingFraction = _param("baggingFraction", "share of the rows of a tree", TypeConverters.toFloat)
    baggingFreq = _param("baggingFreq", "trees that use the same rows, 0: all rows", TypeConverters.toInt)
    minGainToSplit = _param("minGainToSplit", "a split gains more than this", TypeConverters.toFloat)
    minSumHessianInLeaf = _param("minSumHessianInLeaf", "least sum of second derivatives of a leaf", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=QUANTITY, predictionCol=PREDICTION, seed=42, rounds=100, learningRate=0.1, numLeaves=31,
                 maxDepth=-1, minDataInLeaf=20, lambdaL1=0.0, lambdaL2=0.0, featureFraction=1.0, baggingFraction=1.0, baggingFreq=0,
                 minGainToSplit=0.0, maxBin=255, minSumHessianInLeaf=1e-3):  # fmt: skip  # noqa: N803
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        defaults = dict(labelCol=QUANTITY, predictionCol=PREDICTION, seed=42, rounds=100, learningRate=0.1, numLeaves=31, maxDepth=-1, minDataInLeaf=20,
                        lambdaL1=0.0, lambdaL2=0.0, featureFraction=1.0, baggingFraction=1.0, baggingFreq=0, minGainToSplit=0.0, maxBin=255,
                        minSumHessianInLeaf=1e-3)
        self._setDefault(**defaults)

    def grow(self, rows: BinnedRows) -> tuple[list[Tree], float, float]:
        """The trees, and the number and the factor that make predictions of their sum."""
        get = lambda p: self.getOrDefault(p)
        table, path = rows.table, None
        spark, width, rate = table.sparkSession, len(rows.edges), get(self.learningRate)
        limits = Limits(
            leaves=get(self.numLeaves), depth=self._depth(), leaf_rows=get(self.minDataInLeaf), leaf_hessian=get(self.minSumHessianInLeaf),
            gain=get(self.minGainToSplit), l1=get(self.lambdaL1), l2=get(self.lambdaL2),
        )
        base = table.agg(F.try_divide(F.sum(LABEL_SUM), F.sum(N_LABELS))).first()[0]
        if base is None:
            raise ValueError("no row has a label")
        rng = random.Random(get(self.seed))
        frequency, share = get(self.baggingFreq), get(self.baggingFraction)
        n_features = max(1, round(get(self.featureFraction) * width))
        trees: list[Tree] = []
        pending: list[tuple[np.ndarray, ...]] = []
        for i in range(get(self.rounds)):
            sample = Sample(i // frequency, share) if frequency > 0 else Sample()
            features = sorted(rng.sample(range(width), n_features))

            def look(growing: list[Tree], slots: list[dict[int, int]]) -> list[dict]:
                found = tree_growth.histograms(table, width, [t.arrays() for t in growing], [sample], slots, [features], pending, rate, base)
                return tree_growth.best_splits(found, limits)

            tree = tree_growth.grow(look, 1, limits)[0]
            trees.append(tree)
            if len(tree.feature) == 1 and n_features == width and sample.share == 1.0:
                # Nothing more to split: every further tree would be the same.
                break
            pending.append(tree.arrays())
            if len(pending) == STORE_EVERY and i + 1 < get(self.rounds):
                following = new_path(spark, "scores")
                table = cut_lineage(_with_scores(table, width, pending, rate), following)
                if path:
                    drop_path(spark, path)
                path, pending = following, []
        if path:
            drop_path(spark, path)
        return trees, base, rate


def binned_error(rows: BinnedRows, trees: Sequence[Tree], base: float, factor: float) -> float:
    """Mean absolute error of a grown ensemble on rows in its bins: a value is up to a threshold where its bin is."""
    ship(rows.table.sparkSession)
    width, arrays = len(rows.edges), [t.arrays() for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, off = 0, 0.0
            for bins, label, score, _ in chunks(*tree_growth.unpack(batch, width)):
                n, off = n + len(label), off + float(np.abs(tree_growth.advanced(score + base, bins, arrays, factor) - label).sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([off])], names=["n", "off"])

    found = rows.table.select(BINS, LABEL, SCORE, DRAW).mapInArrow(run, "n long, off double")
    return found.agg(F.try_divide(F.sum("off"), F.sum("n"))).first()[0]


def _with_scores(table: DataFrame, width: int, trees: Sequence[tuple[np.ndarray, ...]], rate: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, score, _ = tree_growth.unpack(batch, width)
            place = batch.schema.get_field_index(SCORE)
            sizes = batch.column(batch.schema.get_field_index(N_LABELS)).to_numpy()
            yield batch.set_column(place, SCORE, packed(tree_growth.advanced(score, bins, trees, rate), sizes))

    return table.mapInArrow(run, BINNED)


class HistogramForest(_TreeEstimator):
    """Mean of trees on samples with replacement; a node is split only from ``minSamplesSplit`` rows on.

    Several trees grow together from the same passes over the rows.
    """

    numTrees = _param("numTrees", "number of trees", TypeConverters.toInt)
    minSamplesSplit = _param("minSamplesSplit", "least rows of a node that is split", TypeConverters.toInt)
    bootstrap = _param("bootstrap", "whether trees see samples with replacement", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=QUANTITY, predictionCol=PREDICTION, seed=42, numTrees=100, maxDepth=10, minSamplesSplit=2,
                 minDataInLeaf=1, bootstrap=True, maxBin=255):  # fmt: skip  # noqa: N803
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(labelCol=QUANTITY, predictionCol=PREDICTION, seed=42, numTrees=100, maxDepth=10, minSamplesSplit=2, minDataInLeaf=1, bootstrap=True, maxBin=255)

    def grow(self, rows: BinnedRows) -> tuple[list[Tree], float, float]:
        """The trees, and the number and the factor that make predictions of their sum."""
        get = lambda p: self.getOrDefault(p)
        table, width, n_trees = rows.table, len(rows.edges), get(self.numTrees)
        limits = Limits(leaves=None, depth=self._depth(), split_rows=get(self.minSamplesSplit), leaf_rows=get(self.minDataInLeaf), leaf_hessian=0.0)
        trees: list[Tree] = []
        # Without sampling all trees would be the same.
        different = n_trees if get(self.bootstrap) else 1
        for at in range(0, different, TOGETHER):
            part = range(at, min(at + TOGETHER, different))
            samples = [Sample(get(self.seed) + i, None) if get(self.bootstrap) else Sample() for i in part]

            def look(growing: list[Tree], slots: list[dict[int, int]]) -> list[dict]:
                every = [range(width)] * len(growing)
                found = tree_growth.histograms(table, width, [t.arrays() for t in growing], samples, slots, every)
                return tree_growth.best_splits(found, limits)

            trees += tree_growth.grow(look, len(part), limits)
        return trees, 0.0, 1.0 / max(1, len(trees))


def is_histogram_learner(regressor: Estimator) -> bool:
    return isinstance(regressor, _TreeEstimator)
