"""Tree regressors: training, scoring, importance, cross-validation, storage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from shelfcast.operators.evaluation import regression_metrics
from shelfcast.operators.rows import concat, with_fold
from shelfcast.plans.ensembles import HistogramForest, LeafwiseBoosting, TreeEnsembleModel, is_histogram_learner
from shelfcast.plans.grown import fit_grown, joint_growth, seen_rows
from shelfcast.schema import PREDICTION, QUANTITY, ROW_ID
from shelfcast.session import cut_lineage, small_splits

#: The inputs of MLlib's learners.
VECTOR = "__features"

_PREFIXES = ("__filled_", "__missing_")


def random_forest(label: str = QUANTITY, *, seed: int = 42, **params: object) -> RandomForestRegressor:
    """All features are tried at every split unless ``featureSubsetStrategy`` says otherwise."""
    params = {"featureSubsetStrategy": "all", "numTrees": 100, "maxDepth": 10, **params}
    return RandomForestRegressor(featuresCol="__features", labelCol=label, predictionCol=PREDICTION, seed=seed, **params)


def boosted_trees(label: str = QUANTITY, *, seed: int = 42, **params: object) -> GBTRegressor:
    params = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, **params}
    return GBTRegressor(featuresCol="__features", labelCol=label, predictionCol=PREDICTION, seed=seed, **params)


def leafwise_boosting(label: str = QUANTITY, **params: object) -> LeafwiseBoosting:
    """Leaf-wise boosted trees with leaf count, penalties, bagging and histogram bins as parameters."""
    return LeafwiseBoosting(labelCol=label, predictionCol=PREDICTION, **params)


def histogram_forest(label: str = QUANTITY, **params: object) -> HistogramForest:
    """A forest whose nodes need a number of rows to be split."""
    return HistogramForest(labelCol=label, predictionCol=PREDICTION, **params)


def regression_pipeline(regressor: Estimator, features: Sequence[str], means: dict[str, float], flagged: Sequence[str] | None = None) -> Pipeline:
    """Fill missing inputs (null or NaN) with ``means``, add a 0/1 column for "was missing" for the ``flagged`` inputs
    (None: all), regress.

    A column that is 0 in all training rows splits none of them, so an input that is never missing there needs
    no such column. Histogram trees take the inputs as they are, missing ones included.
    """
    if is_histogram_learner(regressor):
        return Pipeline(stages=[regressor.copy().setInputCols(features)])
    flagged = [c for c in features if flagged is None or c in flagged]
    number = {c: f"nanvl(CAST(`{c}` AS DOUBLE), NULL)" for c in features}
    filled = [f"coalesce({x}, {means[c]!r}D) AS `__filled_{c}`" for c, x in number.items()]
    flags = [f"CAST({number[c]} IS NULL AS DOUBLE) AS `__missing_{c}`" for c in flagged]
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join([*filled, *flags])} FROM __THIS__"),
            VectorAssembler(inputCols=[*[f"__filled_{c}" for c in features], *[f"__missing_{c}" for c in flagged]], outputCol="__features"),
            regressor,
        ]
    )


def input_means(df: DataFrame, features: Sequence[str]) -> tuple[dict[str, float], list[str]]:
    """Mean of the present values of every input, 0 where there is none, and the inputs that are missing somewhere."""
    present = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in features}
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(present.values())]
    counts = [F.count(x).alias(f"n{i}") for i, x in enumerate(present.values())]
    found = df.agg(F.count(F.lit(1)).alias("n"), *means, *counts).first()
    filling = {c: found[f"m{i}"] if found[f"m{i}"] is not None else 0.0 for i, c in enumerate(present)}
    return filling, [c for i, c in enumerate(present) if found[f"n{i}"] < found["n"]]


def fold_means(df: DataFrame, features: Sequence[str], folds: int, fold: str) -> list[tuple[dict[str, float], list[str]]]:
    """:func:`input_means` of the rows outside of every fold, from one scan."""
    present = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in features]
    counts = [F.count(F.lit(1)).alias("n"), *[F.count(x).alias(f"n{i}") for i, x in enumerate(present)]]
    found = df.groupBy(fold).agg(*counts, *[F.sum(x).alias(f"s{i}") for i, x in enumerate(present)]).collect()
    out = []
    for own in range(folds):
        rows = [r for r in found if r[fold] != own]
        total = lambda name: sum(r[name] or 0 for r in rows)  # noqa: B023, E731
        means = {c: total(f"s{i}") / total(f"n{i}") if total(f"n{i}") else 0.0 for i, c in enumerate(features)}
        out.append((means, [c for i, c in enumerate(features) if total(f"n{i}") < total("n")]))
    return out


def train(df: DataFrame, regressor: Estimator, features: Sequence[str]) -> PipelineModel:
    """A model of the rows with a label; count the others with ``null_counts`` if they matter.

    Small ensembles of MLlib's (:func:`joint_growth`) are grown by scans of the rows in bins, and the model is MLlib's.
    """
    label = regressor.getLabelCol()
    needed = dict.fromkeys([*features, label])
    known = df.where(F.col(label).isNotNull()).select(*needed).withColumn(label, F.col(label).cast("double"))
    growth = joint_growth(regressor, len(features))
    if growth is None:
        with small_splits(df.sparkSession):
            means, flagged = ({}, []) if is_histogram_learner(regressor) else input_means(known, features)
            return regression_pipeline(regressor, features, means, flagged).fit(known)
    # Scans that keep no rows take splits as large as they come: a task of Python has a cost of its own.
    seen = seen_rows(known, regressor, features)
    flagged = [c for c, missing in zip(features, seen.missing) if missing]
    *inputs, learner = regression_pipeline(regressor, features, dict(zip(features, seen.means.tolist())), flagged).getStages()
    growth = joint_growth(learner, len(features) + len(flagged))
    return PipelineModel([*inputs, fit_grown(known, learner, growth, features, flagged, seen)])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` to every row."""
    out = model.transform(df)
    helpers = [c for c in out.columns if c == "__features" or c.startswith(_PREFIXES)]
    return out.drop(*helpers)


def save_model(model: PipelineModel, path: str) -> None:
    """Write the model, then a mark that it is whole."""
    model.write().overwrite().save(path)
    SparkSession.active().range(1).write.parquet(f"{path}/complete")


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether a whole model is stored there; one that was interrupted does not count."""
    try:
        return spark.read.parquet(f"{path}/complete").count() == 1
    except AnalysisException:
        return False


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not model_exists(spark, path):
        raise ValueError(f"{path} holds no saved model")
    return PipelineModel.load(path)


def train_or_load(
    df: DataFrame, regressor: Estimator, features: Sequence[str], path: str, *, force: bool = False
) -> PipelineModel:
    """The stored model, or with ``force`` or nothing stored a new one that is then stored."""
    if not force and model_exists(df.sparkSession, path):
        return load_model(df.sparkSession, path)
    model = train(df, regressor, features)
    save_model(model, path)
    return model


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(feature, importance), highest first; the "was missing" part of an input counts with it."""
    trees = model.stages[-1]
    weights: dict[str, float] = {}
    if isinstance(trees, TreeEnsembleModel):
        weights = trees.importance()
    else:
        for name, weight in zip(model.stages[-2].getInputCols(), trees.featureImportances.toArray(), strict=True):
            feature = name.removeprefix("__filled_").removeprefix("__missing_")
            weights[feature] = weights.get(feature, 0.0) + float(weight)
    table = spark.createDataFrame(list(weights.items()), "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def evaluate(model: PipelineModel, df: DataFrame, label: str = QUANTITY) -> DataFrame:
    """Metrics of one fitted model on held-out rows."""
    return regression_metrics(predict(model, df), label)


def fold_predictions(
    df: DataFrame,
    regressor: Estimator,
    features: Sequence[str],
    *,
    folds: int = 3,
    row_key: Sequence[str] = (ROW_ID,),
) -> DataFrame:
    """Each row predicted by the model that did not see its fold."""
    return _predicted(with_fold(df, folds, row_key), regressor, features, folds)


def _predicted(data: DataFrame, regressor: Estimator, features: Sequence[str], folds: int) -> DataFrame:
    label = regressor.getLabelCol()
    known = data.where(F.col(label).isNotNull()).select(*dict.fromkeys([*features, label, "fold"])).withColumn(label, F.col(label).cast("double"))
    parts = []
    with small_splits(data.sparkSession):
        inputs = [({}, [])] * folds if is_histogram_learner(regressor) else fold_means(known, features, folds, "fold")
        for i, (means, flagged) in enumerate(inputs):
            model = regression_pipeline(regressor, features, means, flagged).fit(known.where(F.col("fold") != i).drop("fold"))
            parts.append(predict(model, data.where(F.col("fold") == i)))
    return concat(parts)


def stored_folds(df: DataFrame, regressor: Estimator, features: Sequence[str], folds: int, row_key: Sequence[str], fold: str | None) -> tuple[DataFrame, bool]:
    """What fits need of every row and its ``fold``, stored once, so that row keys are read and hashed once; and
    whether the inputs are stored as the vectors that MLlib's learners take.

    Where an input is missing somewhere its filling depends on the training rows; then, and for histogram trees, the
    inputs are columns. ``fold`` names a column that holds the folds already; without it they come from the row key.
    """
    label = regressor.getLabelCol()
    data = with_fold(df, folds, row_key) if fold is None else df.withColumnRenamed(fold, "fold")
    keep = [F.col(label).cast("double").alias(label), "fold"]
    if is_histogram_learner(regressor):
        return cut_lineage(data.select(*[c for c in dict.fromkeys(features) if c != label], *keep)), False
    numbers = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features]
    seen = Observation()
    incomplete = reduce(Column.__or__, [F.isnan(x) for x in numbers], F.lit(False))
    stored = cut_lineage(data.observe(seen, F.count_if(incomplete).alias("n")).select(array_to_vector(F.array(*numbers)).alias(VECTOR), *keep))
    if seen.get["n"] == 0:
        return stored, True
    own = vector_to_array(VECTOR)
    return stored.select(*[F.get(own, F.lit(i)).alias(c) for i, c in enumerate(features) if c != label], label, "fold"), False


def cross_validate(
    df: DataFrame,
    regressor: Estimator,
    features: Sequence[str],
    *,
    folds: int = 3,
    row_key: Sequence[str] = (ROW_ID,),
    fold: str | None = None,
) -> DataFrame:
    """One row of metrics per fold, each from a fresh model fitted on the other folds.

    The rows are stored here, so ``df`` need not be. ``fold`` names a column of folds to be used instead of the row key.
    """
    label = regressor.getLabelCol()
    data, vectors = stored_folds(df, regressor, features, folds, row_key, fold)
    if not vectors:
        return regression_metrics(_predicted(data, regressor, features, folds), label, by=("fold",))
    known, parts = data.where(F.col(label).isNotNull()), []
    with small_splits(df.sparkSession):
        for i in range(folds):
            model = regressor.fit(known.where(F.col("fold") != i).drop("fold"))
            parts.append(model.transform(data.where(F.col("fold") == i)).drop(VECTOR))
    return regression_metrics(concat(parts), label, by=("fold",))


def mean_scores(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(*[F.avg(c).alias(c) for c in per_fold.columns if c.startswith("test_")])
