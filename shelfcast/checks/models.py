"""Registered queries that fit models. Trees and k-means have no SQL form, so most check rows only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.checks.common import FORECAST_START, Query, calendar, sales
from shelfcast.checks.features import features_table, flagged_features, folded_features, inputs
from shelfcast.operators.daily import daily_category, daily_sku
from shelfcast.operators.profile import cluster_profile as profile_clusters
from shelfcast.operators.rows import split_train_test
from shelfcast.plans import clusters, forecast, models, tuning
from shelfcast.plans.features import feature_columns, stored_features
from shelfcast.schema import HORIZON_DAYS, QUANTITY
from shelfcast.session import cut_lineage, new_path
from shelfcast.sources.sales import write_csv

# Small models, so that the whole tables can be used everywhere.
_FOREST = {"numTrees": 5, "maxDepth": 5}
_BOOSTED = {"maxIter": 5, "maxDepth": 4}


def _table(spark: SparkSession, tables: str) -> DataFrame:
    return cut_lineage(features_table(spark, tables))


def clustered(spark: SparkSession, tables: str, *, row_id: bool = True) -> DataFrame:
    table = stored_features(sales(spark, tables, row_id=row_id), calendar(spark), drop_nulls=False)
    return clusters.assign_clusters(clusters.fit_clusters(table), table)


def cluster_profile(spark: SparkSession, tables: str) -> DataFrame:
    # Row keys are no features and not part of the profile.
    return profile_clusters(clustered(spark, tables, row_id=False))


def elbow(spark: SparkSession, tables: str) -> DataFrame:
    # Row keys are no features: without them the one exchange of the fact and the stored table are narrower.
    return clusters.elbow(cut_lineage(features_table(spark, tables, row_id=False)))


def forest_predictions(spark: SparkSession, tables: str) -> DataFrame:
    train, test = split_train_test(flagged_features(spark, tables), flag="is_test")
    model = models.train(train, models.random_forest(**_FOREST), feature_columns(train))
    return models.predict(model, test)


def boosted_predictions(spark: SparkSession, tables: str) -> DataFrame:
    train, test = split_train_test(flagged_features(spark, tables), flag="is_test")
    model = models.train(train, models.boosted_trees(**_BOOSTED), feature_columns(train))
    return models.predict(model, test)


def feature_importance(spark: SparkSession, tables: str) -> DataFrame:
    table = _table(spark, tables)
    model = models.train(table, models.random_forest(**_FOREST), feature_columns(table))
    return models.feature_importance(model, spark)


def cross_validation(spark: SparkSession, tables: str) -> DataFrame:
    table = folded_features(spark, tables)
    return models.cross_validate(table, models.random_forest(**_FOREST), inputs(table), fold="fold")


def cross_validation_means(spark: SparkSession, tables: str) -> DataFrame:
    return models.mean_scores(cross_validation(spark, tables))


def parameter_search(spark: SparkSession, tables: str) -> DataFrame:
    table = folded_features(spark, tables)
    space = {
        "numTrees": tuning.Ints(2, 6),
        "maxDepth": tuning.Ints(2, 5, log=True),
        "minInstancesPerNode": tuning.Ints(1, 16),
        "bootstrap": tuning.Choice((True, False)),
    }
    _, trials = tuning.search(table, models.random_forest(), inputs(table), space, trials=3, fold="fold")
    return trials


def adaptive_search(spark: SparkSession, tables: str) -> DataFrame:
    """Leaf-wise trees whose later trials are drawn near the good ones."""
    table = folded_features(spark, tables, folds=2)
    space = {
        "numLeaves": tuning.Ints(2, 8),
        "learningRate": tuning.Floats(0.05, 1.0, log=True),
        "lambdaL2": tuning.Floats(1e-8, 10.0, log=True),
    }
    learner = models.leafwise_boosting(rounds=1, maxDepth=3)
    _, trials = tuning.adaptive_search(table, learner, inputs(table), space, trials=4, folds=2, fold="fold", startup=2)
    return trials


def holdout_metrics(spark: SparkSession, tables: str) -> DataFrame:
    train, test = split_train_test(flagged_features(spark, tables), flag="is_test")
    model = models.train(train, models.boosted_trees(**_BOOSTED), feature_columns(train))
    return models.evaluate(model, test)


def stored_model(spark: SparkSession, tables: str) -> DataFrame:
    """Train and store, load again, score with the loaded model."""
    train, test = split_train_test(flagged_features(spark, tables), flag="is_test")
    path = new_path(spark, "model")
    regressor, names = models.random_forest(**_FOREST), feature_columns(train)
    models.train_or_load(train, regressor, names, path)
    return models.predict(models.train_or_load(train, regressor, names, path), test)


def _past_and_model(spark: SparkSession, tables: str):
    rows = sales(spark, tables, row_id=True)
    # Lags and averages look back only, so the features of the past are those of past sales; row keys are no features.
    past = stored_features(sales(spark, tables).where(F.col("date") < F.lit(FORECAST_START)), calendar(spark))
    grouping = clusters.fit_clusters(past)
    with_clusters = clusters.assign_clusters(grouping, past)
    model = models.train(with_clusters, models.boosted_trees(**_BOOSTED), feature_columns(with_clusters))
    return rows, grouping, model


def backtest_rows(spark: SparkSession, tables: str) -> DataFrame:
    rows, grouping, model = _past_and_model(spark, tables)
    compared, _ = forecast.backtest(rows, model, calendar(spark), FORECAST_START, clusters=grouping)
    return compared


def backtest_metrics(spark: SparkSession, tables: str) -> DataFrame:
    rows, grouping, model = _past_and_model(spark, tables)
    _, metrics = forecast.backtest(rows, model, calendar(spark), FORECAST_START, clusters=grouping)
    return metrics


def future_forecast(spark: SparkSession, tables: str) -> DataFrame:
    """Forecast job from a CSV of future rows to a CSV of filled rows."""
    rows, grouping, model = _past_and_model(spark, tables)
    last = FORECAST_START + dt.timedelta(days=HORIZON_DAYS - 1)
    future = new_path(spark, "future")
    write_csv(rows.where(F.col("date").between(F.lit(FORECAST_START), F.lit(last))).drop(QUANTITY, "row_id"), future)
    past = rows.where(F.col("date") < F.lit(FORECAST_START))
    return forecast.forecast_file(
        spark,
        future,
        new_path(spark, "forecast-csv"),
        daily_sku(past),
        daily_category(past),
        model,
        calendar(spark),
        clusters=grouping,
    )


QUERIES: dict[str, Query] = {
    "clustered": clustered,
    "cluster_profile": cluster_profile,
    "elbow": elbow,
    "forest_predictions": forest_predictions,
    "boosted_predictions": boosted_predictions,
    "feature_importance": feature_importance,
    "cross_validation": cross_validation,
    "cross_validation_means": cross_validation_means,
    "parameter_search": parameter_search,
    "adaptive_search": adaptive_search,
    "holdout_metrics": holdout_metrics,
    "stored_model": stored_model,
    "backtest_rows": backtest_rows,
    "backtest_metrics": backtest_metrics,
    "future_forecast": future_forecast,
}

ORACLES: dict[str, str] = {}
