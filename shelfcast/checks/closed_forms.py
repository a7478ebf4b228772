"""Registered queries whose models have a closed form, so that SQL gives the same values.

A tree without splits predicts the mean of its training rows; a fixed formula takes the place of a fitted
model in the day-by-day forecast, which SQL then unrolls; clusters are checked by what defines them.
"""

from __future__ import annotations

import datetime as dt
import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.checks.common import FORECAST_START, PRESENT, Query, calendar, rounded, sales, sql
from shelfcast.checks.features import features_table, folded_features, inputs
from shelfcast.operators.daily import daily_category, daily_sku
from shelfcast.operators.evaluation import regression_metrics
from shelfcast.operators.profile import cluster_profile
from shelfcast.operators.rows import with_test_flag
from shelfcast.plans import artefacts, clusters, forecast, models, tuning
from shelfcast.plans.features import feature_columns, stored_features
from shelfcast.schema import CATEGORY, CLUSTER, DATE, HORIZON_DAYS, PREDICTION, PRICE, QUANTITY, SKU
from shelfcast.session import cut_lineage, new_path
from shelfcast.sources.sales import write_csv

_STUMP = {"numTrees": 1, "maxDepth": 0, "bootstrap": False}
_BOOSTED_STUMP = {"maxIter": 1, "maxDepth": 0}
_SMALL = {"numTrees": 5, "maxDepth": 5}
_METRICS = ("test_neg_root_mean_squared_error", "test_neg_mean_absolute_error", "test_explained_variance")

_FORMULA = (
    "0.5 * coalesce(lag_1_sales_quantity, 1) + 0.25 * coalesce(lag_2_sales_quantity, 1) "
    "+ 0.125 * coalesce(sma_5_sales_quantity, 2) + coalesce(lag_3_sales_price, 0) / 65536"
)


def _halves(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame]:
    flagged = cut_lineage(with_test_flag(features_table(spark, tables)))
    return flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")


def _mean_predictions(spark: SparkSession, tables: str, regressor) -> DataFrame:
    train, test = _halves(spark, tables)
    predicted = models.predict(models.train(train, regressor, feature_columns(train)), test)
    return rounded(predicted.select("row_id", QUANTITY, PREDICTION), PREDICTION)


def forest_of_means(spark: SparkSession, tables: str) -> DataFrame:
    return _mean_predictions(spark, tables, models.random_forest(**_STUMP))


def boosted_means(spark: SparkSession, tables: str) -> DataFrame:
    return _mean_predictions(spark, tables, models.boosted_trees(**_BOOSTED_STUMP))


def holdout_metrics_of_means(spark: SparkSession, tables: str) -> DataFrame:
    train, test = _halves(spark, tables)
    model = models.train(train, models.random_forest(**_STUMP), feature_columns(train))
    return rounded(models.evaluate(model, test), *_METRICS)


def cross_validation_of_means(spark: SparkSession, tables: str) -> DataFrame:
    table = folded_features(spark, tables)
    return rounded(models.cross_validate(table, models.random_forest(**_STUMP), inputs(table), fold="fold"), *_METRICS)


def cross_validation_mean_of_means(spark: SparkSession, tables: str) -> DataFrame:
    table = folded_features(spark, tables)
    per_fold = models.cross_validate(table, models.random_forest(**_STUMP), inputs(table), fold="fold")
    return rounded(models.mean_scores(per_fold), *_METRICS)


def stored_model_agrees(spark: SparkSession, tables: str) -> DataFrame:
    """Test rows, and how many of them a stored and loaded forest scores otherwise than the forest itself."""
    train, test = _halves(spark, tables)
    path, names = new_path(spark, "model"), feature_columns(train)
    first = models.train_or_load(train, models.random_forest(**_SMALL), names, path)
    again = models.train_or_load(train, models.random_forest(**_SMALL), names, path)
    own, other = (models.predict(m, test).select("row_id", F.col(PREDICTION).alias(n)) for m, n in ((first, "a"), (again, "b")))
    both = own.join(other, "row_id", "full")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"))


def importance_total(spark: SparkSession, tables: str) -> DataFrame:
    table = cut_lineage(features_table(spark, tables))
    model = models.train(table, models.random_forest(**_SMALL), feature_columns(table))
    out = models.feature_importance(model, spark)
    return out.agg(F.count_distinct("feature").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"))


def cluster_checks(spark: SparkSession, tables: str) -> DataFrame:
    """Rows, rows without a cluster, clustered rows that another centre is nearer to, and the table means
    put together again from the cluster profile."""
    # Row keys are no features and are not given out; a second table of all rows with their clusters is not stored.
    table = stored_features(sales(spark, tables), calendar(spark), drop_nulls=False)
    model = clusters.fit_clusters(table)
    assigned = clusters.assign_clusters(model, table)
    scaled = PipelineModel(model.stages[:3]).transform(assigned)
    found = clusters.farther_rows(scaled, model.stages[3].clusterCenters())
    counts = spark.createDataFrame([found], "n_rows long, n_without long, n_not_nearest long")
    profile = cluster_profile(assigned)
    mean = lambda c: F.round(F.sum(F.col("size") * F.col(c)) / F.sum("size"), 6).alias(c)
    return counts.crossJoin(profile.agg(mean("mean_price"), mean("mean_quantity"), F.sum("size").alias("size")))


def elbow_start(spark: SparkSession, tables: str) -> DataFrame:
    """The cost of a single cluster: rows times the columns that vary."""
    out = clusters.elbow(cut_lineage(features_table(spark, tables, row_id=False)), max_k=2)
    return out.where("k = 1").select("k", F.round("wcss", 3).alias("wcss"))


#: Centres of one shared Lloyd step, by their number: price and quantity.
_CENTRES = {2: [(20000.0, 10.0), (60000.0, 40.0)], 3: [(10000.0, 5.0), (40000.0, 25.0), (80000.0, 45.0)]}


def elbow_step(spark: SparkSession, tables: str) -> DataFrame:
    """One scan that assigns every sale to the nearest of two and of three centres and adds up both."""
    rows = sales(spark, tables, category=False).select(PRICE, QUANTITY)
    centres = {k: np.array(c) for k, c in _CENTRES.items()}
    found = clusters.shared_step(rows, np.zeros(2), np.array([1000.0, 1.0]), {k: c / [1000.0, 1.0] for k, c in centres.items()})
    out = [(k, i, int(n[i]), round(float(summed[i][1]), 3), round(cost, 1)) for k, (n, summed, cost) in found.items() for i in range(k)]
    return spark.createDataFrame(out, "k int, centre int, n long, quantity double, cost double")


def _search_checks(spark: SparkSession, tables: str, regressor, space: dict) -> DataFrame:
    table = folded_features(spark, tables)
    best, trials = tuning.search(table, regressor, inputs(table), space, fold="fold")
    rows = trials.collect()
    fitted = {p.name: v for p, v in best.stages[-1].extractParamMap().items()}
    wanted = json.loads(rows[0]["params"])
    same = all(abs(float(fitted[k]) - float(v)) < 1e-9 for k, v in wanted.items())
    least = rows[0]["mae"] == min(r["mae"] for r in rows)
    return spark.createDataFrame([(len(rows), least, same)], "n_trials long, best_first boolean, refitted boolean")


def forest_search(spark: SparkSession, tables: str) -> DataFrame:
    space = {"numTrees": tuning.Ints(2, 4), "maxDepth": tuning.Ints(1, 4, log=True), "minInstancesPerNode": tuning.Ints(1, 16)}
    return _search_checks(spark, tables, models.random_forest(), space)


def boosted_search(spark: SparkSession, tables: str) -> DataFrame:
    space = {
        "maxIter": tuning.Ints(1, 3),
        "stepSize": tuning.Floats(1e-3, 1e-1, log=True),
        "maxDepth": tuning.Ints(1, 3),
        "minWeightFractionPerNode": tuning.Floats(1e-6, 1e-2, log=True),
    }
    return _search_checks(spark, tables, models.boosted_trees(), space)


def _formula() -> PipelineModel:
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({_FORMULA} AS DOUBLE) AS {PREDICTION} FROM __THIS__")])


def backtest_by_formula(spark: SparkSession, tables: str) -> DataFrame:
    compared, _ = forecast.backtest(sales(spark, tables, row_id=True), _formula(), calendar(spark), FORECAST_START)
    return rounded(compared.select("row_id", DATE, SKU, CATEGORY, QUANTITY, f"{QUANTITY}_right"), QUANTITY)


def backtest_metrics_by_formula(spark: SparkSession, tables: str) -> DataFrame:
    _, metrics = forecast.backtest(sales(spark, tables, row_id=True), _formula(), calendar(spark), FORECAST_START)
    return rounded(metrics, *_METRICS)


def future_by_formula(spark: SparkSession, tables: str) -> DataFrame:
    """The forecast job from a CSV of future rows to the CSV it writes, read back."""
    rows = sales(spark, tables, row_id=True)
    last = FORECAST_START + dt.timedelta(days=HORIZON_DAYS - 1)
    future, past = new_path(spark, "future"), rows.where(F.col(DATE) < F.lit(FORECAST_START))
    write_csv(rows.where(F.col(DATE).between(F.lit(FORECAST_START), F.lit(last))).drop(QUANTITY, "row_id"), future)
    out = forecast.forecast_file(
        spark, future, new_path(spark, "forecast-csv"), daily_sku(past), daily_category(past), _formula(), calendar(spark)
    )
    return rounded(out, QUANTITY)


def stored_forecaster_by_formula(spark: SparkSession, tables: str) -> DataFrame:
    """Fitted on the past, stored, loaded again, and given the future rows."""
    rows = sales(spark, tables, row_id=True)
    last = FORECAST_START + dt.timedelta(days=HORIZON_DAYS - 1)
    future, past = rows.where(F.col(DATE).between(F.lit(FORECAST_START), F.lit(last))), rows.where(F.col(DATE) < F.lit(FORECAST_START))
    path = new_path(spark, "forecaster")
    artefacts.DemandForecaster(_formula(), calendar(spark), clusters=0).fit(past).write().save(path)
    out = artefacts.DemandForecasterModel.load(path).transform(future.drop(QUANTITY))
    return rounded(out.select("row_id", DATE, SKU, CATEGORY, PRICE, QUANTITY), QUANTITY)


def holdout_by_formula(spark: SparkSession, tables: str) -> DataFrame:
    """Random rows scored in one pass from the history of the others."""
    flagged = cut_lineage(with_test_flag(sales(spark, tables, row_id=True)))
    train, test = flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")
    scored = forecast.holdout_forecast(test, daily_sku(train), daily_category(train), _formula(), calendar(spark))
    return rounded(regression_metrics(scored), *_METRICS)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        forest_of_means, boosted_means, holdout_metrics_of_means, cross_validation_of_means, cross_validation_mean_of_means,
        stored_model_agrees, importance_total, cluster_checks, elbow_start, elbow_step, forest_search, boosted_search,
        backtest_by_formula, backtest_metrics_by_formula, future_by_formula, holdout_by_formula,
        stored_forecaster_by_formula,
    )
}

_FLAG = "CAST('0x' || substr(md5(row_id || '|'), 1, 8) AS BIGINT) % 100 < 12"
_PARTED = f"whole AS (SELECT *, CAST(sales_quantity AS DOUBLE) AS y, {_FLAG} AS is_test FROM features WHERE {PRESENT})"
_FOLDS = f"""
folds AS (SELECT CAST(sales_quantity AS DOUBLE) AS y,
    CAST(CAST('0x' || substr(md5(row_id || '|fold'), 1, 8) AS BIGINT) % 100 % 3 AS INTEGER) AS fold FROM features WHERE {PRESENT}),
guessed AS (SELECT f.fold, f.y, (SELECT sum(o.y) / count(*) FROM folds o WHERE o.fold <> f.fold) AS p FROM folds f)"""


def _score(y: str, p: str, digits: int | None = 6) -> str:
    values = (f"-sqrt(avg(({y} - {p}) * ({y} - {p})))", f"-avg(abs({y} - {p}))", f"1 - var_pop({y} - {p}) / var_pop({y})")
    cut = (lambda v: v) if digits is None else (lambda v: f"round({v}, {digits}) + 0.0")
    return ", ".join(f"{cut(v)} AS {name}" for v, name in zip(values, _METRICS))


_N = "count({0} + {1}) AS n_rows, count(*) FILTER ({0} + {1} IS NULL) AS n_skipped"
_MEANS = "SELECT row_id, sales_quantity, round((SELECT avg(y) FROM whole WHERE NOT is_test), 6) AS prediction FROM whole WHERE is_test"


def _unrolled() -> str:
    """The forecast day by day: what is known of each key, the formula, and the day's own totals."""
    start = f"DATE '{FORECAST_START}'"
    parts = []
    for key, name, k in (("sku_id", "sku", 3), ("category_id", "category", 5)):
        parts.append(f"""
base_{name} AS MATERIALIZED (SELECT {key} AS key, date, avg(sales_price) AS p,
    CAST(coalesce(sum(sales_quantity), 0) AS DOUBLE) AS q FROM sales WHERE date < {start} GROUP BY {key}, date
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY date DESC) <= {k})""")
    formula = (
        "0.5 * coalesce(s.r[1].q, 1) + 0.25 * coalesce(s.r[2].q, 1) "
        "+ 0.125 * coalesce(list_avg(list_transform(c.r, lambda x: x.q)), 2) + coalesce(s.r[3].p, 0) / 65536"
    )
    for i in range(HORIZON_DAYS):
        for key, name, k in (("sku_id", "sku", 3), ("category_id", "category", 5)):
            pool = "".join(f" UNION ALL SELECT * FROM day_{name}_{j}" for j in range(i))
            parts.append(f"""
known_{name}_{i} AS (SELECT key, list({{'p': p, 'q': q}} ORDER BY date DESC)[1:{k}] AS r
  FROM (SELECT * FROM base_{name}{pool}) GROUP BY key)""")
        parts.append(f"""
forecast_{i} AS MATERIALIZED (SELECT x.row_id, x.date, x.sku_id, x.category_id, x.sales_price, {formula} AS q, x.sales_quantity AS y
  FROM sales x LEFT JOIN known_sku_{i} s ON s.key = x.sku_id LEFT JOIN known_category_{i} c ON c.key = x.category_id
  WHERE x.date = {start} + {i})""")
        for key, name in (("sku_id", "sku"), ("category_id", "category")):
            parts.append(f"""
day_{name}_{i} AS MATERIALIZED (SELECT {key}, date, avg(sales_price), sum(q) FROM forecast_{i} GROUP BY ALL)""")
    every = " UNION ALL ".join(f"SELECT * FROM forecast_{i}" for i in range(HORIZON_DAYS))
    return ",".join(parts) + f",\nforecasts AS ({every})"


def _served() -> str:
    """The test rows with the last days of their SKU and category among the training rows."""
    parts = []
    for key, name, k in (("sku_id", "sku", 3), ("category_id", "category", 5)):
        parts.append(f"""
days_{name} AS (SELECT {key}, date, avg(sales_price) AS p, CAST(coalesce(sum(sales_quantity), 0) AS DOUBLE) AS q
    FROM split WHERE NOT is_test GROUP BY ALL),
arrays_{name} AS (SELECT {key}, date, list({{'p': p, 'q': q}}) OVER (PARTITION BY {key} ORDER BY date
    ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS recent FROM days_{name})""")
    return ",".join(parts) + """,
served AS (SELECT CAST(x.sales_quantity AS DOUBLE) AS y, 0.5 * coalesce(s.recent[-1].q, 1) + 0.25 * coalesce(s.recent[-2].q, 1)
    + 0.125 * coalesce(list_avg(list_transform(c.recent, lambda v: v.q)), 2) + coalesce(s.recent[-3].p, 0) / 65536 AS p
  FROM (SELECT * FROM split WHERE is_test) x ASOF LEFT JOIN arrays_sku s ON s.sku_id = x.sku_id AND s.date <= x.date
  ASOF LEFT JOIN arrays_category c ON c.category_id = x.category_id AND c.date <= x.date)"""


_VARYING = (
    "category_id sku_id sales_price year month day weekday is_ukrainian_holiday lag_1_sales_price lag_2_sales_price "
    "lag_3_sales_price lag_1_sales_quantity lag_2_sales_quantity lag_3_sales_quantity sma_5_sales_price sma_5_sales_quantity"
).split()

ORACLES: dict[str, str] = {
    "forest_of_means": sql(_MEANS, "features", extra=_PARTED),
    "boosted_means": sql(_MEANS, "features", extra=_PARTED),
    "holdout_metrics_of_means": sql(
        f"SELECT {_score('y', 'p')}, {_N.format('y', 'p')} FROM scored",
        "features",
        extra=f"{_PARTED}, scored AS (SELECT y, (SELECT avg(y) FROM whole WHERE NOT is_test) AS p FROM whole WHERE is_test)",
    ),
    "cross_validation_of_means": sql(
        f"SELECT fold, {_score('y', 'p')}, {_N.format('y', 'p')} FROM guessed GROUP BY fold", "features", extra=_FOLDS
    ),
    "cross_validation_mean_of_means": sql(
        f"SELECT {', '.join(f'round(avg({m}), 6) + 0.0 AS {m}' for m in _METRICS)} "
        f"FROM (SELECT fold, {_score('y', 'p', None)} FROM guessed GROUP BY fold)",
        "features",
        extra=_FOLDS,
    ),
    "stored_model_agrees": sql(
        "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM whole WHERE is_test", "features", extra=_PARTED
    ),
    "importance_total": f"SELECT CAST({len(_VARYING)} AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS total",
    "cluster_checks": sql(
        f"""SELECT count(*) AS n_rows, count(*) FILTER (NOT ({PRESENT})) AS n_without, CAST(0 AS BIGINT) AS n_not_nearest,
        round(avg(sales_price), 6) AS mean_price, round(avg(sales_quantity), 6) AS mean_quantity, count(*) AS size FROM features""",
        "features",
    ),
    "elbow_start": sql(
        f"""SELECT CAST(1 AS INTEGER) AS k, CAST(count(*) * ({' + '.join(f'CAST(min({c}) <> max({c}) AS INTEGER)' for c in _VARYING)})
        AS DOUBLE) AS wcss FROM features WHERE {PRESENT}""",
        "features",
    ),
    "elbow_step": sql(
        f"""SELECT k, centre, count(*) AS n, round(sum(q), 3) AS quantity, round(sum(sum(d)) OVER (PARTITION BY k), 1) AS cost FROM (
          SELECT s.r, q, k, centre, (p - cp) * (p - cp) + (q - cq) * (q - cq) AS d
          FROM (SELECT row_number() OVER () AS r, sales_price / 1000 AS p, CAST(sales_quantity AS DOUBLE) AS q FROM sales) s,
            (VALUES {", ".join(f"({k}, {i}, {p / 1000}, {q})" for k, c in _CENTRES.items() for i, (p, q) in enumerate(c))}) AS c(k, centre, cp, cq)
          QUALIFY row_number() OVER (PARTITION BY s.r, k ORDER BY d, centre) = 1) GROUP BY k, centre""",
        "sales",
    ),
    "forest_search": "SELECT CAST(10 AS BIGINT) AS n_trials, true AS best_first, true AS refitted",
    "boosted_search": "SELECT CAST(10 AS BIGINT) AS n_trials, true AS best_first, true AS refitted",
    "backtest_by_formula": sql(
        "SELECT row_id, date, sku_id, category_id, round(q, 6) AS sales_quantity, y AS sales_quantity_right FROM forecasts",
        "sales",
        extra=_unrolled(),
    ),
    "backtest_metrics_by_formula": sql(
        f"SELECT {_score('y', 'q')}, {_N.format('y', 'q')} FROM forecasts", "sales", extra=_unrolled()
    ),
    "future_by_formula": sql(
        "SELECT date, category_id, sku_id, sales_price, round(q, 6) AS sales_quantity FROM forecasts", "sales", extra=_unrolled()
    ),
    "stored_forecaster_by_formula": sql(
        "SELECT row_id, date, sku_id, category_id, sales_price, round(q, 6) AS sales_quantity FROM forecasts", "sales", extra=_unrolled()
    ),
    "holdout_by_formula": sql(f"SELECT {_score('y', 'p')}, {_N.format('y', 'p')} FROM served", "split", extra=_served()),
}
