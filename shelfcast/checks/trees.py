"""Registered queries of the histogram trees with few real splits, and SQL that searches all thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.checks.common import Query, rounded, sql
from shelfcast.checks.features import features_table
from shelfcast.operators.rows import with_test_flag
from shelfcast.plans import models
from shelfcast.schema import PREDICTION, QUANTITY
from shelfcast.session import cut_lineage

#: Inputs with few values, so that bins are values; the lag is missing for a SKU's first day.
_INPUTS = ("month", "weekday", "category_id", "lag_1_sales_quantity")

_RATE, _L2, _LEAST = 0.5, 5.0, 20
_SPLIT_ROWS, _LEAF_ROWS = 2000, 50


def _halves(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame]:
    table = features_table(spark, tables, drop_nulls=False).select("row_id", QUANTITY, *_INPUTS)
    flagged = cut_lineage(with_test_flag(table))
    return flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")


def _predictions(spark: SparkSession, tables: str, regressor) -> DataFrame:
    train, test = _halves(spark, tables)
    predicted = models.predict(models.train(train, regressor, _INPUTS), test)
    return rounded(predicted.select("row_id", QUANTITY, PREDICTION), PREDICTION)


def leafwise_one_split(spark: SparkSession, tables: str) -> DataFrame:
    """One round of two leaves with an L2 penalty."""
    regressor = models.leafwise_boosting(rounds=1, numLeaves=2, learningRate=_RATE, lambdaL2=_L2, minDataInLeaf=_LEAST)
    return _predictions(spark, tables, regressor)


def forest_two_levels(spark: SparkSession, tables: str) -> DataFrame:
    """One tree of depth two, whose nodes need a number of rows to be split."""
    regressor = models.histogram_forest(numTrees=1, bootstrap=False, maxDepth=2, minSamplesSplit=_SPLIT_ROWS, minDataInLeaf=_LEAF_ROWS)
    return _predictions(spark, tables, regressor)


def leafwise_importance(spark: SparkSession, tables: str) -> DataFrame:
    """Share of the gain of each input in boosted trees; with two leaves and one round one input has it all."""
    train, _ = _halves(spark, tables)
    regressor = models.leafwise_boosting(rounds=1, numLeaves=2, learningRate=_RATE, lambdaL2=_L2, minDataInLeaf=_LEAST)
    return rounded(models.feature_importance(models.train(train, regressor, _INPUTS), spark), "importance")


def leafwise_predictions(spark: SparkSession, tables: str) -> DataFrame:
    """Several rounds with bagging, shares of the features and both penalties."""
    train, test = _halves(spark, tables)
    regressor = models.leafwise_boosting(
        rounds=4, numLeaves=6, learningRate=0.3, lambdaL1=0.1, lambdaL2=1.0, featureFraction=0.8, baggingFraction=0.7, baggingFreq=2
    )
    return models.predict(models.train(train, regressor, _INPUTS), test)


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (leafwise_one_split, forest_two_levels, leafwise_importance, leafwise_predictions)
}

_FLAG = "CAST('0x' || substr(md5(row_id || '|'), 1, 8) AS BIGINT) % 100 < 12"


def _best(name: str, rows: str, l2: float, least: int, split_rows: int) -> str:
    """CTEs ending in ``name`` (node, f, x, to_left): the best split of every node of ``rows`` (node, t, x0, x1, ...)."""
    cells = " UNION ALL ".join(f"SELECT node, t, {i} AS f, x{i} AS x FROM {rows}" for i in range(len(_INPUTS)))
    side = "({g}) * ({g}) / (({n}) + " + str(l2) + ")"
    gain = f"{side.format(g='gl', n='nl')} + {side.format(g='g - gl', n='n - nl')} - {side.format(g='g', n='n')}"
    return f"""
{name}_cells AS ({cells}),
{name}_all AS (SELECT node, f, sum(t) AS g, count(*) AS n, coalesce(sum(t) FILTER (x IS NULL), 0) AS gm, count(*) FILTER (x IS NULL) AS nm
  FROM {name}_cells GROUP BY node, f),
{name}_sums AS (SELECT node, f, x, sum(sum(t)) OVER w AS g_up, sum(count(*)) OVER w AS n_up FROM {name}_cells WHERE x IS NOT NULL
  GROUP BY node, f, x WINDOW w AS (PARTITION BY node, f ORDER BY x)),
{name}_options AS (SELECT node, f, x, to_left, g, n, g_up + CASE WHEN to_left THEN gm ELSE 0 END AS gl, n_up + CASE WHEN to_left THEN nm ELSE 0 END AS nl
  FROM {name}_sums JOIN {name}_all USING (node, f), (VALUES (false), (true)) AS sides(to_left) WHERE nm > 0 OR NOT to_left),
{name} AS (SELECT node, f, x, to_left FROM {name}_options WHERE nl >= {least} AND n - nl >= {least} AND n >= {split_rows} AND {gain} > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY {gain} DESC, f, x, to_left) = 1)"""


def _moved(rows: str, splits: str) -> str:
    """``rows`` in the nodes below: 2 * node + 1 left and + 2 right, or where they were without a split."""
    value = "CASE s.f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(_INPUTS))) + " END"
    return f"""SELECT r.* REPLACE (CASE WHEN s.f IS NULL THEN r.node WHEN CASE WHEN {value} IS NULL THEN s.to_left ELSE {value} <= s.x END
    THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node) FROM {rows} r LEFT JOIN {splits} s USING (node)"""


_ROWS = f"""
parted AS (SELECT row_id, sales_quantity, CAST(sales_quantity AS DOUBLE) AS y, {_FLAG} AS is_test,
    {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(_INPUTS))} FROM features),
base AS (SELECT avg(y) AS mean FROM parted WHERE NOT is_test)"""

_ONE = f"""{_ROWS},
rows AS (SELECT *, 0 AS node, y - (SELECT mean FROM base) AS t FROM parted),
train AS (SELECT * FROM rows WHERE NOT is_test),
{_best("first", "train", _L2, _LEAST, 2).strip()},
placed AS ({_moved("rows", "first")}),
leaves AS (SELECT node, sum(t) / (count(*) + {_L2}) AS value FROM placed WHERE NOT is_test GROUP BY node)"""

_TWO = f"""{_ROWS},
rows AS (SELECT *, 0 AS node, y AS t FROM parted),
train AS (SELECT * FROM rows WHERE NOT is_test),
{_best("first", "train", 0.0, _LEAF_ROWS, _SPLIT_ROWS).strip()},
once AS ({_moved("rows", "first")}),
again AS (SELECT * FROM once WHERE NOT is_test AND node > 0),
{_best("second", "again", 0.0, _LEAF_ROWS, _SPLIT_ROWS).strip()},
placed AS ({_moved("once", "second")}),
leaves AS (SELECT node, avg(y) AS value FROM placed WHERE NOT is_test GROUP BY node)"""

ORACLES: dict[str, str] = {
    "leafwise_one_split": sql(
        f"SELECT row_id, sales_quantity, round((SELECT mean FROM base) + {_RATE} * value, 6) AS prediction FROM placed JOIN leaves USING (node) WHERE is_test",
        "features",
        extra=_ONE,
    ),
    "forest_two_levels": sql(
        "SELECT row_id, sales_quantity, round(value, 6) AS prediction FROM placed JOIN leaves USING (node) WHERE is_test", "features", extra=_TWO
    ),
    "leafwise_importance": sql(
        f"""SELECT feature, CAST(f IS NOT NULL AS DOUBLE) AS importance FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(_INPUTS))}) AS i(k, feature)
        LEFT JOIN first ON f = k""",
        "features",
        extra=_ONE,
    ),
}
