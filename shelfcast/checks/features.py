"""Registered queries over history: lags, averages, feature table, as-of lookups, serving features."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.checks.common import PRESENT, Query, calendar, rounded, rounded_columns, sales, sql
from shelfcast.operators import history, refresh
from shelfcast.operators.asof import last_k_days, lags_asof, means_asof, sample_days
from shelfcast.operators.daily import daily_category, daily_sku
from shelfcast.operators.joins import with_actuals
from shelfcast.operators.profile import undefined_dates as null_dates
from shelfcast.operators.rows import with_fold, with_test_flag
from shelfcast.operators.scaling import scalable_columns, standardise
from shelfcast.plans.features import build_features, feature_columns, laid_out_lags, lay_out_sales, stored_features, with_lags, with_moving_averages
from shelfcast.plans.forecast import serving_features as features_for_samples
from shelfcast.schema import CATEGORY, DATE, N_ROWS, PRICE, QUANTITY, ROW_ID, SKU, lag_names, sma_names
from shelfcast.session import cut_lineage, new_path

_LAG_PRICES = tuple(lag_names(columns=(PRICE,)))
_AVERAGES = tuple(sma_names())


def features_table(spark: SparkSession, tables: str, *, row_id: bool = True, **options: object) -> DataFrame:
    """The feature table without clusters."""
    return build_features(sales(spark, tables, row_id=row_id), calendar(spark), clusters=None, **options).table


def flagged_features(spark: SparkSession, tables: str) -> DataFrame:
    """:func:`features_table`, stored, with ``is_test`` told before the joins: only test rows, which are given out, keep
    their key (others have an empty one)."""
    rows = with_test_flag(sales(spark, tables, row_id=True)).withColumn(ROW_ID, F.when(F.col("is_test"), F.col(ROW_ID)).otherwise(""))
    return stored_features(rows, calendar(spark))


def folded_features(spark: SparkSession, tables: str, folds: int = 3) -> DataFrame:
    """:func:`features_table` with every row's fold in place of its key, which is told before the joins: the one
    exchange of the fact and what is stored of it are narrower."""
    rows = with_fold(sales(spark, tables, row_id=True), folds).drop(ROW_ID)
    return build_features(rows, calendar(spark), clusters=None).table


def inputs(table: DataFrame) -> list[str]:
    """Model inputs of a table of :func:`folded_features`."""
    return feature_columns(table, exclude=(QUANTITY, "fold"))


def lag_table(spark: SparkSession, tables: str) -> DataFrame:
    out = history.lag_table(daily_sku(sales(spark, tables, category=False)))
    return rounded(out, *_LAG_PRICES)


def _corrected(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales as they were, as they are, and the days between which they differ: a share of the rows was missing,
    had another quantity, or stood on the next day."""
    now = cut_lineage(sales(spark, tables, row_id=True))
    kind = F.pmod(F.xxhash64("row_id"), F.lit(40))
    was = now.where(kind != 0).withColumns(
        {"sales_quantity": F.when(kind == 1, F.col("sales_quantity") + 7).otherwise(F.col("sales_quantity")),
         "date": F.when(kind == 2, F.date_add("date", 1)).otherwise(F.col("date"))}
    )
    moved = was.where(kind <= 2).unionByName(now.where(kind <= 2))
    return was, now, moved


def refreshed_lags(spark: SparkSession, tables: str) -> DataFrame:
    was, now, moved = _corrected(spark, tables)
    stored = refresh.stored_lags(new_path(spark, "lags"))
    stored.build(was)
    stored.refresh(now, moved.select("sku_id", "date"))
    return rounded(stored.rows(spark), *_LAG_PRICES)


def refreshed_averages(spark: SparkSession, tables: str) -> DataFrame:
    was, now, moved = _corrected(spark, tables)
    stored = refresh.stored_averages(new_path(spark, "averages"))
    stored.build(was)
    stored.refresh(now, moved.select("category_id", "date"))
    return rounded(stored.rows(spark), *_AVERAGES)


def moving_average_table(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(history.moving_average_table(daily_category(sales(spark, tables))), *_AVERAGES)


def moving_average_past(spark: SparkSession, tables: str) -> DataFrame:
    out = history.moving_average_table(daily_category(sales(spark, tables)), include_current=False)
    return rounded(out, *_AVERAGES)


def laid_out_lag_join(spark: SparkSession, tables: str) -> DataFrame:
    """:func:`lag_join` of sales in a bucketed table, which the join reads where they are."""
    name, folder = f"sales_{uuid.uuid4().hex}", new_path(spark, "laid-out-sales")
    laid = lay_out_sales(sales(spark, tables), name, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), path=folder)
    return rounded(laid_out_lags(spark, laid), *_LAG_PRICES)


def lag_join(spark: SparkSession, tables: str) -> DataFrame:
    """Every sale with the price and quantity of the SKU's previous three sale days."""
    return rounded(with_lags(sales(spark, tables, category=False)), *_LAG_PRICES)


def average_join(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(with_moving_averages(sales(spark, tables)), *_AVERAGES)


def undefined_average_dates(spark: SparkSession, tables: str) -> DataFrame:
    averages = history.moving_average_table(daily_category(sales(spark, tables)))
    return null_dates(averages, "sma_5_sales_price")


def feature_table(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(features_table(spark, tables, row_id=False), *_LAG_PRICES, *_AVERAGES)


def training_table(spark: SparkSession, tables: str) -> DataFrame:
    """Inputs and target of every row, nulls kept, as handed to a trainer."""
    table = features_table(spark, tables, drop_nulls=False)
    return rounded(table.drop(DATE), *_LAG_PRICES, *_AVERAGES)


def normalised_features(spark: SparkSession, tables: str) -> DataFrame:
    table = cut_lineage(features_table(spark, tables))
    scaled, _ = standardise(table)
    return rounded(scaled, *scalable_columns(table), digits=5)


def scaling_parameters(spark: SparkSession, tables: str) -> DataFrame:
    _, parameters = standardise(features_table(spark, tables))
    return rounded(parameters, "mean", "std", digits=5)


def predictions_with_actuals(spark: SparkSession, tables: str) -> DataFrame:
    rows = with_lags(sales(spark, tables, category=False, row_id=True))
    predicted = rows.select("row_id", SKU, DATE, F.col(f"lag_1_{QUANTITY}").alias(QUANTITY))
    return with_actuals(predicted, rows, ["row_id"])


def _split(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame]:
    flagged = cut_lineage(with_test_flag(sales(spark, tables, row_id=True)))
    return flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")


def asof_last_days(spark: SparkSession, tables: str) -> DataFrame:
    """The last three training days of the SKU for every (SKU, date) of the test rows."""
    train, test = _split(spark, tables)
    recent = last_k_days(sample_days(test, SKU), daily_sku(train), SKU, 3)
    day = F.explode_outer(F.reverse("recent")).alias("day")
    return rounded(recent.select(SKU, F.col(DATE).alias("sample_date"), N_ROWS, day).select(
        SKU, "sample_date", N_ROWS, F.col("day.date").alias(DATE), F.col("day.sales_price").alias(PRICE),
        F.col("day.sales_quantity").alias(QUANTITY)), PRICE)


def asof_strict(spark: SparkSession, tables: str) -> DataFrame:
    train, test = _split(spark, tables)
    return rounded(lags_asof(sample_days(test, SKU), daily_sku(train), inclusive=False), *_LAG_PRICES)


def serving_means(spark: SparkSession, tables: str) -> DataFrame:
    train, test = _split(spark, tables)
    return rounded(means_asof(sample_days(test, CATEGORY), daily_category(train)), *_AVERAGES)


def serving_features(spark: SparkSession, tables: str) -> DataFrame:
    train, test = _split(spark, tables)
    out = features_for_samples(test, daily_sku(train), daily_category(train))
    return rounded(out, *_LAG_PRICES, *_AVERAGES)


QUERIES: dict[str, Query] = {
    "lag_table": lag_table,
    "refreshed_lags": refreshed_lags,
    "refreshed_averages": refreshed_averages,
    "moving_average_table": moving_average_table,
    "moving_average_past": moving_average_past,
    "lag_join": lag_join,
    "laid_out_lag_join": laid_out_lag_join,
    "average_join": average_join,
    "undefined_average_dates": undefined_average_dates,
    "feature_table": feature_table,
    "training_table": training_table,
    "normalised_features": normalised_features,
    "scaling_parameters": scaling_parameters,
    "predictions_with_actuals": predictions_with_actuals,
    "asof_last_days": asof_last_days,
    "asof_strict": asof_strict,
    "serving_means": serving_means,
    "serving_features": serving_features,
}

_LAGS = f"""{rounded_columns(_LAG_PRICES)}, lag_1_sales_quantity, lag_2_sales_quantity, lag_3_sales_quantity"""
_SMA = rounded_columns(_AVERAGES)
_SALE = "date, category_id, sku_id, sales_price, sales_quantity"
_ROW = f"{_SALE}, row_id"
_PARTS = "year, month, day, weekday, is_ukrainian_holiday"
_SCALED = (
    "category_id sku_id sales_price sales_quantity year month day weekday is_ukrainian_holiday "
    + " ".join([*lag_names(), *sma_names()])
).split()


def _scaled(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"""round(CASE WHEN stddev_pop({x}) OVER () = 0 THEN 0.0
        ELSE ({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER () END, 5) AS {c}"""


def _history(key: str, name: str, k: int, inclusive: bool = True) -> str:
    """Test days joined as of the training days, each of which carries the array of its last k days."""
    test = "<=" if inclusive else "<"
    return f"""
days_{name} AS (SELECT {key}, date, avg(sales_price) AS p, CAST(coalesce(sum(sales_quantity), 0) AS BIGINT) AS q
    FROM split WHERE NOT is_test GROUP BY {key}, date),
arrays_{name} AS (SELECT {key}, date, list({{'d': date, 'p': p, 'q': q}}) OVER w AS recent FROM days_{name}
    WINDOW w AS (PARTITION BY {key} ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)),
wanted_{name} AS (SELECT {key}, date, count(*) AS n_rows FROM split WHERE is_test GROUP BY {key}, date),
found_{name} AS (SELECT w.{key}, w.date, w.n_rows, a.recent FROM wanted_{name} w ASOF LEFT JOIN arrays_{name} a
    ON w.{key} = a.{key} AND a.date {test} w.date)"""


def _found_lags(cast: str = "CAST(recent[-{i}].q AS DOUBLE)") -> str:
    prices = ", ".join(f"round(recent[-{i}].p, 6) AS lag_{i}_sales_price" for i in (1, 2, 3))
    return prices + ", " + ", ".join(f"{cast.format(i=i)} AS lag_{i}_sales_quantity" for i in (1, 2, 3))


_FOUND_MEANS = """round(list_avg(list_transform(recent, lambda r: r.p)), 6) AS sma_5_sales_price,
round(list_avg(list_transform(recent, lambda r: CAST(r.q AS DOUBLE))), 6) AS sma_5_sales_quantity"""

ORACLES: dict[str, str] = {
    "lag_table": sql(f"SELECT sku_id, date, n_rows, {_LAGS} FROM lags JOIN daily_sku USING (sku_id, date)", "lags"),
    "refreshed_lags": sql(f"SELECT sku_id, date, {_LAGS} FROM lags", "lags"),
    "refreshed_averages": sql(f"SELECT category_id, date, {_SMA} FROM averages", "averages"),
    "moving_average_table": sql(
        f"SELECT category_id, date, n_rows, {_SMA} FROM averages JOIN daily_category USING (category_id, date)",
        "averages",
    ),
    "moving_average_past": sql(
        """SELECT category_id, date, n_rows,
        CASE WHEN count(sales_price) OVER w >= 5 THEN round(avg(sales_price) OVER w, 6) END AS sma_5_sales_price,
        CASE WHEN count(sales_price) OVER w >= 5 THEN round(avg(sales_quantity) OVER w, 6) END AS sma_5_sales_quantity
        FROM daily_category
        WINDOW w AS (PARTITION BY category_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
        "daily_category",
    ),
    "lag_join": sql(
        f"SELECT date, sku_id, sales_price, sales_quantity, {_LAGS} FROM with_lags", "with_lags"
    ),
    "laid_out_lag_join": sql(f"SELECT {_SALE}, {_LAGS} FROM with_lags", "with_lags"),
    "average_join": sql(f"SELECT {_SALE}, {_SMA} FROM sales JOIN averages USING (category_id, date)", "sales", "averages"),
    "undefined_average_dates": sql(
        "SELECT DISTINCT date FROM averages WHERE sma_5_sales_price IS NULL", "averages"
    ),
    "feature_table": sql(f"SELECT {_SALE}, {_PARTS}, {_LAGS}, {_SMA} FROM features WHERE {PRESENT}", "features"),
    "training_table": sql(
        f"SELECT * EXCLUDE (date) FROM (SELECT {_ROW}, {_PARTS}, {_LAGS}, {_SMA} FROM features)", "features"
    ),
    "normalised_features": sql(
        f"SELECT date, row_id, {', '.join(_scaled(c) for c in _SCALED)} FROM features WHERE {PRESENT}", "features"
    ),
    "scaling_parameters": sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", round(avg(CAST({c} AS DOUBLE)), 5) AS mean,
            round(stddev_pop(CAST({c} AS DOUBLE)), 5) AS std FROM features WHERE {PRESENT}"""
            for c in _SCALED
        ),
        "features",
    ),
    "predictions_with_actuals": sql(
        """SELECT row_id, sku_id, date, lag_1_sales_quantity AS sales_quantity, sales_quantity AS sales_quantity_right
        FROM with_lags""",
        "with_lags",
    ),
    "asof_last_days": sql(
        """SELECT sku_id, date AS sample_date, n_rows, day.d AS date, round(day.p, 6) AS sales_price,
        CAST(day.q AS DOUBLE) AS sales_quantity
        FROM (SELECT sku_id, date, n_rows, unnest(coalesce(recent, [NULL])) AS day FROM found_sku)""",
        "split",
        extra=_history("sku_id", "sku", 3),
    ),
    "asof_strict": sql(
        f"SELECT sku_id, date, n_rows, {_found_lags()} FROM found_sku",
        "split",
        extra=_history("sku_id", "sku", 3, inclusive=False),
    ),
    "serving_means": sql(
        f"SELECT category_id, date, n_rows, {_FOUND_MEANS} FROM found_category",
        "split",
        extra=_history("category_id", "category", 5),
    ),
    "serving_features": sql(
        f"""SELECT s.* EXCLUDE (is_test), l.* EXCLUDE (sku_id, date), m.* EXCLUDE (category_id, date) FROM split s
        JOIN (SELECT sku_id, date, {_found_lags()} FROM found_sku) l USING (sku_id, date)
        JOIN (SELECT category_id, date, {_FOUND_MEANS} FROM found_category) m USING (category_id, date)
        WHERE is_test""",
        "split",
        extra=f"{_history('sku_id', 'sku', 3)}, {_history('category_id', 'category', 5).strip()}",
    ),
}
