"""Registered queries over rows and columns: readers, calendar, filters, sets, samples."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.checks.common import FORECAST_START, PRESENT, Query, calendar, rounded, sales, sql
from shelfcast.functions.dates import date_from_parts, parse_date
from shelfcast.functions.values import as_integer, natural_log
from shelfcast.operators.calendar import with_calendar, with_holiday_flag
from shelfcast.operators.daily import daily_category, daily_sku
from shelfcast.operators.profile import ordered
from shelfcast.operators.rows import (
    append_unclustered,
    concat,
    drop_nulls,
    sample_keys,
    shuffled,
    split_by_completeness,
    split_train_test,
)
from shelfcast.plans.features import with_lags
from shelfcast.schema import CATEGORY, CLUSTER, DATE, N_ROWS, PRICE, QUANTITY, SALES_COLUMNS, SKU
from shelfcast.session import new_path
from shelfcast.sources.holidays import with_substitutes
from shelfcast.sources.sales import read_sales_csv, write_csv, write_forecast


def sales_csv(spark: SparkSession, tables: str) -> DataFrame:
    path = new_path(spark, "history-csv")
    rows = sales(spark, tables, row_id=True)
    write_csv(rows.select("row_id", *reversed(SALES_COLUMNS)), path)
    return read_sales_csv(spark, path)


def future_csv(spark: SparkSession, tables: str) -> DataFrame:
    path = new_path(spark, "future-csv")
    write_csv(sales(spark, tables).drop(QUANTITY), path)
    return read_sales_csv(spark, path)


def forecast_csv(spark: SparkSession, tables: str) -> DataFrame:
    path = new_path(spark, "forecast-csv")
    write_forecast(sales(spark, tables, row_id=True), path)
    return spark.read.option("header", True).schema(_FORECAST_SCHEMA).csv(path)


_FORECAST_SCHEMA = "date date, category_id long, sku_id long, sales_price double, sales_quantity double"


def parsed_dates(spark: SparkSession, tables: str) -> DataFrame:
    text = sales(spark, tables, category=False).select(SKU, F.col(DATE).cast("string").alias("text"))
    return text.select(SKU, "text", parse_date("text").alias(DATE), parse_date("text", strict=False).alias("lenient"))


def calendar_parts(spark: SparkSession, tables: str) -> DataFrame:
    return with_calendar(sales(spark, tables, category=False))


def calendar_extended(spark: SparkSession, tables: str) -> DataFrame:
    return with_calendar(sales(spark, tables, category=False), extended=True)


def weekend_flag(spark: SparkSession, tables: str) -> DataFrame:
    rows = with_calendar(sales(spark, tables, category=False), extended=True)
    return rows.groupBy("weekday", "is_weekend").agg(F.count(F.lit(1)).alias("n"))


def holiday_flag(spark: SparkSession, tables: str) -> DataFrame:
    return with_holiday_flag(sales(spark, tables, category=False), calendar(spark))


def holiday_flag_substitutes(spark: SparkSession, tables: str) -> DataFrame:
    """With the days off that holidays at weekends move to."""
    return with_holiday_flag(sales(spark, tables, category=False), with_substitutes(calendar(spark)))


def dates_from_parts(spark: SparkSession, tables: str) -> DataFrame:
    parts = with_calendar(sales(spark, tables, category=False)).drop(DATE)
    return parts.select(SKU, "year", "month", "day", date_from_parts().alias(DATE))


def log_columns(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables, category=False)
    logs = rows.select(SKU, PRICE, natural_log(PRICE).alias("log_sales_price"), natural_log(SKU).alias("log_sku_id"))
    return rounded(logs, "log_sales_price", "log_sku_id")


def integer_casts(spark: SparkSession, tables: str) -> DataFrame:
    rows = with_holiday_flag(sales(spark, tables), calendar(spark))
    return rows.select(*[as_integer(f.name, f.dataType).alias(f.name) for f in rows.schema.fields])


def column_selection(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables).drop(QUANTITY)
    return rows.select(SKU, F.col(CATEGORY).alias("group_id"), F.col(PRICE).alias("price"), DATE)


def literal_columns(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables, category=False).select(SKU, DATE)
    return rows.withColumns(
        {"source": F.lit("history"), "level": F.lit(7).cast("long"), CLUSTER: F.lit(None).cast("int")}
    )


def equality_filter(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables)
    return rows.where((F.col(CATEGORY) == 7) & (F.col(DATE) >= F.lit(dt.date(1999, 1, 1))))


def date_range_filter(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables)
    return rows.where(F.col(DATE).between(F.lit(dt.date(1996, 11, 18)), F.lit(dt.date(1996, 11, 21))))


def complete_rows(spark: SparkSession, tables: str) -> DataFrame:
    rows = with_lags(sales(spark, tables, category=False, row_id=True))
    return rounded(drop_nulls(rows).select("row_id", SKU, DATE, "lag_3_sales_price"), "lag_3_sales_price")


def null_split(spark: SparkSession, tables: str) -> DataFrame:
    rows = with_lags(sales(spark, tables, category=False, row_id=True))
    complete, rest = split_by_completeness(rows)
    tagged = [p.select("row_id", SKU, DATE, F.lit(tag).alias("part")) for p, tag in ((complete, "complete"), (rest, "rest"))]
    return concat(tagged)


def history_cut(spark: SparkSession, tables: str) -> DataFrame:
    days = daily_sku(sales(spark, tables, category=False))
    cut = days.where((F.col(SKU) == 45) & (F.col(DATE) <= F.lit(FORECAST_START)))
    return rounded(ordered(cut, [DATE], descending=True), PRICE)


def clustered_and_rest(spark: SparkSession, tables: str) -> DataFrame:
    rows = with_lags(sales(spark, tables, row_id=True))
    complete, rest = split_by_completeness(rows)
    marked = complete.withColumn(CLUSTER, (F.col(CATEGORY) % 5).cast("int"))
    return append_unclustered(marked, rest).select("row_id", SKU, DATE, CLUSTER)


def daily_levels(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables)
    levels = (("sku", SKU, daily_sku(rows)), ("category", CATEGORY, daily_category(rows)))
    frames = [d.select(F.lit(n).alias("level"), F.col(k).alias("key"), DATE, PRICE, QUANTITY) for n, k, d in levels]
    return rounded(concat(frames), PRICE)


def history_with_predictions(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables, category=False)
    start = F.lit(FORECAST_START)
    past = daily_sku(rows.where(F.col(DATE) < start)).drop(N_ROWS)
    predicted = daily_sku(rows.where(F.col(DATE) >= start).withColumn(QUANTITY, F.lit(1).cast("long"))).drop(N_ROWS)
    return rounded(past.unionByName(predicted), PRICE)


def sorted_daily(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(ordered(daily_category(sales(spark, tables)), [CATEGORY, DATE]), PRICE)


def shuffled_rows(spark: SparkSession, tables: str) -> DataFrame:
    return shuffled(sales(spark, tables, row_id=True))


def sampled_skus(spark: SparkSession, tables: str) -> DataFrame:
    return sample_keys(sales(spark, tables, category=False), SKU)


def train_test_split(spark: SparkSession, tables: str) -> DataFrame:
    train, test = split_train_test(sales(spark, tables, row_id=True))
    return concat([train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        sales_csv,
        future_csv,
        forecast_csv,
        parsed_dates,
        calendar_parts,
        calendar_extended,
        weekend_flag,
        holiday_flag,
        holiday_flag_substitutes,
        dates_from_parts,
        log_columns,
        integer_casts,
        column_selection,
        literal_columns,
        equality_filter,
        date_range_filter,
        complete_rows,
        null_split,
        history_cut,
        clustered_and_rest,
        daily_levels,
        history_with_predictions,
        sorted_daily,
        shuffled_rows,
        sampled_skus,
        train_test_split,
    )
}

_PARTS = """CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) AS INTEGER) AS weekday"""
_SALES_DOUBLE = "date, category_id, sku_id, sales_price, CAST(sales_quantity AS DOUBLE) AS sales_quantity"
_LAG_PRESENT = PRESENT.split(" AND sma_5")[0]

# Orthodox Easter of the years before the end of the sales tables.
_EASTERS = """1990-04-15 1991-04-07 1992-04-26 1993-04-18 1994-05-01 1995-04-23 1996-04-14 1997-04-27 1998-04-19 1999-04-11
2000-04-30 2001-04-15 2002-05-05 2003-04-27""".split()

# Dates of its own, and days off by counting: a free working day is off where since some day before it more
# holidays fell on weekends than there were free working days.
_DAYS_OFF = f"""
easter AS (SELECT CAST(unnest(['{"', '".join(_EASTERS)}']) AS DATE) AS d),
dated AS (SELECT DISTINCT d FROM (
    SELECT d FROM easter UNION ALL SELECT d + 49 FROM easter
    UNION ALL SELECT make_date(y, m, n) FROM range(1990, 2004) t(y), (VALUES (1, 1), (1, 7), (3, 8), (5, 1), (5, 2), (5, 9)) f(m, n)
    UNION ALL SELECT make_date(y, 8, 24) FROM range(1992, 2004) t(y)
    UNION ALL SELECT make_date(y, 6, 28) FROM range(1997, 2004) t(y)
) x(d)),
every_day AS (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2003-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
steps AS (SELECT d, isodow(d) < 6 AND d NOT IN (FROM dated) AS free,
    CASE WHEN isodow(d) >= 6 AND d IN (FROM dated) AND d >= DATE '1995-01-27' THEN 1
         WHEN isodow(d) < 6 AND d NOT IN (FROM dated) THEN -1 ELSE 0 END AS step FROM every_day),
sums AS (SELECT d, free, sum(step) OVER (ORDER BY d) - step AS before FROM steps),
off AS (SELECT d FROM dated UNION SELECT x.d FROM sums x WHERE x.free AND EXISTS (
    SELECT 1 FROM sums y WHERE y.d < x.d AND y.d > x.d - 40 AND x.before > y.before))"""

ORACLES: dict[str, str] = {
    "sales_csv": sql(f"SELECT {_SALES_DOUBLE} FROM sales", "sales"),
    "future_csv": sql(
        "SELECT date, category_id, sku_id, sales_price, CAST(NULL AS DOUBLE) AS sales_quantity FROM sales", "sales"
    ),
    "forecast_csv": sql(f"SELECT {_SALES_DOUBLE} FROM sales", "sales"),
    "parsed_dates": sql(
        "SELECT sku_id, CAST(date AS VARCHAR) AS text, date, date AS lenient FROM sales", "sales"
    ),
    "calendar_parts": sql(f"SELECT date, sku_id, sales_price, sales_quantity, {_PARTS} FROM sales", "sales"),
    "calendar_extended": sql(
        f"""SELECT date, sku_id, sales_price, sales_quantity, {_PARTS}, CAST(week(date) AS INTEGER) AS week,
        CAST(quarter(date) AS INTEGER) AS quarter, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
        isodow(date) >= 5 AS is_weekend FROM sales""",
        "sales",
    ),
    "weekend_flag": sql(
        """SELECT CAST(isodow(date) AS INTEGER) AS weekday, isodow(date) IN (5, 6, 7) AS is_weekend, count(*) AS n
        FROM sales GROUP BY ALL""",
        "sales",
    ),
    "holiday_flag": sql(
        """SELECT date, sku_id, sales_price, sales_quantity,
        date IN (SELECT date FROM holidays) AS is_ukrainian_holiday FROM sales""",
        "sales",
        "holidays",
    ),
    "holiday_flag_substitutes": sql(
        """SELECT date, sku_id, sales_price, sales_quantity, date IN (FROM off) AS is_ukrainian_holiday FROM sales""",
        "sales",
        extra=_DAYS_OFF,
    ),
    "dates_from_parts": sql(f"SELECT sku_id, {_PARTS.rsplit(',', 1)[0]}, date FROM sales", "sales"),
    "log_columns": sql(
        """SELECT sku_id, sales_price, round(ln(sales_price), 6) AS log_sales_price,
        round(ln(sku_id), 6) AS log_sku_id FROM sales""",
        "sales",
    ),
    "integer_casts": sql(
        """SELECT CAST(date - DATE '1970-01-01' AS BIGINT) AS date, category_id, sku_id,
        CAST(trunc(sales_price) AS BIGINT) AS sales_price, sales_quantity,
        CAST(date IN (SELECT date FROM holidays) AS BIGINT) AS is_ukrainian_holiday FROM sales""",
        "sales",
        "holidays",
    ),
    "column_selection": sql(
        "SELECT sku_id, category_id AS group_id, sales_price AS price, date FROM sales", "sales"
    ),
    "literal_columns": sql(
        """SELECT sku_id, date, 'history' AS source, CAST(7 AS BIGINT) AS level, CAST(NULL AS INTEGER) AS cluster_id
        FROM sales""",
        "sales",
    ),
    "equality_filter": sql(
        "SELECT * EXCLUDE (row_id) FROM sales WHERE category_id = 7 AND date >= DATE '1999-01-01'", "sales"
    ),
    "date_range_filter": sql(
        "SELECT * EXCLUDE (row_id) FROM sales WHERE date BETWEEN DATE '1996-11-18' AND DATE '1996-11-21'", "sales"
    ),
    "complete_rows": sql(
        f"""SELECT row_id, sku_id, date, round(lag_3_sales_price, 6) AS lag_3_sales_price
        FROM with_lags WHERE {_LAG_PRESENT}""",
        "with_lags",
    ),
    "null_split": sql(
        f"SELECT row_id, sku_id, date, CASE WHEN {_LAG_PRESENT} THEN 'complete' ELSE 'rest' END AS part FROM with_lags",
        "with_lags",
    ),
    "history_cut": sql(
        f"""SELECT sku_id, date, round(sales_price, 6) AS sales_price, sales_quantity, n_rows FROM daily_sku
        WHERE sku_id = 45 AND date <= DATE '{FORECAST_START}'""",
        "daily_sku",
    ),
    "clustered_and_rest": sql(
        f"""SELECT row_id, sku_id, date, CASE WHEN {_LAG_PRESENT} THEN CAST(category_id % 5 AS INTEGER) END AS cluster_id
        FROM with_lags""",
        "with_lags",
    ),
    "daily_levels": sql(
        """SELECT 'sku' AS level, sku_id AS key, date, round(sales_price, 6) AS sales_price, sales_quantity FROM daily_sku
        UNION ALL
        SELECT 'category', category_id, date, round(sales_price, 6), sales_quantity FROM daily_category""",
        "daily_sku",
        "daily_category",
    ),
    "history_with_predictions": sql(
        f"""SELECT sku_id, date, round(avg(sales_price), 6) AS sales_price,
        CAST(sum(CASE WHEN date < DATE '{FORECAST_START}' THEN sales_quantity ELSE 1 END) AS BIGINT) AS sales_quantity
        FROM sales GROUP BY sku_id, date""",
        "sales",
    ),
    "sorted_daily": sql(
        """SELECT category_id, date, round(sales_price, 6) AS sales_price, sales_quantity, n_rows
        FROM daily_category ORDER BY category_id NULLS FIRST, date NULLS FIRST""",
        "daily_category",
    ),
    "shuffled_rows": sql("SELECT * FROM sales", "sales"),
    "sampled_skus": sql(
        """SELECT sku_id FROM (SELECT DISTINCT sku_id FROM sales)
        ORDER BY md5(concat_ws('|', sku_id, '42')), sku_id LIMIT 20""",
        "sales",
    ),
    "train_test_split": sql(
        "SELECT * EXCLUDE (is_test), CASE WHEN is_test THEN 'test' ELSE 'train' END AS part FROM split", "split"
    ),
}
