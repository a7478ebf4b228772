"""Registered queries over aggregates: daily tables, profiles, histograms, correlation."""

from __future__ import annotations

import datetime as dt
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.checks.common import Query, calendar, rounded, sales, sql
from shelfcast.operators import daily as days
from shelfcast.operators import profile, sketches
from shelfcast.operators.calendar import with_calendar, with_holiday_flag
from shelfcast.operators.correlation import correlation_matrix, wide_correlation_matrix
from shelfcast.operators.evaluation import regression_metrics
from shelfcast.operators.histogram import column_histograms, grouped_histogram
from shelfcast.operators.history import lag_table, moving_average_table
from shelfcast.operators.rows import drop_nulls, sample_keys
from shelfcast.plans.features import with_lags
from shelfcast.schema import CATEGORY, DATE, PRICE, QUANTITY, SKU
from shelfcast.session import cut_lineage, new_path

_CALENDAR = ("year", "month", "day", "weekday", "week", "quarter", "day_of_year", "is_weekend", "is_ukrainian_holiday")
_PROFILED = (DATE, CATEGORY, SKU, PRICE, QUANTITY)


def _calendar_rows(spark: SparkSession, tables: str) -> DataFrame:
    return with_holiday_flag(with_calendar(sales(spark, tables), extended=True), calendar(spark))


def daily_sku(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(days.daily_sku(sales(spark, tables, category=False)), PRICE)


def daily_category(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(days.daily_category(sales(spark, tables)), PRICE)


def sketched_profile(spark: SparkSession, tables: str) -> DataFrame:
    """Profile of two years merged from day states: exact counts, and whether the sketches are near the rows."""
    columns = [SKU, CATEGORY, PRICE, QUANTITY]
    rows = cut_lineage(sales(spark, tables).select(DATE, *columns))
    path = new_path(spark, "states")
    sketches.store_days(rows, path, columns)
    first, last = dt.date(1997, 1, 1), dt.date(1998, 12, 31)
    merged = sketches.profile_between(spark, path, first, last, [0.5])
    chosen = rows.where(F.col(DATE).between(F.lit(first), F.lit(last)))
    middles = {r["column"]: r["quantiles"][0] for r in merged.collect()}
    exact = chosen.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"), F.lit(middles.get(c)).alias("m")) for c in columns])).alias("v")
    ).select("v.*").groupBy("column").agg(
        F.count_distinct("x").alias("exact"), (F.count_if(F.col("x") < F.col("m")) / F.count("x")).alias("below"),
        (F.count_if(F.col("x") <= F.col("m")) / F.count("x")).alias("up_to"),
    )
    near = (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.07 * F.col("exact")).alias("distinct_near")
    middle = ((F.col("below") <= 0.53) & (F.col("up_to") >= 0.47)).alias("median_near")
    return merged.join(exact, "column").select("column", "n_rows", "n_null", near, middle)


def sale_span(spark: SparkSession, tables: str) -> DataFrame:
    return days.sale_span(sales(spark, tables, category=False))


def null_counts_lags(spark: SparkSession, tables: str) -> DataFrame:
    return profile.null_counts(lag_table(days.daily_sku(sales(spark, tables, category=False))))


def null_counts_averages(spark: SparkSession, tables: str) -> DataFrame:
    return profile.null_counts(moving_average_table(days.daily_category(sales(spark, tables))))


def distinct_counts(spark: SparkSession, tables: str) -> DataFrame:
    return profile.distinct_counts(sales(spark, tables))


def value_counts_category(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(profile.value_counts(sales(spark, tables), CATEGORY), "proportion", digits=9)


def value_counts_sku(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(profile.value_counts(sales(spark, tables, category=False), SKU), "proportion", digits=9)


def top_skus(spark: SparkSession, tables: str) -> DataFrame:
    counts = profile.value_counts(sales(spark, tables, category=False), SKU)
    return rounded(profile.most_frequent(counts, SKU), "proportion", digits=9)


def bottom_skus(spark: SparkSession, tables: str) -> DataFrame:
    counts = profile.value_counts(sales(spark, tables, category=False), SKU)
    return rounded(profile.least_frequent(counts, SKU), "proportion", digits=9)


def summary(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(profile.summary(sales(spark, tables)), "mean", "std", digits=4)


def correlation(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(correlation_matrix(_calendar_rows(spark, tables), exclude=[DATE]), "corr")


def correlation_reduced(spark: SparkSession, tables: str) -> DataFrame:
    dropped = [DATE, "day_of_year", "week", "quarter", "is_weekend"]
    return rounded(correlation_matrix(_calendar_rows(spark, tables), exclude=dropped), "corr")


def correlation_wide(spark: SparkSession, tables: str) -> DataFrame:
    rows = _calendar_rows(spark, tables)
    return rounded(wide_correlation_matrix(rows, [c for c in rows.columns if c != DATE]), "corr")


def filtered_total(spark: SparkSession, tables: str) -> DataFrame:
    return profile.filtered_total(sales(spark, tables), category_id=7, date=dt.date(1996, 11, 18))


def gap_report_sku(spark: SparkSession, tables: str) -> DataFrame:
    return days.gap_report(sales(spark, tables, category=False), SKU)


def gap_report_category(spark: SparkSession, tables: str) -> DataFrame:
    return days.gap_report(sales(spark, tables), CATEGORY)


def histograms(spark: SparkSession, tables: str) -> DataFrame:
    return column_histograms(_calendar_rows(spark, tables))


def histogram_by_category(spark: SparkSession, tables: str) -> DataFrame:
    return grouped_histogram(sales(spark, tables), CATEGORY)


def histogram_by_sku(spark: SparkSession, tables: str) -> DataFrame:
    return grouped_histogram(sales(spark, tables, category=False), SKU, bins=10)


def metrics(spark: SparkSession, tables: str) -> DataFrame:
    rows = drop_nulls(with_lags(sales(spark, tables, category=False)))
    guess = sum((F.col(f"lag_{i}_{QUANTITY}") for i in (2, 3)), F.col(f"lag_1_{QUANTITY}")) / 3
    out = regression_metrics(rows.withColumn("prediction", guess))
    return rounded(out, *out.columns)


def distinct_categories(spark: SparkSession, tables: str) -> DataFrame:
    return profile.distinct_keys(sales(spark, tables), CATEGORY)


def daily_series(spark: SparkSession, tables: str) -> DataFrame:
    return days.daily_series(sales(spark, tables, category=False))


def daily_series_category(spark: SparkSession, tables: str) -> DataFrame:
    return days.daily_series(sales(spark, tables), [CATEGORY])


def daily_series_sampled(spark: SparkSession, tables: str) -> DataFrame:
    rows = sales(spark, tables, category=False)
    return days.daily_series(rows.join(sample_keys(rows, SKU), SKU, "left_semi"), [SKU])


def day_arrays(spark: SparkSession, tables: str) -> DataFrame:
    arrays = days.as_arrays(days.daily_sku(sales(spark, tables, category=False)), SKU)
    return rounded(days.from_arrays(arrays, SKU), PRICE)


QUERIES: dict[str, Query] = {
    "daily_sku": daily_sku,
    "daily_category": daily_category,
    "sale_span": sale_span,
    "sketched_profile": sketched_profile,
    "null_counts_lags": null_counts_lags,
    "null_counts_averages": null_counts_averages,
    "distinct_counts": distinct_counts,
    "value_counts_category": value_counts_category,
    "value_counts_sku": value_counts_sku,
    "top_skus": top_skus,
    "bottom_skus": bottom_skus,
    "summary": summary,
    "correlation": correlation,
    "correlation_reduced": correlation_reduced,
    "correlation_wide": correlation_wide,
    "filtered_total": filtered_total,
    "gap_report_sku": gap_report_sku,
    "gap_report_category": gap_report_category,
    "histograms": histograms,
    "histogram_by_category": histogram_by_category,
    "histogram_by_sku": histogram_by_sku,
    "metrics": metrics,
    "distinct_categories": distinct_categories,
    "daily_series": daily_series,
    "daily_series_category": daily_series_category,
    "daily_series_sampled": daily_series_sampled,
    "day_arrays": day_arrays,
}

_DAILY = "date, round(sales_price, 6) AS sales_price, sales_quantity, n_rows"
_NUMBER = {DATE: "date - DATE '1970-01-01'"}
_RICH = f"""
rich AS (SELECT * EXCLUDE (row_id), year(date) AS year, month(date) AS month, day(date) AS day, isodow(date) AS weekday,
    week(date) AS week, quarter(date) AS quarter, dayofyear(date) AS day_of_year, isodow(date) >= 5 AS is_weekend,
    date IN (SELECT date FROM holidays) AS is_ukrainian_holiday FROM sales)"""


def _correlation_sql(columns: tuple[str, ...]) -> str:
    pairs = list(product(columns, columns))
    numbers = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    coefficients = ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(pairs))
    extra = f"{_RICH}, numbers AS (SELECT {numbers} FROM rich), one AS (SELECT {coefficients} FROM numbers)"
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(c{i}, 6) AS corr FROM one" for i, (a, b) in enumerate(pairs)
    )
    return sql(rows, "sales", "holidays", extra=extra)


def _summary_sql() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({_NUMBER.get(c, c)} AS DOUBLE) AS x FROM sales""" for c in _PROFILED
    )
    return sql(
        """SELECT "column", count(x) AS "count", count(*) FILTER (x IS NULL) AS null_count, round(avg(x), 4) AS mean,
        round(stddev_samp(x), 4) AS std, min(x) AS min, quantile_disc(x, 0.25) AS p25, quantile_disc(x, 0.5) AS p50,
        quantile_disc(x, 0.75) AS p75, max(x) AS max FROM numbers GROUP BY 1""",
        "sales",
        extra=f"numbers AS ({rows})",
    )


def _histogram_sql() -> str:
    columns = (*_PROFILED, *_CALENDAR)
    special = {**_NUMBER, PRICE: "trunc(sales_price)"}
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({special.get(c, c)} AS BIGINT) AS x FROM rich""" for c in columns
    )
    extra = f"""{_RICH}, whole AS ({rows}),
limits AS (SELECT "column", min(x) AS lo, max(x) AS hi,
    CASE WHEN count(DISTINCT x) + CAST(count(*) > count(x) AS INTEGER) = 2 THEN 2
         ELSE CAST(floor(log2(count(*))) AS INTEGER) + 1 END AS bins FROM whole GROUP BY 1)"""
    return sql(
        """SELECT "column", CAST(CASE WHEN hi = lo THEN 0 ELSE
            least(floor(CAST(x - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) * bins), bins - 1) END AS INTEGER) AS bin,
        count(*) AS n, lo, hi FROM whole JOIN limits USING ("column") WHERE x IS NOT NULL GROUP BY ALL""",
        "sales",
        "holidays",
        extra=extra,
    )


def _grouped_histogram_sql(key: str, bins: str) -> str:
    return sql(
        f"""SELECT {key}, CAST(CASE WHEN hi = lo THEN 0 ELSE
            least(floor(CAST(x - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) * bins), bins - 1) END AS INTEGER) AS bin,
        count(*) AS n FROM whole JOIN limits USING ({key}) GROUP BY ALL""",
        "sales",
        extra=f"""whole AS (SELECT {key}, sales_quantity AS x FROM sales),
limits AS (SELECT {key}, min(x) AS lo, max(x) AS hi, {bins} AS bins FROM whole GROUP BY 1)""",
    )


_LOG2_BINS = "CAST(floor(log2(count(*))) AS INTEGER) + 1"
_ALL_NUMERIC = (CATEGORY, SKU, PRICE, QUANTITY, *_CALENDAR)
_REDUCED = tuple(c for c in _ALL_NUMERIC if c not in ("day_of_year", "week", "quarter", "is_weekend"))
_COUNTED = """SELECT {c}, count(*) AS "count", round(count(*) / (SELECT count(*) FROM sales), 9) AS proportion
FROM sales GROUP BY {c}"""
_LAG_COLUMNS = [f"lag_{i}_sales_{v}" for v in ("price", "quantity") for i in (1, 2, 3)]


def _null_counts(columns: list[str]) -> str:
    return ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}_null_count" for c in columns)


ORACLES: dict[str, str] = {
    "sketched_profile": sql(
        "SELECT c AS \"column\", count(*) AS n_rows, count(*) - count(x) AS n_null, true AS distinct_near, true AS median_near FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS c, date, CAST({c} AS DOUBLE) AS x FROM sales" for c in (SKU, CATEGORY, PRICE, QUANTITY))
        + ") WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY c",
        "sales",
    ),
    "daily_sku": sql(f"SELECT sku_id, {_DAILY} FROM daily_sku", "daily_sku"),
    "daily_category": sql(f"SELECT category_id, {_DAILY} FROM daily_category", "daily_category"),
    "sale_span": sql(
        "SELECT sku_id, min(date) AS min_date, max(date) AS max_date FROM sales GROUP BY sku_id", "sales"
    ),
    "null_counts_lags": sql(
        f"SELECT {_null_counts(['sku_id', 'date', 'n_rows', *_LAG_COLUMNS])} FROM lags JOIN daily_sku USING (sku_id, date)",
        "lags",
    ),
    "null_counts_averages": sql(
        f"""SELECT {_null_counts(['category_id', 'date', 'n_rows', 'sma_5_sales_price', 'sma_5_sales_quantity'])}
        FROM averages JOIN daily_category USING (category_id, date)""",
        "averages",
    ),
    "distinct_counts": sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n_unique FROM (SELECT DISTINCT {c} FROM sales)""" for c in _PROFILED
        ),
        "sales",
    ),
    "value_counts_category": sql(_COUNTED.format(c="category_id"), "sales"),
    "value_counts_sku": sql(_COUNTED.format(c="sku_id"), "sales"),
    "top_skus": sql(_COUNTED.format(c="sku_id") + ' ORDER BY "count" DESC, sku_id LIMIT 10', "sales"),
    "bottom_skus": sql(_COUNTED.format(c="sku_id") + ' ORDER BY "count", sku_id DESC LIMIT 10', "sales"),
    "summary": _summary_sql(),
    "correlation": _correlation_sql(_ALL_NUMERIC),
    "correlation_reduced": _correlation_sql(_REDUCED),
    "correlation_wide": _correlation_sql(_ALL_NUMERIC),
    "filtered_total": sql(
        """SELECT CAST(sum(sales_quantity) AS BIGINT) AS sales_quantity FROM sales
        WHERE category_id = 7 AND date = DATE '1996-11-18'""",
        "sales",
    ),
    **{
        name: sql(
            f"""SELECT {key}, CAST(max(date) - min(date) + 1 AS INTEGER) AS required_dates_count,
            count(DISTINCT date) AS actual_unique_dates_count FROM sales GROUP BY {key}""",
            "sales",
        )
        for name, key in (("gap_report_sku", "sku_id"), ("gap_report_category", "category_id"))
    },
    "histograms": _histogram_sql(),
    "histogram_by_category": _grouped_histogram_sql("category_id", _LOG2_BINS),
    "histogram_by_sku": _grouped_histogram_sql("sku_id", "10"),
    "metrics": sql(
        f"""SELECT round(-sqrt(avg((y - p) * (y - p))), 6) AS test_neg_root_mean_squared_error,
        round(-avg(abs(y - p)), 6) AS test_neg_mean_absolute_error,
        round(1 - var_pop(y - p) / var_pop(y), 6) AS test_explained_variance, count(*) AS n_rows,
        CAST(0 AS BIGINT) AS n_skipped FROM predicted""",
        "with_lags",
        extra=f"""predicted AS (SELECT CAST(sales_quantity AS DOUBLE) AS y,
            (lag_1_sales_quantity + lag_2_sales_quantity + lag_3_sales_quantity) / 3 AS p FROM with_lags
            WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _LAG_COLUMNS)})""",
    ),
    "distinct_categories": sql("SELECT DISTINCT category_id FROM sales", "sales"),
    "daily_series": sql(
        "SELECT date, CAST(sum(sales_quantity) AS BIGINT) AS sales_quantity FROM sales GROUP BY date ORDER BY date",
        "sales",
    ),
    "daily_series_category": sql(
        """SELECT category_id, date, CAST(sum(sales_quantity) AS BIGINT) AS sales_quantity FROM sales
        GROUP BY category_id, date ORDER BY category_id, date""",
        "sales",
    ),
    "daily_series_sampled": sql(
        """SELECT sku_id, date, CAST(sum(sales_quantity) AS BIGINT) AS sales_quantity FROM sales
        WHERE sku_id IN (SELECT sku_id FROM (SELECT DISTINCT sku_id FROM sales)
            ORDER BY md5(concat_ws('|', sku_id, '42')), sku_id LIMIT 20)
        GROUP BY sku_id, date ORDER BY sku_id, date""",
        "sales",
    ),
    "day_arrays": sql("SELECT sku_id, date, round(sales_price, 6) AS sales_price, sales_quantity FROM daily_sku", "daily_sku"),
}
