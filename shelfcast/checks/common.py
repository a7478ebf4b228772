"""Shared pieces of the registered queries and of their SQL counterparts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.sources.holidays import EASTER_HOLIDAYS, FIXED_HOLIDAYS, holiday_calendar
from shelfcast.sources.sales import sales_from_lineitem

Query = Callable[[SparkSession, str], DataFrame]

FIRST_YEAR, LAST_YEAR = 1990, 2030
FORECAST_START = dt.date(2001, 6, 1)
DIGITS = 6


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sales(spark: SparkSession, tables: str, **options: bool) -> DataFrame:
    return sales_from_lineitem(spark, tables, **options)


def calendar(spark: SparkSession) -> DataFrame:
    return holiday_calendar(spark, FIRST_YEAR, LAST_YEAR)


def _holiday_cte() -> str:
    fixed = " UNION ALL ".join(
        f"SELECT make_date(y, {m}, {d}) AS date FROM years WHERE y BETWEEN {a} AND {b}"
        for m, d, _, a, b in FIXED_HOLIDAYS
    )
    movable = " UNION ALL ".join(f"SELECT easter + {n} AS date FROM easters" for n, _ in EASTER_HOLIDAYS)
    return f"""
years AS (SELECT CAST(range AS INTEGER) AS y FROM range({FIRST_YEAR}, {LAST_YEAR + 1})),
paschal AS (SELECT y, (19 * (y % 19) + 15) % 30 AS d FROM years),
easters AS (SELECT make_date(y, 4, 4) + CAST(d + (2 * (y % 4) + 4 * (y % 7) - d + 34) % 7 AS INTEGER) AS easter
            FROM paschal),
holidays AS (SELECT DISTINCT date FROM ({fixed} UNION ALL {movable}))"""


def _lags(prefix: str = "") -> str:
    return ", ".join(
        f"lag({prefix}{c}, {i}) OVER w AS lag_{i}_{c}" for c in ("sales_price", "sales_quantity") for i in (1, 2, 3)
    )


CTES = {
    "sales": """
sales AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(substr(p_brand, 7) AS BIGINT) AS category_id,
    l_partkey AS sku_id, l_extendedprice AS sales_price, CAST(l_quantity AS BIGINT) AS sales_quantity,
    md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE),
        CAST(l_quantity AS BIGINT))) AS row_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "daily_sku": """
daily_sku AS (SELECT sku_id, date, avg(sales_price) AS sales_price,
    CAST(coalesce(sum(sales_quantity), 0) AS BIGINT) AS sales_quantity, count(*) AS n_rows
  FROM sales GROUP BY sku_id, date)""",
    "daily_category": """
daily_category AS (SELECT category_id, date, avg(sales_price) AS sales_price,
    CAST(coalesce(sum(sales_quantity), 0) AS BIGINT) AS sales_quantity, count(*) AS n_rows
  FROM sales GROUP BY category_id, date)""",
    "lags": f"""
lags AS (SELECT sku_id, date, {_lags()} FROM daily_sku WINDOW w AS (PARTITION BY sku_id ORDER BY date))""",
    "averages": """
averages AS (SELECT category_id, date,
    CASE WHEN count(sales_price) OVER w >= 5 THEN avg(sales_price) OVER w END AS sma_5_sales_price,
    CASE WHEN count(sales_quantity) OVER w >= 5 THEN avg(sales_quantity) OVER w END AS sma_5_sales_quantity
  FROM daily_category WINDOW w AS (PARTITION BY category_id ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))""",
    "holidays": _holiday_cte(),
    "with_lags": "with_lags AS (SELECT s.*, l.* EXCLUDE (sku_id, date) FROM sales s JOIN lags l USING (sku_id, date))",
    "features": """
features AS (SELECT s.date, s.category_id, s.sku_id, s.sales_price, s.sales_quantity, s.row_id,
    CAST(year(s.date) AS INTEGER) AS year, CAST(month(s.date) AS INTEGER) AS month,
    CAST(day(s.date) AS INTEGER) AS day, CAST(isodow(s.date) AS INTEGER) AS weekday,
    s.date IN (SELECT date FROM holidays) AS is_ukrainian_holiday,
    l.lag_1_sales_price, l.lag_2_sales_price, l.lag_3_sales_price,
    l.lag_1_sales_quantity, l.lag_2_sales_quantity, l.lag_3_sales_quantity,
    a.sma_5_sales_price, a.sma_5_sales_quantity
  FROM sales s JOIN lags l USING (sku_id, date) JOIN averages a USING (category_id, date))""",
    "split": """
split AS (SELECT *, CAST('0x' || substr(md5(row_id || '|'), 1, 8) AS BIGINT) % 100 < 12 AS is_test FROM sales)""",
}

_NEEDS = {
    "sales": (),
    "holidays": (),
    "daily_sku": ("sales",),
    "daily_category": ("sales",),
    "lags": ("daily_sku",),
    "averages": ("daily_category",),
    "with_lags": ("sales", "lags"),
    "features": ("sales", "holidays", "lags", "averages"),
    "split": ("sales",),
}

PRESENT = " AND ".join(
    f"{c} IS NOT NULL"
    for c in (
        *(f"lag_{i}_sales_{v}" for v in ("price", "quantity") for i in (1, 2, 3)),
        "sma_5_sales_price",
        "sma_5_sales_quantity",
    )
)


def sql(select: str, *ctes: str, extra: str = "") -> str:
    """``select`` preceded by the named CTEs and whatever they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        add(name)
    parts = [CTES[name].strip() for name in ordered] + ([extra.strip()] if extra else [])
    return f"WITH {', '.join(parts)}\n{select.strip()}" if parts else select.strip()


def rounded_columns(columns: tuple[str, ...], digits: int = DIGITS) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
