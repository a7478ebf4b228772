"""Daily tables: one row per key and sale day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast.schema import CATEGORY, DATE, N_ROWS, PRICE, QUANTITY, SKU
from shelfcast.session import cut_lineage


def daily(sales: DataFrame, key: str) -> DataFrame:
    """Mean price, summed quantity (0 when all null) and row count per key and day.

    Every task reduces its rows before the exchange, so a key holding a third of all rows sends one
    row per day and task. The result has at most one row per calendar day for any key, which bounds
    every window and array built on it.
    """
    return sales.groupBy(key, DATE).agg(
        F.avg(PRICE).alias(PRICE),
        F.coalesce(F.sum(QUANTITY), F.lit(0)).alias(QUANTITY),
        F.count(F.lit(1)).alias(N_ROWS),
    )


def daily_sku(sales: DataFrame) -> DataFrame:
    return daily(sales, SKU)


def daily_category(sales: DataFrame) -> DataFrame:
    return daily(sales, CATEGORY)


def daily_base(sales: DataFrame, path: str | None = None) -> DataFrame:
    """Sums and counts per SKU, category and day, stored: what both daily tables are rolled up from."""
    return cut_lineage(
        sales.groupBy(SKU, CATEGORY, DATE).agg(
            F.sum(PRICE).alias("price_sum"),
            F.count(PRICE).alias("n_prices"),
            F.sum(QUANTITY).alias(QUANTITY),
            F.count(F.lit(1)).alias(N_ROWS),
        ),
        path,
    )


def roll_up(base: DataFrame, key: str) -> DataFrame:
    """The table that :func:`daily` gives, from the sums of :func:`daily_base`."""
    return base.groupBy(key, DATE).agg(
        F.try_divide(F.sum("price_sum"), F.sum("n_prices")).alias(PRICE),
        F.coalesce(F.sum(QUANTITY), F.lit(0)).alias(QUANTITY),
        F.sum(N_ROWS).alias(N_ROWS),
    )


def sale_span(sales: DataFrame, key: str = SKU) -> DataFrame:
    """First and last sale day per key."""
    return sales.groupBy(key).agg(F.min(DATE).alias("min_date"), F.max(DATE).alias("max_date"))


def gap_report(sales: DataFrame, key: str) -> DataFrame:
    """Calendar days spanned by each key against the days it has rows for."""
    return sales.groupBy(key).agg(
        (F.datediff(F.max(DATE), F.min(DATE)) + F.lit(1)).alias("required_dates_count"),
        F.count_distinct(DATE).alias("actual_unique_dates_count"),
    )


def daily_series(sales: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Quantity sold per day, overall or per key, in date order."""
    out = sales.groupBy(*keys, DATE).agg(F.sum(QUANTITY).alias(QUANTITY))
    return out.orderBy(*[F.col(k).asc_nulls_first() for k in (*keys, DATE)])


def as_arrays(daily_table: DataFrame, key: str) -> DataFrame:
    """One row per key with its days as a date-ordered array (at most one entry per calendar day)."""
    day = F.struct(DATE, PRICE, QUANTITY)
    return daily_table.groupBy(key).agg(F.sort_array(F.collect_list(day)).alias("days"))


def from_arrays(arrays: DataFrame, key: str) -> DataFrame:
    """Inverse of :func:`as_arrays`."""
    return arrays.select(key, F.inline("days"))
