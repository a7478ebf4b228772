"""Lag and moving-average tables by window functions over a daily table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.schema import (
    CATEGORY,
    DATE,
    N_ROWS,
    NUM_LAGS,
    PRICE,
    QUANTITY,
    SKU,
    WINDOW_SIZE,
    lag_name,
    sma_name,
)


def lag_table(
    daily: DataFrame,
    key: str = SKU,
    *,
    lags: int = NUM_LAGS,
    columns: Sequence[str] = (PRICE, QUANTITY),
) -> DataFrame:
    """Values of the previous 1..lags sale days (not calendar days) per key and day."""
    w = Window.partitionBy(key).orderBy(DATE)
    lagged = [F.lag(c, i).over(w).alias(lag_name(i, c)) for c in columns for i in range(1, lags + 1)]
    return daily.where(F.col(key).isNotNull()).select(key, DATE, *_carried(daily), *lagged)


def moving_average_table(
    daily: DataFrame,
    key: str = CATEGORY,
    *,
    window: int = WINDOW_SIZE,
    include_current: bool = True,
    columns: Sequence[str] = (PRICE, QUANTITY),
) -> DataFrame:
    """Mean over the last ``window`` sale days per key; null unless all of them hold a value.

    ``include_current=True`` lets the day itself into its own average, which leaks the target into
    training rows; ``False`` averages the days before it.
    """
    last = 0 if include_current else -1
    w = Window.partitionBy(key).orderBy(DATE).rowsBetween(last - window + 1, last)
    means = [
        F.when(F.count(c).over(w) >= window, F.avg(c).over(w)).alias(sma_name(window, c)) for c in columns
    ]
    return daily.where(F.col(key).isNotNull()).select(key, DATE, *_carried(daily), *means)


def _carried(daily: DataFrame) -> list[str]:
    return [N_ROWS] if N_ROWS in daily.columns else []
