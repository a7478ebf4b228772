"""As-of lookup: the latest k history days per key at or before each sample's date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.functions.values import array_mean
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

RECENT = "recent"


def sample_days(samples: DataFrame, key: str) -> DataFrame:
    """Distinct (key, date) of the samples with their row counts; null keys can match nothing."""
    known = F.col(key).isNotNull() & F.col(DATE).isNotNull()
    return samples.where(known).groupBy(key, DATE).agg(F.count(F.lit(1)).alias(N_ROWS))


def last_k_days(days: DataFrame, history: DataFrame, key: str, k: int, *, inclusive: bool = True) -> DataFrame:
    """For each row of ``days`` (unique key, date) the last ``k`` days of ``history``, oldest first.

    Both sides go through one exchange on the key. The windows see at most two rows per calendar day
    for any key, however many samples or sales the key has. ``inclusive`` decides whether a history
    day equal to the sample's date may be used.
    """
    observed = history.where(F.col(key).isNotNull() & F.col(DATE).isNotNull()).select(
        key,
        DATE,
        F.lit(0).cast("long").alias(N_ROWS),
        F.struct(DATE, PRICE, F.col(QUANTITY).cast("double").alias(QUANTITY)).alias("__day"),
        F.lit(False).alias("__sample"),
    )
    wanted = days.select(
        key,
        DATE,
        N_ROWS,
        F.lit(None).cast(observed.schema["__day"].dataType).alias("__day"),
        F.lit(True).alias("__sample"),
    )
    same_day = F.col("__sample") if inclusive else ~F.col("__sample")
    by_kind = Window.partitionBy(key, "__sample").orderBy(DATE).rowsBetween(-(k - 1), 0)
    by_time = Window.partitionBy(key).orderBy(DATE, same_day).rowsBetween(Window.unboundedPreceding, 0)
    gathered = F.when(~F.col("__sample"), F.collect_list("__day").over(by_kind))
    return (
        observed.unionByName(wanted)
        .repartition(key)
        .withColumn("__days", gathered)
        .withColumn(RECENT, F.last("__days", ignorenulls=True).over(by_time))
        .where("__sample")
        .select(key, DATE, N_ROWS, RECENT)
    )


def lags_asof(
    days: DataFrame, history: DataFrame, key: str = SKU, *, lags: int = NUM_LAGS, inclusive: bool = True
) -> DataFrame:
    """Price and quantity of the last 1..lags history days as columns; null where there are fewer."""
    recent = last_k_days(days, history, key, lags, inclusive=inclusive)
    columns = [
        F.try_element_at(RECENT, F.lit(-i))[c].alias(lag_name(i, c))
        for c in (PRICE, QUANTITY)
        for i in range(1, lags + 1)
    ]
    return recent.select(key, DATE, N_ROWS, *columns)


def means_asof(
    days: DataFrame, history: DataFrame, key: str = CATEGORY, *, window: int = WINDOW_SIZE, inclusive: bool = True
) -> DataFrame:
    """Mean price and quantity of the last 1..window history days; null where there is none."""
    recent = last_k_days(days, history, key, window, inclusive=inclusive)
    return recent.select(
        key, DATE, N_ROWS, *[array_mean(f"{RECENT}.{c}").alias(sma_name(window, c)) for c in (PRICE, QUANTITY)]
    )

