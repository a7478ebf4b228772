"""Lag and mean features kept up to date by a stream of daily rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfcast.functions.values import array_mean
from shelfcast.schema import CATEGORY, DATE, NUM_LAGS, PRICE, QUANTITY, SKU, WINDOW_SIZE, lag_names, sma_names

#: Groups of keys that share a state; fixed once a stream has started.
GROUPS = 2048

# The last days of the keys of a group: keys, day numbers, prices and quantities as the bytes of their arrays, in
# the order of key and day.
_STATE = "keys binary, days binary, prices binary, quantities binary"


def _recent_names(column: str, k: int) -> list[str]:
    return [f"{column}_{i}" for i in range(1, k + 1)]


def _with_recent_days(daily: DataFrame, key: str, k: int, groups: int = GROUPS) -> DataFrame:
    """Each daily row with price_i and quantity_i of the i-th day before it, up to ``k`` days back.

    Rows not after the last seen day are marked late. A key has one row per day, so its state is ``k``
    days and its input one row per new day. Keys are dealt into ``groups`` by a hash; a group is worked on
    in arrays, so a key costs no call of its own.
    """
    names = [*_recent_names("price", k), *_recent_names("quantity", k)]
    schema = ", ".join([f"{key} long, day long, late boolean", *[f"{n} double" for n in names]])

    # Defined in here and using no function of this package, so that it travels to workers as it is.
    def advance(group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kinds = ("int64", "int64", "float64", "float64")
        rows = pd.concat(list(chunks))
        new = [rows[c].to_numpy(dtype=t) for c, t in zip((key, "day", PRICE, QUANTITY), kinds)]
        order = np.lexsort((new[1], new[0]))
        new = [c[order] for c in new]
        held = state.get if state.exists else (b"",) * 4
        seen = [np.frombuffer(cells, dtype=t) for cells, t in zip(held, kinds)]
        late = np.zeros(len(order), dtype=bool)
        late[1:] = (new[0][1:] == new[0][:-1]) & (new[1][1:] == new[1][:-1])
        if len(seen[0]):
            newest = np.searchsorted(seen[0], new[0], side="right") - 1
            late |= (newest >= 0) & (seen[0][newest] == new[0]) & (new[1] <= seen[1][newest])
        fresh = np.concatenate([np.zeros(len(seen[0]), dtype=bool), np.ones(int((~late).sum()), dtype=bool)])
        every = [np.concatenate([a, b[~late]]) for a, b in zip(seen, new)]
        order = np.lexsort((every[1], every[0]))
        every, fresh = [c[order] for c in every], fresh[order]
        at = np.flatnonzero(fresh)
        out = {key: [every[0][at], new[0][late]], "day": [every[1][at], new[1][late]]}
        out["late"] = [np.zeros(len(at), dtype=bool), np.ones(int(late.sum()), dtype=bool)]
        for name, values in (("price", every[2]), ("quantity", every[3])):
            for i in range(1, k + 1):
                back = np.maximum(at - i, 0)
                known = (at >= i) & (every[0][back] == every[0][at])
                out[f"{name}_{i}"] = [np.where(known, values[back], np.nan), np.full(int(late.sum()), np.nan)]
        kept = np.ones(len(order), dtype=bool)
        kept[:-k] = every[0][:-k] != every[0][k:]
        state.update(tuple(c[kept].tobytes() for c in every))
        yield pd.DataFrame({name: np.concatenate(parts) for name, parts in out.items()})[[key, "day", "late", *names]]

    days = daily.where(F.col(key).isNotNull()).select(
        key,
        F.unix_date(DATE).cast("long").alias("day"),
        F.col(PRICE).cast("double").alias(PRICE),
        F.col(QUANTITY).cast("double").alias(QUANTITY),
    )
    grouped = days.withColumn("__group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")).groupBy("__group")
    recent = grouped.applyInPandasWithState(
        advance, schema, _STATE, "append", GroupStateTimeout.NoTimeout
    )
    # A missing value comes back from pandas as NaN.
    known = [F.when(~F.isnan(n), F.col(n)).alias(n) for n in names]
    date = F.date_from_unix_date(F.col("day").cast("int")).alias(DATE)
    return recent.select(key, date, "late", *known)


def lag_stream(daily: DataFrame, key: str = SKU, *, lags: int = NUM_LAGS, groups: int = GROUPS) -> DataFrame:
    """(key, date, late, lag columns) for a stream of daily rows."""
    recent = _with_recent_days(daily, key, lags, groups)
    values = [*_recent_names("price", lags), *_recent_names("quantity", lags)]
    renamed = [F.col(v).alias(name) for v, name in zip(values, lag_names(lags), strict=True)]
    return recent.select(key, DATE, "late", *renamed)


def mean_stream(daily: DataFrame, key: str = CATEGORY, *, window: int = WINDOW_SIZE, groups: int = GROUPS) -> DataFrame:
    """(key, date, late, mean of the up to ``window`` days before the row's day)."""
    recent = _with_recent_days(daily, key, window, groups)
    means = [
        array_mean(F.array(*_recent_names(column, window))).alias(name)
        for column, name in zip(("price", "quantity"), sma_names(window), strict=True)
    ]
    return recent.select(key, DATE, "late", *means)
