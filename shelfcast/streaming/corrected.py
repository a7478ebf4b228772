"""Lags and averages of a stream of sales in any order, corrections of what late rows change included.

The state of a group of keys is their days, as sums; a batch adds to them and every row that looks back at a
changed day comes out again with its new values. The last version of every row is that of the batch tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructType

from shelfcast.operators.refresh import MONTH, month_of, months_of, read_months, replace_months
from shelfcast.schema import CATEGORY, DATE, NUM_LAGS, PRICE, QUANTITY, SKU, WINDOW_SIZE, lag_name, sma_names
from shelfcast.session import cut_lineage, ship

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DAY_MS = 86_400_000
_SUMS = ("price_sum", "n_prices", "quantity_sum", "n_rows")

#: Groups of keys that share a state; fixed once a stream has started.
GROUPS = 2048

#: Days of the keys of a group, each column as the bytes of its array, in the order of key and day.
_STATE = "keys binary, days binary, price_sum binary, n_prices binary, quantity_sum binary, n_rows binary"
_TYPES = (np.int64, np.int32, np.float64, np.int32, np.float64, np.int32)


def _starts(keys: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Places at which a run of equal rows begins."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = False
    for column in (keys, *others):
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of every row within its key, first row of every key) of sorted keys."""
    first = _starts(keys)
    return np.arange(len(keys)) - np.repeat(first, np.diff(first, append=len(keys))), first


class CorrectedDays(StatefulProcessor):
    """Days of a group of keys with the ``reach`` days before each.

    Rows older than the watermark do not arrive, so no day before it changes any more. Of these the newest
    ``reach`` of a key stay, as later days look back at them; a timer drops the others, also for keys without
    new rows. The keys of a group are worked on together, in arrays.
    """

    def __init__(self, key: str, reach: int):
        self.key, self.reach = key, reach

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getValueState("days", _STATE)

    def _held(self) -> list[np.ndarray]:
        stored = self.days.get() if self.days.exists() else [b""] * len(_TYPES)
        return [np.frombuffer(cells, dtype=kind) for cells, kind in zip(stored, _TYPES)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._held()
        chunks = [[chunk[c].to_numpy() for c in (self.key, "day", *_SUMS)] for chunk in rows]
        columns = [np.concatenate([own, *[c[i] for c in chunks]]).astype(kind) for i, (own, kind) in enumerate(zip(before, _TYPES))]
        fresh = np.arange(len(columns[0])) >= len(before[0])
        order = np.lexsort((columns[1], columns[0]))
        columns, fresh = [c[order] for c in columns], fresh[order]
        at = _starts(*columns[:2])
        held = [c[at] for c in columns[:2]] + [np.add.reduceat(c, at).astype(c.dtype) for c in columns[2:]]
        changed = np.logical_or.reduceat(fresh, at)
        keys, days, price_sum, n_prices, quantities, n_rows = held
        place, _ = _places(keys)
        wanted = changed.copy()
        for i in range(1, self.reach + 1):
            wanted[i:] |= changed[:-i] & (place[i:] >= i)
        prices = np.where(n_prices > 0, price_sum / np.maximum(n_prices, 1), np.nan)
        chosen = np.flatnonzero(wanted)
        back = np.minimum(place[chosen], self.reach)
        out = {self.key: keys[chosen], "day": days[chosen].astype(np.int64), "price": prices[chosen], "quantity": quantities[chosen]}
        out |= {"n_rows": n_rows[chosen].astype(np.int64), "n_back": back.astype(np.int32)}
        for name, values in (("price", prices), ("quantity", quantities)):
            for i in range(1, self.reach + 1):
                out[f"{name}_{i}"] = np.where(back >= i, values[np.maximum(chosen - i, 0)], np.nan)
        self._keep(held, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(self._held(), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def _keep(self, held: list[np.ndarray], watermark: int) -> None:
        """Store the days that rows to come can change or look back at; wake up when that is fewer.

        Timers set before stay: one too early stores the same days again.
        """
        place, first = _places(held[0])
        if not len(first):
            return
        days_of = np.diff(first, append=len(place))
        closed = np.add.reduceat(((held[1].astype(np.int64) + 1) * DAY_MS <= watermark).astype(np.int64), first)
        dropped = np.repeat(np.maximum(closed - self.reach, 0), days_of)
        kept = place >= dropped
        self.days.update(tuple(column[kept].tobytes() for column in held))
        next_closed = held[1][place - dropped == self.reach]
        if len(next_closed):
            self.handle.registerTimer((int(next_closed.min()) + 1) * DAY_MS)

    def close(self) -> None:
        pass


def _sums_of_batches(rows: Iterator[pa.RecordBatch], key: str, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        sums = pa.Table.from_batches([batch]).group_by([key, "__time"]).aggregate([(c, "sum") for c in _SUMS])
        yield from sums.select([key, "__time", *[f"{c}_sum" for c in _SUMS]]).rename_columns(list(names)).to_batches()


def corrected_days(sales: DataFrame, key: str, reach: int, delay: str, groups: int = GROUPS) -> DataFrame:
    """(key, date, price, quantity, n_rows, prices, quantities) of every day that a batch changes and of the
    ``reach`` sale days after it; the arrays hold the days before, newest first.

    Sales have a date and may come in any order up to ``delay`` behind the newest date; later ones are dropped
    and counted by Spark. Those without a key or date are left out. Sums are formed inside the tasks that read,
    so a hot key's own task receives a row a day and Arrow batch, not its sales. Keys are dealt into ``groups``
    by a hash, and a group is one call and one state: a key costs no call of its own.
    """
    spark = sales.sparkSession
    ship(spark)
    known = sales.where(F.col(key).isNotNull() & F.col(DATE).isNotNull()).select(
        F.col(key).cast("long").alias(key),
        F.timestamp_seconds(F.unix_date(DATE).cast("long") * F.lit(86_400)).alias("__time"),
        F.coalesce(F.col(PRICE).cast("double"), F.lit(0.0)).alias("price_sum"),
        F.when(F.col(PRICE).isNull(), 0).otherwise(1).cast("long").alias("n_prices"),
        F.coalesce(F.col(QUANTITY).cast("double"), F.lit(0.0)).alias("quantity_sum"),
        F.lit(1).cast("long").alias("n_rows"),
    )
    names = known.columns
    sums = known.mapInArrow(lambda rows: _sums_of_batches(rows, key, names), known.schema).withWatermark("__time", delay)
    days = sums.withColumn("day", F.floor(F.unix_seconds("__time") / F.lit(86_400)).cast("long"))
    days = days.withColumn("__group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))
    backward = [f"{name}_{i}" for name in ("price", "quantity") for i in range(1, reach + 1)]
    out = days.groupBy("__group").transformWithStateInPandas(
        CorrectedDays(key, reach),
        f"{key} long, day long, price double, quantity double, n_rows long, n_back int, " + ", ".join(f"{c} double" for c in backward),
        "update",
        "EventTime",
    )
    # A missing price comes back from pandas as NaN.
    price = F.when(~F.isnan("price"), F.col("price")).alias(PRICE)
    date = F.date_from_unix_date(F.col("day").cast("int")).alias(DATE)
    before = [F.slice(F.array(*part), F.lit(1), F.col("n_back")).alias(name) for part, name in ((backward[:reach], "prices"), (backward[reach:], "quantities"))]
    return out.select(key, date, price, F.col("quantity").alias(QUANTITY), "n_rows", *before)


def corrected_lags(sales: DataFrame, *, key: str = SKU, lags: int = NUM_LAGS, delay: str = "400 days", groups: int = GROUPS) -> DataFrame:
    """(key, date, lag columns), every version of them."""
    days = corrected_days(sales, key, lags, delay, groups)
    before = {PRICE: _known("prices"), QUANTITY: F.col("quantities")}
    columns = [F.get(values, F.lit(i - 1)).alias(lag_name(i, c)) for c, values in before.items() for i in range(1, lags + 1)]
    return days.select(key, DATE, *columns)


def corrected_averages(sales: DataFrame, *, key: str = CATEGORY, window: int = WINDOW_SIZE, delay: str = "400 days", groups: int = GROUPS) -> DataFrame:
    """(key, date, means over the last ``window`` sale days, the day included), null unless all hold a value."""
    days = corrected_days(sales, key, window - 1, delay, groups)
    columns = []
    for own, before, name in zip((PRICE, QUANTITY), (_known("prices"), F.col("quantities")), sma_names(window), strict=True):
        values = F.filter(F.concat(F.array(own), before), lambda v: v.isNotNull())
        total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        columns.append(F.when(F.size(values) == window, total / F.lit(window)).alias(name))
    return days.select(key, DATE, *columns)


def _known(values: str) -> Column:
    return F.transform(values, lambda v: F.when(~F.isnan(v), v))


def _stored_schema(table: StructType) -> StructType:
    return StructType([*table.fields]).add(MONTH, StringType())


def keep_last_versions(versions: DataFrame, key: str, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Keep the last version of every (key, date) in the table at ``path``, by month.

    A batch replaces its rows in the months it touches and reads and writes these alone; it may be run again
    after a failure. By default the stream ends with what is available. The state is in RocksDB, as state
    with timers needs; the session's own setting is put back.
    """
    spark = versions.sparkSession
    schema = _stored_schema(versions.schema)

    def process(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = cut_lineage(batch.withColumn(MONTH, month_of(F.col(DATE))))
        touched = months_of(rows)
        if touched:
            held = read_months(session, path, schema, touched)
            replace_months(held.join(rows.select(key, DATE), [key, DATE], "left_anti").unionByName(rows), path, touched)

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        writer = versions.writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def last_versions(spark: SparkSession, versions: StructType, path: str) -> DataFrame:
    """The table of :func:`keep_last_versions`; ``versions`` is the schema of its stream."""
    return read_months(spark, path, _stored_schema(versions)).drop(MONTH)
