"""Live tables of bounded size: batches of sales merged into the months they touch, windows corrected with them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from shelfcast.operators.refresh import MONTH, StoredWindows, month_of, months_of, read_months, replace_months
from shelfcast.schema import DATE, N_ROWS, PRICE, QUANTITY
from shelfcast.session import cut_lineage

_SUMS = ("price_sum", "n_prices", "quantity_sum", N_ROWS)
_BATCH = "__batch"


@dataclass(frozen=True)
class LiveDaily:
    """The daily table of a stream of sales: one row a key and day, whatever the number of batches.

    A batch adds its sums to the months it touches and rewrites these alone. Every month notes the last
    batch it holds, so one that is run again after a failure goes only into the months it had not reached.
    Rows may be of any day, however late. Those without a key or a date are left out.
    """

    path: str
    key: str

    def _schema(self) -> StructType:
        sums = [StructField(c, DoubleType() if c in ("price_sum", "quantity_sum") else LongType()) for c in _SUMS]
        return StructType([StructField(self.key, LongType()), StructField(DATE, DateType()), *sums, StructField(_BATCH, LongType()), StructField(MONTH, StringType())])

    def rows(self, spark: SparkSession, months: list[str] | None = None) -> DataFrame:
        """(key, date, price, quantity, n_rows), as the batch table has them."""
        sums = read_months(spark, self.path, self._schema(), months)
        return sums.select(
            self.key, DATE, F.try_divide("price_sum", "n_prices").alias(PRICE), F.coalesce("quantity_sum", F.lit(0.0)).alias(QUANTITY), N_ROWS
        )

    def merge(self, sales: DataFrame, batch: int) -> DataFrame:
        """Add a batch; its (key, date), stored."""
        spark = sales.sparkSession
        known = sales.where(F.col(self.key).isNotNull() & F.col(DATE).isNotNull())
        added = known.groupBy(F.col(self.key).cast("long").alias(self.key), DATE).agg(
            F.sum(F.col(PRICE).cast("double")).alias("price_sum"),
            F.count(PRICE).alias("n_prices"),
            F.sum(F.col(QUANTITY).cast("double")).alias("quantity_sum"),
            F.count(F.lit(1)).alias(N_ROWS),
        )
        added = cut_lineage(added.withColumns({_BATCH: F.lit(batch).cast("long"), MONTH: month_of(F.col(DATE))}))
        touched = months_of(added)
        if touched:
            held = read_months(spark, self.path, self._schema(), touched)
            reached = {r[0] for r in held.groupBy(MONTH).agg(F.max(_BATCH).alias("last")).where(F.col("last") >= batch).collect()}
            open_ = [m for m in touched if m not in reached]
            if open_:
                both = held.unionByName(added.select(*held.columns)).where(F.col(MONTH).isin(open_))
                sums = both.groupBy(self.key, DATE, MONTH).agg(*[F.sum(c).alias(c) for c in _SUMS])
                replace_months(sums.withColumn(_BATCH, F.lit(batch).cast("long")).select(*held.columns), self.path, open_)
        return added.select(self.key, DATE, MONTH)


def keep_live(
    sales: DataFrame, daily: LiveDaily, checkpoint: str, windows: Sequence[StoredWindows] = (), **trigger: object
) -> StreamingQuery:
    """Keep the daily table and the window tables of a stream of sales (with a date) up to date.

    After each batch the windows of its days and of those that look back at them are computed anew, so late
    rows correct what came out before, and the tables equal those of a batch job over all rows so far. A
    batch may be run again. ``trigger`` is that of the stream; by default it ends with what is available.
    """

    def process(batch: DataFrame, number: int) -> None:
        cells = daily.merge(batch, number)
        for stored in windows:
            stored.follow(daily.rows(batch.sparkSession, months_of(cells)), cells)

    started = sales.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return started.trigger(**(trigger or {"availableNow": True})).start()
