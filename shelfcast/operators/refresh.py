"""Window tables kept on storage and brought up to date after corrections, touched months only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, LongType, StringType, StructField, StructType

from shelfcast.operators.daily import daily
from shelfcast.operators.history import lag_table, moving_average_table
from shelfcast.schema import CATEGORY, DATE, N_ROWS, NUM_LAGS, PRICE, QUANTITY, SKU, WINDOW_SIZE
from shelfcast.session import cut_lineage, drop_path, folders, move_path, path_exists

MONTH = "__month"


def month_of(date: Column) -> Column:
    """A text that no reader of partitions takes for a date or a number."""
    return F.date_format(date, "'m'yyyyMM")


def months_of(table: DataFrame) -> list[str]:
    """The months of a table: as many as the calendar has."""
    return sorted(r[0] for r in table.select(MONTH).distinct().collect())


def replace_months(table: DataFrame, path: str, months: list[str] | None) -> None:
    """Replace the given months of the table at ``path`` (all: None), also those that have no row any more."""
    spark = table.sparkSession
    # Written aside, in a folder that readers pass over, and moved: a table cannot be read and replaced by the same job.
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    try:
        table.write.partitionBy(MONTH).parquet(staged)
        written = folders(spark, staged)
        held = [f for f in folders(spark, path) if f.startswith(f"{MONTH}=")] if months is None else [f"{MONTH}={m}" for m in months]
        for name in written:
            move_path(spark, f"{staged}/{name}", f"{path}/{name}")
        for name in set(held) - set(written):
            drop_path(spark, f"{path}/{name}")
    finally:
        drop_path(spark, staged)


def read_months(spark: SparkSession, path: str, schema: StructType, months: list[str] | None = None) -> DataFrame:
    """The given months of a table (all: None); one that was never written has no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(path)
    return table if months is None else table.where(F.col(MONTH).isin(months))


@dataclass(frozen=True)
class StoredWindows:
    """A daily table and the window table made of it, both in a folder by month, with the days a key has in
    each month.

    ``compute`` makes the window table from daily rows; a row of it looks back over ``reach`` sale days of
    its key at most. Rows without a key or a date are not kept.
    """

    path: str
    key: str
    compute: Callable[[DataFrame], DataFrame]
    reach: int
    quantity: DataType = field(default_factory=LongType)

    def _schema(self, spark: SparkSession, name: str) -> StructType:
        key = StructField(self.key, LongType())
        if name == "counts":
            return StructType([key, StructField("n_days", LongType()), StructField(MONTH, StringType())])
        days = StructType([key, StructField(DATE, DateType()), StructField(PRICE, DoubleType()), StructField(QUANTITY, self.quantity)])
        days = days.add(N_ROWS, LongType())
        rows = days if name == "days" else self.compute(spark.createDataFrame([], days)).schema
        return StructType([*rows.fields, StructField(MONTH, StringType())])

    def _read(self, spark: SparkSession, name: str, months: list[str] | None = None) -> DataFrame:
        return read_months(spark, f"{self.path}/{name}", self._schema(spark, name), months)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The window table."""
        return self._read(spark, "windows").drop(MONTH)

    def _write(self, table: DataFrame, name: str, months: list[str] | None) -> None:
        replace_months(table, f"{self.path}/{name}", months)

    def _counted(self, days: DataFrame) -> DataFrame:
        return days.groupBy(self.key, MONTH).agg(F.count(F.lit(1)).alias("n_days"))

    def build(self, sales: DataFrame) -> None:
        """Everything anew."""
        days = daily(sales.where(F.col(self.key).isNotNull() & F.col(DATE).isNotNull()), self.key)
        self._write(self._stored(days), "days", None)
        days = self._read(sales.sparkSession, "days")
        self._write(self._counted(days), "counts", None)
        self._write(self.compute(days.drop(MONTH)).withColumn(MONTH, month_of(F.col(DATE))), "windows", None)

    def refresh(self, sales: DataFrame, changed: DataFrame) -> None:
        """Bring the tables up to date after sales of the ``changed`` (key, date) were added, altered or
        deleted; ``sales`` are those that hold now. It does no harm to name days that did not change, or to
        run an interrupted refresh again.

        A changed day alters the windows of its key from that day to the ``reach``-th sale day after it. The
        counts of days tell which months hold those days and which hold the days they look back to; only
        these months are read, and only months with altered rows are written.
        """
        cells = self._cells(changed)
        # Sales stored by date are read for the span of these dates alone.
        first, last = cells.agg(F.min(DATE), F.max(DATE)).first()
        if first is None:
            return
        span = sales.where(F.col(DATE).between(F.lit(first), F.lit(last)))
        self._replace(daily(span.join(cells.select(self.key, DATE), [self.key, DATE], "left_semi"), self.key), cells)

    def replace(self, days: DataFrame, changed: DataFrame) -> None:
        """:func:`refresh` from the daily rows that the ``changed`` (key, date) have now."""
        cells = self._cells(changed)
        self._replace(days.join(cells.select(self.key, DATE), [self.key, DATE], "left_semi"), cells)

    def follow(self, days: DataFrame, changed: DataFrame) -> None:
        """:func:`replace` by all daily rows of the months of ``changed``: nothing held is looked at for them.

        ``changed`` is a stored table of different (key, date, month), none of them null.
        """
        touched = months_of(changed)
        if touched:
            self._write(self._stored(days), "days", touched)
            self._replace_windows(changed, touched)

    def _cells(self, changed: DataFrame) -> DataFrame:
        known = F.col(self.key).isNotNull() & F.col(DATE).isNotNull()
        return cut_lineage(changed.where(known).select(self.key, DATE).distinct().withColumn(MONTH, month_of(F.col(DATE))))

    def _replace(self, fresh: DataFrame, cells: DataFrame) -> None:
        spark, touched = cells.sparkSession, months_of(cells)
        if not touched:
            return
        kept = self._read(spark, "days", touched).join(cells.select(self.key, DATE), [self.key, DATE], "left_anti")
        self._write(kept.unionByName(self._stored(fresh)), "days", touched)
        self._replace_windows(cells, touched)

    def _replace_windows(self, cells: DataFrame, touched: list[str]) -> None:
        spark = cells.sparkSession
        keys = cut_lineage(cells.select(self.key).distinct())
        self._write(self._counted(self._read(spark, "days", touched)), "counts", touched)
        needed = cut_lineage(self._needed(cells, keys))
        altered = needed.where("altered").select(self.key, MONTH)
        days = self._read(spark, "days", months_of(needed)).join(keys, self.key, "left_semi")
        anew = self.compute(days.drop(MONTH)).withColumn(MONTH, month_of(F.col(DATE))).join(altered, [self.key, MONTH], "left_semi")
        months = months_of(altered)
        others = self._read(spark, "windows", months).join(altered, [self.key, MONTH], "left_anti")
        self._write(others.unionByName(anew.select(*others.columns)), "windows", months)

    def _stored(self, days: DataFrame) -> DataFrame:
        columns = [F.col(f.name).cast(f.dataType) for f in self._schema(days.sparkSession, "days") if f.name != MONTH]
        return days.select(*columns, month_of(F.col(DATE)).alias(MONTH))

    def _needed(self, cells: DataFrame, keys: DataFrame) -> DataFrame:
        """(key, month, altered): months of changed keys whose windows are altered, or whose days those look at.

        Between a changed month and an altered one lie fewer sale days than the reach, counted in full months,
        which is never too few.
        """
        changed = cells.select(self.key, MONTH).distinct().withColumn("hit", F.lit(True))
        counts = self._read(cells.sparkSession, "counts").join(keys, self.key, "left_semi")
        rows = counts.join(changed, [self.key, MONTH], "full").select(
            self.key, MONTH, F.coalesce("n_days", F.lit(0)).alias("n"), F.coalesce("hit", F.lit(False)).alias("hit")
        )
        ordered = Window.partitionBy(self.key).orderBy(MONTH)
        up_to, from_here = F.sum("n").over(ordered), F.sum("n").over(Window.partitionBy(self.key).orderBy(F.desc(MONTH)))
        rows = rows.withColumns({"up_to": up_to, "from_here": from_here})
        before = F.max(F.when(F.col("hit"), F.col("up_to"))).over(ordered)
        after = F.max(F.when(F.col("hit"), F.col("from_here"))).over(Window.partitionBy(self.key).orderBy(F.desc(MONTH)))
        altered = F.col("hit") | (F.col("up_to") - F.col("n") - before < self.reach)
        looked_at = F.col("from_here") - F.col("n") - after < self.reach
        marked = rows.select(self.key, MONTH, F.coalesce(altered, F.lit(False)).alias("altered"), F.coalesce(looked_at, F.lit(False)).alias("looked_at"))
        return marked.where("altered OR looked_at").drop("looked_at")


def stored_lags(path: str, lags: int = NUM_LAGS, **options: DataType) -> StoredWindows:
    return StoredWindows(path, SKU, lambda days: lag_table(days.drop(N_ROWS), lags=lags), lags, **options)


def stored_averages(path: str, window: int = WINDOW_SIZE, include_current: bool = True, **options: DataType) -> StoredWindows:
    def compute(days: DataFrame) -> DataFrame:
        return moving_average_table(days.drop(N_ROWS), window=window, include_current=include_current)

    return StoredWindows(path, CATEGORY, compute, window - 1 if include_current else window, **options)
