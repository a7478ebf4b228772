"""Registered queries over Structured Streaming: live daily tables, lags and means."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from shelfcast.checks.common import Query, rounded, sales, sql
from shelfcast.operators import refresh
from shelfcast.schema import CATEGORY, DATE, PRICE, QUANTITY, SKU, lag_names, sma_names
from shelfcast.session import new_path
from shelfcast.streaming.corrected import corrected_averages, corrected_lags, keep_last_versions, last_versions
from shelfcast.streaming.daily import append_to_table, current_rows, daily_schema, daily_stream, upsert_to_table
from shelfcast.streaming.history import lag_stream, mean_stream
from shelfcast.streaming.live import LiveDaily, keep_live

# Files may be read in any order, so a row can lie behind the newest date by the span of the whole history.
_LATEST = "4000 days"

_LAG_PRICES = tuple(lag_names(columns=(PRICE,)))


def sales_stream(spark: SparkSession, tables: str) -> DataFrame:
    """The line items as a stream of sales, with the category looked up in the static part table."""
    schema = spark.read.parquet(f"{tables}/lineitem.parquet").schema
    items = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(tables)
    part = spark.read.parquet(f"{tables}/part.parquet")
    return items.join(part, items["l_partkey"] == part["p_partkey"]).select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_partkey").alias(SKU),
        F.substring("p_brand", 7, 10).cast("long").alias(CATEGORY),
        F.col("l_extendedprice").alias(PRICE),
        F.col("l_quantity").alias(QUANTITY),
    )


def _run(stream: DataFrame, name: str) -> str:
    spark = stream.sparkSession
    path = new_path(spark, name)
    query = append_to_table(stream, path, new_path(spark, f"{name}-progress"))
    query.awaitTermination()
    return path


def _daily(spark: SparkSession, tables: str, key: str) -> DataFrame:
    path = new_path(spark, f"live-daily-{key}")
    upsert_to_table(daily_stream(sales_stream(spark, tables), key), path, new_path(spark, "live-progress")).awaitTermination()
    return current_rows(spark, path, key)


def _closed_days(spark: SparkSession, tables: str, key: str) -> DataFrame:
    """The live table, all days of it being closed now, as a stream of daily rows."""
    path = new_path(spark, f"closed-daily-{key}")
    _daily(spark, tables, key).write.parquet(path)
    return spark.readStream.schema(daily_schema(key)).parquet(path)


def _live(spark: SparkSession, tables: str, key: str, stored: refresh.StoredWindows) -> tuple[LiveDaily, refresh.StoredWindows]:
    """The sales in several files, out of order, as a stream that a live table and its windows follow."""
    # As many files as the session has shuffle partitions, four at least, and a batch half of them.
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = sales(spark, tables).repartition(files, SKU, DATE, PRICE)
    folder = new_path(spark, "sales-files")
    rows.write.parquet(folder)
    written = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, -(-written // 2))).parquet(folder)
    daily = LiveDaily(new_path(spark, f"live-{key}"), key)
    keep_live(stream, daily, new_path(spark, "live-progress"), [stored]).awaitTermination()
    return daily, stored


def live_lags(spark: SparkSession, tables: str) -> DataFrame:
    """Lags corrected with every batch, in the end those of all rows."""
    _, stored = _live(spark, tables, SKU, refresh.stored_lags(new_path(spark, "live-lags"), quantity=DoubleType()))
    return rounded(stored.rows(spark), *_LAG_PRICES)


def live_averages(spark: SparkSession, tables: str) -> DataFrame:
    _, stored = _live(spark, tables, CATEGORY, refresh.stored_averages(new_path(spark, "live-averages"), quantity=DoubleType()))
    return rounded(stored.rows(spark), *sma_names())


def live_daily(spark: SparkSession, tables: str) -> DataFrame:
    """The merged table of all batches."""
    daily, _ = _live(spark, tables, SKU, refresh.stored_lags(new_path(spark, "live-lags"), quantity=DoubleType()))
    return rounded(daily.rows(spark), PRICE)


def _late_files(spark: SparkSession, tables: str) -> DataFrame:
    """The sales as files by year, a third of each year's rows coming a year late, as a stream of some batches."""
    rows = sales(spark, tables)
    year = F.year(DATE) + F.when(F.pmod(F.xxhash64(SKU, DATE, PRICE), F.lit(3)) == 0, 1).otherwise(0)
    folder = new_path(spark, "late-sales")
    # A year is as many files as its rows need, and a batch a third of all files.
    part = F.pmod(F.xxhash64(SKU), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows.withColumn("arrived", year).repartition("arrived", part).write.partitionBy("arrived").parquet(folder)
    written = len(spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(folder).inputFiles())
    files = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max(1, -(-written // 3)))
    return files.parquet(folder)


def _corrected(spark: SparkSession, versions: DataFrame, key: str) -> DataFrame:
    path = new_path(spark, f"corrected-{key}")
    keep_last_versions(versions, key, path, new_path(spark, "corrected-progress")).awaitTermination()
    return last_versions(spark, versions.schema, path)


def stream_corrected_lags(spark: SparkSession, tables: str) -> DataFrame:
    """Lags from the state of a stream with late rows, the last version of each."""
    versions = corrected_lags(_late_files(spark, tables), delay=_LATEST)
    return rounded(_corrected(spark, versions, SKU), *_LAG_PRICES)


def stream_corrected_averages(spark: SparkSession, tables: str) -> DataFrame:
    versions = corrected_averages(_late_files(spark, tables), delay=_LATEST)
    return rounded(_corrected(spark, versions, CATEGORY), *sma_names())


def stream_daily_sku(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(_daily(spark, tables, SKU), PRICE)


def stream_daily_category(spark: SparkSession, tables: str) -> DataFrame:
    return rounded(_daily(spark, tables, CATEGORY), PRICE)


def stream_lags(spark: SparkSession, tables: str) -> DataFrame:
    lags = lag_stream(_closed_days(spark, tables, SKU))
    return rounded(spark.read.schema(lags.schema).parquet(_run(lags, "live-lags")), *_LAG_PRICES)


def stream_means(spark: SparkSession, tables: str) -> DataFrame:
    means = mean_stream(_closed_days(spark, tables, CATEGORY))
    return rounded(spark.read.schema(means.schema).parquet(_run(means, "live-means")), *sma_names())


QUERIES: dict[str, Query] = {
    "stream_daily_sku": stream_daily_sku,
    "stream_daily_category": stream_daily_category,
    "stream_lags": stream_lags,
    "stream_means": stream_means,
    "live_lags": live_lags,
    "live_averages": live_averages,
    "live_daily": live_daily,
    "stream_corrected_lags": stream_corrected_lags,
    "stream_corrected_averages": stream_corrected_averages,
}

_DAILY = f"""date, round(sales_price, 6) AS sales_price, CAST(sales_quantity AS DOUBLE) AS sales_quantity, n_rows"""

ORACLES: dict[str, str] = {
    "live_daily": sql(f"SELECT sku_id, {_DAILY} FROM daily_sku", "daily_sku"),
    "live_lags": sql(
        f"""SELECT sku_id, date, {', '.join(f'round(lag_{i}_sales_price, 6) AS lag_{i}_sales_price' for i in (1, 2, 3))},
        {', '.join(f'CAST(lag_{i}_sales_quantity AS DOUBLE) AS lag_{i}_sales_quantity' for i in (1, 2, 3))} FROM lags""",
        "lags",
    ),
    "live_averages": sql(
        f"SELECT category_id, date, {', '.join(f'round({c}, 6) AS {c}' for c in sma_names())} FROM averages", "averages"
    ),
    "stream_daily_sku": sql(f"SELECT sku_id, {_DAILY} FROM daily_sku", "daily_sku"),
    "stream_daily_category": sql(f"SELECT category_id, {_DAILY} FROM daily_category", "daily_category"),
    "stream_lags": sql(
        f"""SELECT sku_id, date, false AS late,
        {', '.join(f'round(lag_{i}_sales_price, 6) AS lag_{i}_sales_price' for i in (1, 2, 3))},
        {', '.join(f'CAST(lag_{i}_sales_quantity AS DOUBLE) AS lag_{i}_sales_quantity' for i in (1, 2, 3))}
        FROM lags""",
        "lags",
    ),
    "stream_means": sql(
        f"""SELECT * FROM (SELECT category_id, date, false AS late,
        round(avg(sales_price) OVER w, 6) AS sma_5_sales_price,
        round(avg(CAST(sales_quantity AS DOUBLE)) OVER w, 6) AS sma_5_sales_quantity FROM daily_category
        WINDOW w AS (PARTITION BY category_id ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
       """,
        "daily_category",
    ),
}

# The state gives what the corrected tables give.
ORACLES["stream_corrected_lags"] = ORACLES["live_lags"]
ORACLES["stream_corrected_averages"] = ORACLES["live_averages"]
