"""Sales history, future rows and forecast files; adapter from the line-item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.functions.dates import parse_date
from shelfcast.operators.joins import attach, hot_keys
from shelfcast.schema import CATEGORY, DATE, N_ROWS, PRICE, QUANTITY, ROW_ID, SALES_COLUMNS, SKU
from shelfcast.session import new_path


_ITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity")


def read_sales_csv(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """Sales history CSV: five columns by name, any others (such as an index) ignored.

    A file without ``sales_quantity`` gets a null target. ``strict`` raises on bad values, otherwise
    they become null.
    """
    raw = spark.read.option("header", True).csv(path)

    def cast(name: str, type_name: str):
        return F.col(name).cast(type_name) if strict else F.col(name).try_cast(type_name)

    target = cast(QUANTITY, "double") if QUANTITY in raw.columns else F.lit(None).cast("double")
    return raw.select(
        parse_date(DATE, strict).alias(DATE),
        cast(CATEGORY, "long").alias(CATEGORY),
        cast(SKU, "long").alias(SKU),
        cast(PRICE, "double").alias(PRICE),
        target.alias(QUANTITY),
    )


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_forecast(forecast: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Forecast rows as CSV part files: date, category, sku, price, quantity."""
    write_csv(forecast.select(*SALES_COLUMNS), path, mode=mode)


_hot_parts: dict[tuple, DataFrame] = {}


def _parts_with_many_items(items: DataFrame) -> DataFrame:
    """The parts that the join splits, counted once a session for the files that are read."""
    spark = items.sparkSession
    known = (spark.sparkContext.applicationId, id(spark), *sorted(items.inputFiles()))
    if known not in _hot_parts:
        weights = items.groupBy("l_partkey").agg(F.count(F.lit(1)).alias(N_ROWS))
        _hot_parts[known] = hot_keys(weights, ["l_partkey"], path=new_path(spark, "hot-parts", lasting=True))
    return _hot_parts[known]


def sales_from_lineitem(spark: SparkSession, tables: str, *, category: bool = True, row_id: bool = False) -> DataFrame:
    """Sales rows from ``lineitem`` and ``part``.

    ``category=False`` leaves out ``category_id`` and with it the join, for work that needs only the
    SKU. ``row_id`` adds a unique row key. A part with very many items is split in the join; items are counted
    once a session.
    """
    items = spark.read.parquet(f"{tables}/lineitem.parquet").select(*_ITEM_COLUMNS)
    date = F.col("l_shipdate").cast("date")
    quantity = F.col("l_quantity").cast("long")
    columns = {DATE: date, SKU: F.col("l_partkey"), PRICE: F.col("l_extendedprice"), QUANTITY: quantity}
    if category:
        part = spark.read.parquet(f"{tables}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        items = attach(items, part, ["l_partkey"], hot=_parts_with_many_items(items))
        columns = {DATE: date, CATEGORY: F.substring("p_brand", 7, 10).cast("long"), **columns}
    if row_id:
        parts = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
        columns[ROW_ID] = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in parts], date, quantity))
    return items.select(*[c.alias(name) for name, c in columns.items()])
