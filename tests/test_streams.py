"""Live daily tables and live features against their batch twins, over several batches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rows import rows_of
from shelfcast.operators.daily import daily_sku
from shelfcast.operators.history import lag_table
from shelfcast.schema import SKU, lag_names
from shelfcast.streaming.daily import append_to_table, current_rows, daily_schema, daily_stream, late_rows, upsert_to_table
from shelfcast.streaming.history import lag_stream, mean_stream

SCHEMA = "ts timestamp, sku_id long, sales_price double, sales_quantity double"


def run(stream, path, name):
    query = append_to_table(stream, str(path / name), str(path / f"{name}-progress"))
    query.awaitTermination()
    return str(path / name)


def source(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_daily_and_lags_over_several_batches(spark, tmp_path):
    rng = random.Random(4)
    inbox = str(tmp_path / "inbox")
    start = dt.datetime(2020, 1, 1)
    every = []
    for part in range(3):
        rows = [
            (start + dt.timedelta(days=part * 10 + rng.randint(0, 9), hours=rng.randint(0, 23)), rng.choice([1, 1, 1, 2, 3]), rng.random(), float(rng.randint(0, 5)))
            for _ in range(60)
        ]
        every += rows
        write(spark, inbox, rows)
        # Each restart goes on from the stored progress.
        table = run(daily_stream(source(spark, inbox), SKU), tmp_path, "daily")
        days = spark.readStream.schema(daily_schema(SKU)).parquet(table)
        lags = lag_stream(days)
        out = run(lags, tmp_path, "lags")
    batch = daily_sku(spark.createDataFrame(every, SCHEMA).withColumn("date", F.to_date("ts")))
    closed = F.col("date") < F.lit(max(r[0] for r in every).date() - dt.timedelta(days=1))
    emitted = spark.read.schema(daily_schema(SKU)).parquet(table)
    live = {(r["sku_id"], r["date"]): r for r in emitted.collect()}
    want = {(r["sku_id"], r["date"]): r for r in batch.where(closed).collect()}
    assert live.keys() == want.keys() and len(live) == emitted.count()
    for key, row in want.items():
        assert live[key]["sales_price"] == pytest.approx(row["sales_price"])
        assert live[key]["sales_quantity"] == row["sales_quantity"] and live[key]["n_rows"] == row["n_rows"]
    again = lag_table(emitted)
    got = spark.read.schema(lags.schema).parquet(out)
    assert got.where("late").count() == 0
    columns = [SKU, "date", *lag_names()]
    assert rows_of(got, *columns) == rows_of(again, *columns)


def test_late_daily_rows_are_marked_and_change_nothing(spark, tmp_path):
    inbox, schema = str(tmp_path / "days"), daily_schema(SKU)

    def day(n, price):
        return (1, dt.date(2020, 1, n), price, 1.0, 1)

    for rows in ([day(1, 1.0), day(5, 5.0)], [day(3, 3.0)], [day(7, None), day(6, 6.0)], [day(8, 8.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        out = run(lag_stream(spark.readStream.schema(schema).parquet(inbox)), tmp_path, "lags")
    got = {r["date"].day: r for r in spark.read.parquet(out).collect()}
    assert [d for d, r in got.items() if r["late"]] == [3]
    assert [got[8][f"lag_{i}_sales_price"] for i in (1, 2, 3)] == [None, 6.0, 5.0]
    assert got[8]["lag_1_sales_quantity"] == 1.0


def test_live_means_skip_missing_values(spark, tmp_path):
    schema = daily_schema("category_id")
    rows = [(7, dt.date(2020, 1, i), None if i == 2 else float(i), float(i), 1) for i in range(1, 9)]
    inbox = str(tmp_path / "days")
    spark.createDataFrame(rows, schema).write.parquet(inbox)
    out = run(mean_stream(spark.readStream.schema(schema).parquet(inbox)), tmp_path, "means")
    got = {r["date"].day: (r["sma_5_sales_price"], r["sma_5_sales_quantity"]) for r in spark.read.parquet(out).collect()}
    assert got[1] == (None, None) and got[3] == (1.0, 1.5)
    assert got[7] == (pytest.approx((3 + 4 + 5 + 6) / 4), 4.0) and got[8] == (5.0, 5.0)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_days_follow_the_session_time_zone(spark, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        clock = [(h, f"2020-03-0{d} {h:02}:30:00") for d in (1, 2, 3, 4, 5) for h in (0, 9, 23)]
        named = "ts string, sku_id long, sales_price double, sales_quantity double"
        rows = spark.createDataFrame([(t, 1, 1.0, float(h)) for h, t in clock], named)
        inbox = str(tmp_path / "inbox")
        rows.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(inbox)
        table = run(daily_stream(spark.readStream.schema(SCHEMA).parquet(inbox), SKU), tmp_path, "daily")
        got = rows_of(spark.read.parquet(table), "date", "sales_quantity", "n_rows")
        assert got == [(dt.date(2020, 3, d), 32.0, 3) for d in (1, 2, 3)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_open_days_are_there_and_late_rows_are_counted(spark, tmp_path):
    inbox, table, progress = (str(tmp_path / n) for n in ("inbox", "table", "progress"))
    first, last = dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 9, 12)
    every = [[(first, 1, 2.0, 3.0), (last, 1, 4.0, 1.0)], [(last, 1, 6.0, 1.0), (last, 2, 1.0, 1.0)], [(first, 1, 9.0, 9.0)]]
    dropped = 0
    for rows in every:
        write(spark, inbox, rows)
        query = upsert_to_table(daily_stream(source(spark, inbox), SKU), table, progress)
        query.awaitTermination()
        dropped += late_rows(query)
    got = rows_of(current_rows(spark, table, SKU), SKU, "date", "sales_price", "sales_quantity", "n_rows")
    on_time = [(1, first.date(), 2.0, 3.0, 1), (1, last.date(), 5.0, 2.0, 2), (2, last.date(), 1.0, 1.0, 1)]
    assert [(k, d, p, float(q), n) for k, d, p, q, n in got] == on_time
    assert dropped == 1


def test_keys_of_a_group_share_a_call(spark, tmp_path):
    """Hundreds of keys in a few groups over two batches, with days that come twice and too late."""
    rng, schema, inbox = random.Random(6), daily_schema(SKU), str(tmp_path / "days")
    start, expected = dt.date(2020, 1, 1), {}
    for first in (0, 10):
        rows = [(sku, start + dt.timedelta(days=first + i), rng.choice([None, 1.0, 2.0]), float(i), 1) for sku in range(200) for i in rng.sample(range(10), 4)]
        spark.createDataFrame(rows + [(sku, start, 9.0, 9.0, 1) for sku in range(0, 200 if first else 0, 50)], schema).coalesce(1).write.mode("append").parquet(inbox)
        out = run(lag_stream(spark.readStream.schema(schema).parquet(inbox), groups=4), tmp_path, "lags")
        expected |= {(r[0], r[1]): r for r in rows}
    state = spark.read.format("statestore").option("path", str(tmp_path / "lags-progress")).load()
    assert state.count() == 4
    got = spark.read.parquet(out)
    assert rows_of(got.where("late"), SKU, "date") == [(sku, start) for sku in range(0, 200, 50)]
    columns = [SKU, "date", *lag_names()]
    again = lag_table(spark.createDataFrame(list(expected.values()), schema))
    assert rows_of(got.where("NOT late"), *columns) == rows_of(again, *columns)
