"""Lags and averages corrected by state: any order of rows, rows too late, days that are dropped, restarts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rows import SALES, day, rows_of
from shelfcast.operators.daily import daily
from shelfcast.operators.history import lag_table, moving_average_table
from shelfcast.streaming.corrected import PROVIDER, corrected_averages, corrected_lags, keep_last_versions, last_versions


def _write(spark, path, rows):
    spark.createDataFrame(rows, SALES).coalesce(1).write.mode("append").parquet(str(path))


def _run(stream, key, folder):
    query = keep_last_versions(stream, key, str(folder / "table"), str(folder / "progress"))
    query.awaitTermination()
    return query


def _stream(spark, source, files=1):
    return spark.readStream.schema(SALES).option("maxFilesPerTrigger", files).parquet(str(source))


def _draw(seed, n=160):
    rng = random.Random(seed)
    price = lambda: rng.choice([None, float(rng.randint(1, 9)), float(rng.randint(1, 9))])
    return [(day(rng.randint(1, 28), rng.randint(1, 3)), rng.randint(0, 2), rng.randint(0, 4), price(), rng.choice([None, 1, 2, 3])) for _ in range(n)]


@pytest.mark.parametrize(("key", "make", "table"), [("sku_id", corrected_lags, lag_table), ("category_id", corrected_averages, moving_average_table)])
def test_shuffled_batches_end_as_the_batch_table(spark, tmp_path, key, make, table):
    rows = _draw(5) + [(None, 1, 1, 1.0, 1), (day(1), None, None, 1.0, 1)]
    for i in range(4):
        _write(spark, tmp_path / "in", rows[i::4])
    before = spark.conf.get(PROVIDER)
    stream = make(_stream(spark, tmp_path / "in"), delay="365 days")
    query = _run(stream, key, tmp_path)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4 and spark.conf.get(PROVIDER) == before
    days = daily(spark.createDataFrame(rows, SALES).where(f"{key} IS NOT NULL AND date IS NOT NULL"), key)
    days = days.withColumn("sales_quantity", F.col("sales_quantity").cast("double")).drop("n_rows")
    got = last_versions(spark, stream.schema, str(tmp_path / "table"))
    expected = table(days)
    assert rows_of(got.select(*expected.columns).selectExpr(*_rounded(expected))) == rows_of(expected.selectExpr(*_rounded(expected)))


def _rounded(df):
    return [f"round({c}, 9) AS {c}" if t == "double" else c for c, t in df.dtypes]


def test_days_behind_the_watermark_are_dropped_but_looked_back_at(spark, tmp_path):
    """A year of one sale a day with a delay of ten days: the state keeps some ten days, lags stay whole."""
    start = dt.date(2020, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(200)]
    for at in range(0, 200, 50):
        _write(spark, tmp_path / "in", [(d, 1, 1, float(i), 1) for i, d in enumerate(days)][at : at + 50])
    # A key that is never seen again, and after the last batch a row that is too late and one that is not.
    _write(spark, tmp_path / "in", [(days[199], 1, 2, 5.0, 1), (days[20], 1, 1, 999.0, 1), (days[195], 1, 1, 1000.0, 1)])
    stream = corrected_lags(_stream(spark, tmp_path / "in"), delay="10 days")
    query = _run(stream, "sku_id", tmp_path)
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    assert sum(o["numRowsDroppedByWatermark"] for o in operators) == 1
    got = {r.date: r for r in last_versions(spark, stream.schema, str(tmp_path / "table")).where("sku_id = 1").collect()}
    assert sorted(got) == days
    mean = (195.0 + 1000.0) / 2
    price = lambda i: mean if i == 195 else float(i)
    for i in range(3, 200):
        assert [got[days[i]][f"lag_{k}_sales_price"] for k in (1, 2, 3)] == [price(i - k) for k in (1, 2, 3)]
    state = spark.read.format("statestore").option("stateVarName", "days").option("path", str(tmp_path / "progress")).load()
    assert state.count() <= 50 + 10 + 3 + 2


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = _draw(9, 90)
    _write(spark, tmp_path / "in", rows[:60])
    _run(corrected_lags(_stream(spark, tmp_path / "in")), "sku_id", tmp_path)
    _write(spark, tmp_path / "in", rows[60:])
    stream = corrected_lags(_stream(spark, tmp_path / "in"))
    _run(stream, "sku_id", tmp_path)
    days = daily(spark.createDataFrame(rows, SALES), "sku_id")
    days = days.withColumn("sales_quantity", F.col("sales_quantity").cast("double")).drop("n_rows")
    expected = lag_table(days)
    got = last_versions(spark, stream.schema, str(tmp_path / "table"))
    assert rows_of(got.selectExpr(*_rounded(expected))) == rows_of(expected.selectExpr(*_rounded(expected)))


def test_keys_of_a_group_share_calls_and_state(spark, tmp_path):
    """Many keys over two batches: no more state entries than groups, and the rows of the batch table."""
    rows = [(day(1 + (sku * 7 + i) % 28, 1 + i % 2), 1, sku, None if (sku + i) % 5 == 0 else float(i), i) for sku in range(300) for i in range(6)]
    for i in range(2):
        _write(spark, tmp_path / "in", rows[i::2])
    stream = corrected_lags(_stream(spark, tmp_path / "in"), delay="365 days", groups=8)
    _run(stream, "sku_id", tmp_path)
    state = spark.read.format("statestore").option("stateVarName", "days").option("path", str(tmp_path / "progress")).load()
    assert state.count() == 8
    days = daily(spark.createDataFrame(rows, SALES), "sku_id")
    days = days.withColumn("sales_quantity", F.col("sales_quantity").cast("double")).drop("n_rows")
    expected = lag_table(days)
    got = last_versions(spark, stream.schema, str(tmp_path / "table"))
    assert rows_of(got.selectExpr(*_rounded(expected))) == rows_of(expected.selectExpr(*_rounded(expected)))


def test_a_timer_drops_closed_days_of_every_key_of_a_group(spark, tmp_path):
    start = dt.date(2020, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(120)]
    for at in range(0, 120, 40):
        _write(spark, tmp_path / "in", [(d, 1, sku, 1.0, 1) for d in days[at : at + 40] for sku in (1, 2)])
    _write(spark, tmp_path / "in", [(days[119], 1, 3, 1.0, 1)])
    _run(corrected_lags(_stream(spark, tmp_path / "in"), delay="10 days", groups=1), "sku_id", tmp_path)
    state = spark.read.format("statestore").option("stateVarName", "days").option("path", str(tmp_path / "progress")).load()
    (group,) = state.select("value.keys").collect()
    assert len(group[0]) // 8 <= 2 * (10 + 3 + 2) + 1
