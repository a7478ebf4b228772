"""The feature table stored without what it was made of, and halves told before its joins."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rows import SALES, rows_of
from shelfcast.operators.rows import split_train_test, with_test_flag
from shelfcast.plans.features import build_features, stored_features
from shelfcast.session import folders, shared_dir
from shelfcast.sources.holidays import holiday_calendar


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        (dt.date(2020, 1, 1) + dt.timedelta(days=d), 1 + (s + d) % 2, s, 10.0 * s + d % 5, None if d == 9 else 3 * s + d % 4)
        for d in range(30)
        for s in range(1, 7)
        for _ in range(1 + (d + s) % 3)
        if (d + s) % 7
    ]
    return spark.createDataFrame(rows, SALES).withColumn("row_id", F.concat_ws("|", "sku_id", "date", F.monotonically_increasing_id())).persist()


def test_only_the_result_is_left(spark, sales):
    holidays = holiday_calendar(spark, 2020, 2020)
    before = set(folders(spark, shared_dir(spark)))
    table = stored_features(sales, holidays, drop_nulls=False)
    assert [p.split("-")[0] for p in set(folders(spark, shared_dir(spark))) - before] == ["features"]
    given = build_features(sales, holidays, clusters=None, drop_nulls=False, daily_sku=sales.groupBy("sku_id", "date").agg(
        F.avg("sales_price").alias("sales_price"), F.coalesce(F.sum("sales_quantity"), F.lit(0)).alias("sales_quantity"), F.count(F.lit(1)).alias("n_rows"))).table
    assert table.columns == given.columns
    # Sums and counts give the prices by another order of additions.
    digits = lambda df: rows_of(df.withColumns({c: F.round(c, 9) for c, kind in df.dtypes if kind == "double"}))
    assert table.count() == sales.count() and digits(table) == digits(given)


def test_halves_told_before_are_those_of_the_row_key(sales):
    want = split_train_test(sales)
    got = split_train_test(with_test_flag(sales), flag="is_test")
    assert [rows_of(h) for h in got] == [rows_of(h) for h in want]
    assert all(h.count() for h in got)
