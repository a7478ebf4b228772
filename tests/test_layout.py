"""Facts laid out by their keys: the plan, hot keys, null keys, and agreement with the join that moves them."""

from __future__ import annotations

import random
import uuid
from collections import Counter

import pytest

from rows import SALES, day, rows_of
from shelfcast.operators.asof import lags_asof, sample_days
from shelfcast.operators.daily import daily
from shelfcast.operators.layout import lay_out
from shelfcast.plans.features import laid_out_lags, lay_out_sales, with_lags


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _sales(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = [(day(1), 1, 7, 2.5, 1)] * 150  # one day of one SKU, exact copies
    rows += [(day(rng.randint(1, 28)), 1, rng.choice([7, 7, 8, 9]), float(rng.randint(1, 64)), rng.randint(0, 5)) for _ in range(n)]
    return spark.createDataFrame(rows, SALES)


def _name() -> str:
    return f"t{uuid.uuid4().hex}"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_laid_out_sales_are_not_exchanged(spark, tmp_path, no_broadcast):
    sales = _sales(spark)
    laid = lay_out_sales(sales, _name(), buckets=4, path=str(tmp_path / "sales"), hot_rows=40)
    out = laid_out_lags(spark, laid)
    plan = _plan(out)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in _plan(with_lags(sales))
    expected = with_lags(sales)
    assert rows_of(out, *expected.columns) == rows_of(expected)


def test_a_hot_key_lies_in_several_buckets(spark, tmp_path):
    laid = lay_out(_sales(spark, 0).repartition(5), ["sku_id", "date"], _name(), buckets=8, hot_rows=20, path=str(tmp_path / "sales"))
    files = Counter(r[0] for r in spark.table(laid.name).selectExpr("input_file_name()").collect())
    assert sum(files.values()) == 150 and len(files) >= 3 and max(files.values()) < 120


def test_null_keys_match_nothing(spark, tmp_path, no_broadcast):
    rows = [(None, 1, 7, 1.0, 1), (day(1), 1, None, 1.0, 1), (day(1), 1, 7, 1.0, 1)]
    sales = spark.createDataFrame(rows, SALES)
    laid = lay_out(sales, ["sku_id", "date"], _name(), buckets=2, path=str(tmp_path / "sales"))
    table = spark.createDataFrame([(7, day(1), "x"), (None, day(1), "y")], "sku_id long, date date, v string")
    assert [r.v for r in laid.attach(table).collect()] == ["x"]
    assert Counter(r.v for r in laid.attach(table, "left").collect()) == {"x": 1, None: 2}
    with pytest.raises(ValueError):
        laid.attach(table, "full")
    empty = lay_out(sales.limit(0), ["sku_id", "date"], _name(), buckets=2, path=str(tmp_path / "empty"))
    assert empty.attach(table).collect() == []


def test_serving_lookup_joins_laid_out_samples(spark, tmp_path, no_broadcast):
    history, samples = daily(_sales(spark), "sku_id"), _sales(spark, 80, seed=4)
    laid = lay_out(samples, ["sku_id", "date"], _name(), buckets=4, path=str(tmp_path / "samples"), hot_rows=40)
    recent = lags_asof(sample_days(laid.rows(spark), "sku_id"), history)
    out = laid.attach(recent, "left")
    assert "Exchange" not in _plan(out)
    expected = samples.join(lags_asof(sample_days(samples, "sku_id"), history).drop("n_rows"), ["sku_id", "date"], "left")
    assert rows_of(out, *expected.columns) == rows_of(expected)
