"""Merged day states against the exact answers over any range of dates."""

from __future__ import annotations

import os
import random

import pytest

from rows import SALES, day
from shelfcast.operators import sketches

COLUMNS = ["sku_id", "sales_price", "sales_quantity"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for _ in range(6000):
        quantity = None if rng.random() < 0.1 else min(int(rng.expovariate(0.3)), 40)
        out.append((day(rng.randint(1, 28), rng.randint(1, 3)), 1, rng.randint(0, 700), rng.random() * 100, quantity))
    return out


@pytest.mark.parametrize("span", [None, (day(5, 1), day(20, 2)), (day(3, 3), day(3, 3))])
def test_merged_states_are_near_the_exact_answers(spark, rows, tmp_path, span):
    path = str(tmp_path / "states")
    for month in (1, 2, 3):
        sketches.store_days(spark.createDataFrame([r for r in rows if r[0].month == month], SALES).repartition(3), path, COLUMNS)
    got = {r.column: r for r in sketches.profile_between(spark, path, *(span or ())).collect()}
    chosen = [r for r in rows if span is None or span[0] <= r[0] <= span[1]]
    for i, column in ((2, "sku_id"), (3, "sales_price"), (4, "sales_quantity")):
        values = sorted(r[i] for r in chosen if r[i] is not None)
        r = got[column]
        assert (r.n_rows, r.n_null) == (len(chosen), len(chosen) - len(values))
        assert abs(r.n_distinct - len(set(values))) <= 0.06 * len(set(values)) + 1
        for p, q in zip((0.25, 0.5, 0.75), r.quantiles):
            assert sum(v < q for v in values) / len(values) - 0.04 <= p <= sum(v <= q for v in values) / len(values) + 0.04
    counts = {}
    for r in chosen:
        counts[str(r[4]) if r[4] is not None else None] = counts.get(str(r[4]) if r[4] is not None else None, 0) + 1
    top = {x["item"]: x["count"] for x in got["sales_quantity"].frequent}
    assert top and all(counts[v] == n for v, n in top.items() if v is not None)


def test_a_further_day_writes_its_month_only_and_replaces_itself(spark, rows, tmp_path):
    path = str(tmp_path / "states")
    first = [r for r in rows if r[0].month < 3]
    sketches.store_days(spark.createDataFrame(first, SALES), path, COLUMNS)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    before = files()
    later = spark.createDataFrame([r for r in rows if r[0] == day(4, 3)], SALES)
    for _ in range(2):
        sketches.store_days(later, path, COLUMNS)
    assert all("m202003" in f for f, t in files().items() if before.get(f) != t)
    got = {r.column: r.n_rows for r in sketches.profile_between(spark, path).collect()}
    assert got["sku_id"] == len(first) + later.count()


def test_null_columns_and_no_rows(spark, tmp_path):
    path = str(tmp_path / "states")
    sketches.store_days(spark.createDataFrame([], SALES), path, COLUMNS)
    sketches.store_days(spark.createDataFrame([(day(1), 1, None, float("nan"), None), (None, 1, 1, 1.0, 1)], SALES), path, COLUMNS)
    got = {r.column: (r.n_rows, r.n_null, r.n_distinct, r.quantiles) for r in sketches.profile_between(spark, path).collect()}
    assert got["sku_id"] == (1, 1, 0, None) and got["sales_quantity"] == (1, 1, 0, None)
