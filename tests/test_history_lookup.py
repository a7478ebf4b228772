"""As-of lookup, serving features and their agreement with brute force."""

from __future__ import annotations

import random

import pytest

from rows import SALES, day, rows_of
from shelfcast.operators.asof import lags_asof, last_k_days, means_asof, sample_days
from shelfcast.operators.daily import daily_category, daily_sku
from shelfcast.plans.forecast import latest_days, serving_features
from shelfcast.schema import lag_names, sma_names


def table(spark, rows):
    return spark.createDataFrame(rows, SALES)


def test_days_at_or_before_the_sample(spark):
    history = daily_sku(table(spark, [(day(i), 7, 1, float(i), i) for i in (1, 3, 5)]))
    samples = table(spark, [(d, 7, 1, 0.0, 0) for d in (day(3), day(9))] + [(day(1, 1, 2019), 7, 1, 0.0, 0)])
    got = {r["date"]: r for r in lags_asof(sample_days(samples, "sku_id"), history).collect()}
    prices = lag_names(columns=("sales_price",))
    assert [got[day(1, 1, 2019)][c] for c in prices] == [None, None, None]
    assert [got[day(3)][c] for c in prices] == [3.0, 1.0, None]
    assert [got[day(9)][c] for c in prices] == [5.0, 3.0, 1.0]
    strict = lags_asof(sample_days(samples, "sku_id"), history, inclusive=False).collect()
    assert [r["lag_1_sales_price"] for r in strict if r["date"] == day(3)] == [1.0]


@pytest.mark.parametrize("inclusive", [True, False])
def test_serving_features_against_brute_force(spark, inclusive):
    rng = random.Random(11)

    def draw(n):
        return [
            (day(rng.randint(1, 28), rng.randint(1, 2)), rng.randint(1, 3), rng.choice([1, 1, 1, 2, 3, None]), rng.random(), rng.randint(0, 9))
            for _ in range(n)
        ]

    history, samples = draw(200), draw(80)
    out = serving_features(
        table(spark, samples), daily_sku(table(spark, history)), daily_category(table(spark, history)), inclusive=inclusive
    ).collect()
    assert len(out) == len(samples)

    def days_before(row, position, key):
        found = {}
        for h in history:
            if key is not None and h[position] == key and (h[0] < row["date"] or (inclusive and h[0] == row["date"])):
                found.setdefault(h[0], []).append(h)
        return [found[d] for d in sorted(found, reverse=True)]

    for r in out:
        skus = days_before(r, 2, r["sku_id"])
        for i in (1, 2, 3):
            rows = skus[i - 1] if len(skus) >= i else None
            assert r[f"lag_{i}_sales_price"] == (pytest.approx(sum(h[3] for h in rows) / len(rows)) if rows else None)
            assert r[f"lag_{i}_sales_quantity"] == (sum(h[4] for h in rows) if rows else None)
        groups = days_before(r, 1, r["category_id"])[:5]
        quantities = [sum(h[4] for h in rows) for rows in groups]
        assert r["sma_5_sales_quantity"] == (pytest.approx(sum(quantities) / len(quantities)) if groups else None)


def test_same_result_for_any_partitioning(spark):
    rng = random.Random(2)
    rows = table(spark, [(day(rng.randint(1, 28)), 1, rng.randint(1, 4), float(rng.randint(0, 9)), 1) for _ in range(100)])
    days = sample_days(rows, "sku_id")
    one = rows_of(last_k_days(days, daily_sku(rows), "sku_id", 3))
    assert one == rows_of(last_k_days(days.repartition(7), daily_sku(rows.repartition(5)), "sku_id", 3))


def test_means_use_what_there_is(spark):
    history = daily_category(table(spark, [(day(1), 7, 1, 2.0, 4), (day(2), 7, 1, None, 6), (day(2), 8, 1, None, 1)]))
    samples = table(spark, [(day(5), 7, 1, 0.0, 0), (day(5), 8, 1, 0.0, 0), (day(5), 9, 1, 0.0, 0)])
    got = {r["category_id"]: [r[c] for c in sma_names()] for r in means_asof(sample_days(samples, "category_id"), history).collect()}
    assert got == {7: [2.0, 5.0], 8: [None, 1.0], 9: [None, None]}


def test_latest_days(spark):
    history = daily_sku(table(spark, [(day(i), 7, s, float(i), i) for i in range(1, 11) for s in (1, 2)]))
    got = latest_days(history, "sku_id", 3, day(8)).collect()
    assert sorted((r["sku_id"], [d["date"] for d in r["days"]]) for r in got) == [(s, [day(7), day(6), day(5)]) for s in (1, 2)]
