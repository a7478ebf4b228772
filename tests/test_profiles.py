"""Profiles, quantiles, histograms, correlation, metrics, samples and splits."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rows import day, rows_of
from shelfcast.operators.correlation import correlation_matrix, wide_correlation_matrix
from shelfcast.operators.evaluation import regression_metrics
from shelfcast.operators.histogram import column_histograms, grouped_histogram
from shelfcast.operators.profile import (
    distinct_counts,
    least_frequent,
    most_frequent,
    null_counts,
    summary,
    value_counts,
)
from shelfcast.operators.quantiles import exact_quantiles
from shelfcast.operators.rows import sample_keys, shuffled, split_train_test, with_fold
from shelfcast.functions.values import natural_log


@pytest.mark.parametrize("error", [1e-3, 0.05])
def test_exact_quantiles_against_sorted_values(spark, error):
    rng = random.Random(5)
    columns = {
        "wide": [rng.gauss(0, 1e6) for _ in range(3000)],
        "copies": [float(rng.choice([1, 1, 1, 1, 2, 9])) for _ in range(3000)],
        "constant": [7.0] * 3000,
        "holes": [None if i % 3 else float(i) for i in range(3000)],
        "empty": [None] * 3000,
        "outlier": [1e300 if i == 0 else rng.random() for i in range(3000)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    ps = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, list(columns), ps, error=error)
    for c, values in columns.items():
        known = sorted(v for v in values if v is not None)
        for p in ps:
            want = known[max(1, math.ceil(p * len(known))) - 1] if known else None
            assert got[c, p] == want, (c, p)


def test_exact_quantiles_count_nan_as_largest(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.nan,), (math.nan,)], "x double")
    got = exact_quantiles(df, ["x"], [0.5, 1.0])
    assert got["x", 0.5] == 2.0 and math.isnan(got["x", 1.0])


def test_summary_and_counts(spark):
    df = spark.createDataFrame([(day(1), 1, 2.0), (day(3), None, 4.0), (day(3), 1, None)], "d date, a int, b double")
    by = {r["column"]: r for r in summary(df).collect()}
    assert (by["a"]["count"], by["a"]["null_count"]) == (2, 1)
    assert by["b"]["mean"] == 3.0 and by["b"]["p50"] == 2.0
    assert by["d"]["max"] - by["d"]["min"] == 2
    assert {r["column"]: r["p50"] for r in summary(df, approximate=True).collect()}["b"] == 2.0
    assert null_counts(df).first().asDict() == {"d_null_count": 0, "a_null_count": 1, "b_null_count": 1}
    assert rows_of(distinct_counts(df)) == [("a", 2), ("b", 3), ("d", 2)]
    assert rows_of(distinct_counts(df, approximate=True)) == [("a", 2), ("b", 3), ("d", 2)]


def test_value_counts_and_ends(spark):
    df = spark.createDataFrame([(k,) for k in [1, 1, 1, 2, 2, 3, None]], "k int")
    counts = value_counts(df, "k")
    assert {r["k"]: (r["count"], round(r["proportion"], 6)) for r in counts.collect()}[1] == (3, 0.428571)
    assert [r["k"] for r in most_frequent(counts, "k", 2).collect()] == [1, 2]
    assert [r["k"] for r in least_frequent(counts, "k", 2).collect()] == [3, None]


def test_histograms_against_numpy(spark):
    rng = random.Random(3)
    n = 513
    data = {"x": [rng.randint(-50, 900) for _ in range(n)], "flag": [rng.random() < 0.3 for _ in range(n)], "same": [4] * n}
    df = spark.createDataFrame(list(zip(*data.values())), "x int, flag boolean, same int")
    got = {}
    for r in column_histograms(df).collect():
        got.setdefault(r["column"], {})[r["bin"]] = r["n"]
    counts, _ = np.histogram(data["x"], bins=int(np.log2(n) + 1))
    assert got["x"] == {i: c for i, c in enumerate(counts) if c}
    assert got["flag"] == {0: n - sum(data["flag"]), 1: sum(data["flag"])}
    assert got["same"] == {0: n}


def test_two_values_and_a_null_are_three(spark):
    df = spark.createDataFrame([(0,), (10,), (10,), (None,)], "x int")
    assert rows_of(column_histograms(df), "bin", "n") == [(0, 1), (2, 2)]
    empty = spark.createDataFrame([(None,), (None,)], "x int")
    assert column_histograms(empty).count() == 0


def test_grouped_histogram(spark):
    values = {1: [0, 1, 2, 3, 4, 5, 6, 7, 8, 10], 2: [5, 5]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, v int")
    got = rows_of(grouped_histogram(df, "k", "v", bins=5))
    counts, _ = np.histogram(values[1], bins=5)
    assert got == [(1, i, int(c)) for i, c in enumerate(counts)] + [(2, 0, 2)]


def test_correlation(spark):
    rng = random.Random(1)
    n = 400
    a = [1e9 + rng.random() for _ in range(n)]
    b = [x * 2 + rng.random() for x in a]
    df = spark.createDataFrame([(x, y, 7.0, None if i == 0 else 1.0 * i) for i, (x, y) in enumerate(zip(a, b))], "a double, b double, k double, h double")
    got = {(r["a"], r["b"]): r["corr"] for r in correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-6)
    assert got["a", "a"] == pytest.approx(1.0)
    assert got["a", "k"] is None and got["k", "k"] is None and got["h", "b"] is None
    wide = {(r["a"], r["b"]): r["corr"] for r in wide_correlation_matrix(df, ["a", "b", "k"]).collect()}
    assert wide["a", "b"] == pytest.approx(got["a", "b"], abs=1e-6) and wide["a", "k"] is None
    assert {(r["a"], r["b"]) for r in correlation_matrix(df, exclude=["k", "h"]).collect()} == {(x, y) for x in "ab" for y in "ab"}


def test_metrics(spark):
    def score(pairs):
        return regression_metrics(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first()

    assert score([(1.0, 1.0), (2.0, 2.0)])[2] == 1.0
    assert score([(1.0, 1.0), (1.0, 1.0)])[2] == 1.0
    assert score([(1.0, 1.0), (1.0, 2.0)])[2] == 0.0
    rmse, mae, explained, *_ = score([(1.0, 2.0), (2.0, 3.0), (4.0, 5.0)])
    assert (rmse, mae, explained) == pytest.approx((-1.0, -1.0, 1.0))
    partial = score([(1.0, 2.0), (2.0, 3.0), (4.0, 5.0), (900.0, None), (None, 1.0)])
    assert (partial["n_rows"], partial["n_skipped"]) == (3, 2) and partial["test_explained_variance"] == pytest.approx(1.0)


def test_split_sample_shuffle(spark):
    df = spark.range(20000).withColumn("row_id", F.col("id").cast("string"))
    train, test = split_train_test(df)
    assert train.count() + test.count() == 20000 and train.intersect(test).count() == 0
    assert 0.11 < test.count() / 20000 < 0.13
    assert rows_of(split_train_test(df.repartition(3))[1]) == rows_of(test)
    assert sum(part.count() for part in split_train_test(df, seed=1)) == 20000
    keys = rows_of(sample_keys(df, "id", 20))
    assert len(set(keys)) == 20 and keys == rows_of(sample_keys(df.repartition(5), "id", 20))
    order = [r["id"] for r in shuffled(df).collect()]
    assert order != sorted(order) and len(set(order)) == 20000
    folds = with_fold(df).groupBy("fold").count().collect()
    assert len(folds) == 3 and all(abs(r["count"] / 20000 - 1 / 3) < 0.02 for r in folds)


def test_natural_log(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "x double")
    logs = {r["x"]: r["v"] for r in df.withColumn("v", natural_log("x")).collect()}
    assert logs[1.0] == 0.0 and logs[0.0] == -math.inf and math.isnan(logs[-1.0]) and logs[None] is None
