"""Cross-validation on folds that are stored once, against one fit after the other."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.evaluation import regression_metrics
from shelfcast.operators.rows import with_fold
from shelfcast.plans import models

METRICS = ("test_neg_root_mean_squared_error", "test_neg_mean_absolute_error", "test_explained_variance")


def rows(spark, missing: bool):
    rng = random.Random(5)
    values = [(i, rng.randint(0, 9), None if missing and i % 7 == 0 else rng.random(), i % 2 == 0) for i in range(300)]
    labelled = [(i, a, b, c, None if i % 50 == 3 else a * 2.0 + (b or 0) + c) for i, a, b, c in values]
    return spark.createDataFrame(labelled, "row_id long, a int, b double, c boolean, sales_quantity double").persist()


def one_by_one(df, folds: int):
    data, found = with_fold(df, folds), []
    for i in range(folds):
        model = models.train(data.where(F.col("fold") != i), models.random_forest(numTrees=2, maxDepth=3, bootstrap=False), ["a", "b", "c"])
        found.append(models.predict(model, data.where(F.col("fold") == i)))
    return regression_metrics(models.concat(found), by=("fold",))


@pytest.mark.parametrize("missing", [False, True])
def test_stored_folds_score_as_fits_of_their_own(spark, missing, monkeypatch):
    df = rows(spark, missing)
    forest = models.random_forest(numTrees=2, maxDepth=3, bootstrap=False)
    written = []
    store = models.cut_lineage
    monkeypatch.setattr(models, "cut_lineage", lambda table: written.append(table.columns) or store(table))
    by_key = models.cross_validate(df, forest, ["a", "b", "c"]).orderBy("fold").collect()
    # One table without row keys is stored; folds told before take the place of the key.
    assert written == [["__features", "sales_quantity", "fold"]]
    named = with_fold(df, 3, name="part").drop("row_id")
    by_name = models.cross_validate(named, forest, ["a", "b", "c"], fold="part").orderBy("fold").collect()
    want = one_by_one(df, 3).orderBy("fold").collect()
    assert sum(r.n_skipped for r in want) == 6
    for got in (by_key, by_name):
        for a, b in zip(got, want, strict=True):
            assert (a.fold, a.n_rows, a.n_skipped) == (b.fold, b.n_rows, b.n_skipped)
            assert [a[m] for m in METRICS] == pytest.approx([b[m] for m in METRICS], rel=1e-9)


def test_means_of_the_other_folds_come_from_one_scan(spark):
    data = with_fold(rows(spark, True), 3)
    for i, (means, flagged) in enumerate(models.fold_means(data, ["a", "b"], 3, "fold")):
        want, missing = models.input_means(data.where(F.col("fold") != i), ["a", "b"])
        assert means == pytest.approx(want) and flagged == missing == ["b"]
