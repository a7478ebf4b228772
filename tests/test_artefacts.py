"""One stored artefact: what it forecasts in memory it forecasts after it was stored and loaded."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rows import SALES, day
from shelfcast.plans import artefacts, models
from shelfcast.sources.holidays import holiday_calendar


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(1)
    rows = []
    for sku in range(8):
        for n in range(1, 29):
            for month in (1, 2):
                if rng.random() < 0.7:
                    rows.append((day(n, month), sku % 3, sku, float(rng.randint(5, 20)), rng.randint(1, 9) + sku))
    return spark.createDataFrame(rows, SALES)


@pytest.fixture(scope="module")
def future(spark):
    rows = [(day(1 + i % 5, 3), s % 3, s, 10.0 + s, None) for i in range(10) for s in (0, 3, 7, 99)]
    return spark.createDataFrame(rows, SALES)


def outcome(df):
    return sorted((r.date, r.sku_id, r.sales_price, r.sales_quantity) for r in df.collect())


@pytest.mark.parametrize(("kind", "normalise"), [("leafwise", True), ("mllib", False)])
def test_loaded_model_forecasts_the_same(spark, sales, future, tmp_path, kind, normalise):
    learner = models.leafwise_boosting(rounds=3, numLeaves=4, minDataInLeaf=5) if kind == "leafwise" else models.random_forest(numTrees=2, maxDepth=3)
    fitted = artefacts.DemandForecaster(learner, holiday_calendar(spark, 2020, 2020), clusters=2, normalise=normalise).fit(sales)
    before = outcome(fitted.transform(future))
    fitted.write().save(str(tmp_path / "m"))
    loaded = artefacts.DemandForecasterModel.load(str(tmp_path / "m"))
    assert outcome(loaded.transform(future)) == before and len(before) == 40
    assert loaded.getOrDefault("normalise") == normalise and len({q for *_, q in before}) > 1


def test_state_is_bounded_by_keys_not_by_history(spark, sales):
    fitted = artefacts.DemandForecaster(models.random_forest(numTrees=1, maxDepth=1), holiday_calendar(spark, 2020, 2020), clusters=0).fit(sales)
    assert fitted.days["sku_id"].groupBy("sku_id").count().agg(F.max("count")).first()[0] == 3
    assert fitted.days["category_id"].groupBy("category_id").count().agg(F.max("count")).first()[0] == 5
    assert fitted.days["sku_id"].agg(F.min("date")).first()[0] > day(15, 2)


def test_an_interrupted_folder_is_no_model(spark, sales, tmp_path):
    fitted = artefacts.DemandForecaster(models.random_forest(numTrees=1, maxDepth=1), holiday_calendar(spark, 2020, 2020), clusters=0).fit(sales)
    path = tmp_path / "m"
    fitted.write().save(str(path))
    for file in (path / "complete").iterdir():
        file.unlink()
    (path / "complete").rmdir()
    with pytest.raises(ValueError):
        artefacts.DemandForecasterModel.load(str(path))


def test_standardiser_is_stored_as_a_table(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5, True), (3.0, 5, False), (None, 5, None)], "a double, b int, c boolean")
    model = artefacts.Standardiser(["a", "b", "c"]).fit(df)
    model.write().save(str(tmp_path / "s"))
    again = artefacts.StandardiserModel.load(str(tmp_path / "s"))
    got = [tuple(r) for r in again.transform(df).select(*again.outputs()).collect()]
    assert got == [(-1.0, 0.0, 1.0), (1.0, 0.0, -1.0), (None, 0.0, None)] and again.moments == model.moments
