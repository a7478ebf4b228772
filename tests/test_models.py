"""Clusters, trees, tuning, stored models, the recursive forecast and its files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rows import SALES, day, rows_of
from shelfcast.operators.daily import daily_category, daily_sku
from shelfcast.plans import clusters, forecast, models, tuning
from shelfcast.plans.features import build_features, feature_columns
from shelfcast.session import new_path
from shelfcast.sources.holidays import holiday_calendar
from shelfcast.sources.sales import read_sales_csv, write_csv

START = dt.date(2020, 2, 20)


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        (dt.date(2020, 1, 1) + dt.timedelta(days=d), 1 + s % 2, s, 10.0 * s + d % 5, 3 * s + d % 4)
        for d in range(60)
        for s in range(1, 7)
        if (d + s) % 7
    ]
    df = spark.createDataFrame(rows, SALES)
    return df.withColumn("row_id", F.concat_ws("|", "sku_id", "date")).persist()


@pytest.fixture(scope="module")
def table(spark, sales):
    past = sales.where(F.col("date") < F.lit(START))
    return build_features(past, holiday_calendar(spark, 2020, 2020), clusters=None).table.persist()


@pytest.fixture(scope="module")
def model(table):
    return models.train(table, models.boosted_trees(maxIter=5, maxDepth=4), feature_columns(table))


def test_elbow_falls_from_the_total(table):
    costs = [r["wcss"] for r in clusters.elbow(table, max_k=4).orderBy("k").collect()]
    names = clusters.clustering_features(table)
    varying = sum(table.select(c).distinct().count() > 1 for c in names)
    assert costs[0] == pytest.approx(varying * table.count())
    assert costs[0] == max(costs) and costs[-1] < costs[0]


def test_clusters_only_for_complete_rows(spark, table):
    fitted = clusters.fit_clusters(table, ["sales_price", "lag_1_sales_price"], k=2)
    rows = spark.createDataFrame([(1.0, 2.0), (60.0, 61.0), (None, 1.0), (1.0, float("nan"))], "sales_price double, lag_1_sales_price double")
    got = clusters.assign_clusters(fitted, rows)
    assert got.columns == [*rows.columns, "cluster_id"]
    found = [r["cluster_id"] for r in got.collect()]
    assert found[0] != found[1] and found[2:] == [None, None]


def test_forest_fits_and_names_its_features(spark, table):
    fitted = models.train(table, models.random_forest(numTrees=5, maxDepth=5), feature_columns(table))
    scores = models.evaluate(fitted, table).first()
    assert scores["test_explained_variance"] > 0.8
    importance = models.feature_importance(fitted, spark)
    values = [r["importance"] for r in importance.collect()]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
    assert {r["feature"] for r in importance.collect()} == set(feature_columns(table))


def test_missing_inputs_are_scored(model, table):
    holes = table.limit(3).withColumn("lag_1_sales_quantity", F.lit(None).cast("long"))
    assert models.predict(model, holes).where("prediction is not null").count() == 3


def test_cross_validation_rows_and_means(table):
    folds = models.cross_validate(table, models.random_forest(numTrees=3, maxDepth=4), feature_columns(table)).persist()
    assert sorted(r["fold"] for r in folds.collect()) == [0, 1, 2]
    assert all(r["test_neg_mean_absolute_error"] < 0 for r in folds.collect())
    mean = models.mean_scores(folds).first()["test_neg_mean_absolute_error"]
    assert mean == pytest.approx(sum(r["test_neg_mean_absolute_error"] for r in folds.collect()) / 3)


def test_search_returns_the_best_trial(table):
    space = {"numTrees": tuning.Ints(1, 4), "maxDepth": tuning.Ints(1, 4, log=True), "bootstrap": tuning.Choice((True, False))}
    best, trials = tuning.search(table, models.random_forest(), feature_columns(table), space, trials=2, folds=2)
    assert [r["mae"] for r in trials.collect()] == sorted(r["mae"] for r in trials.collect())
    assert models.predict(best, table).where("prediction is null").count() == 0


def test_draws_stay_in_range_and_repeat():
    for space in (tuning.RANDOM_FOREST_SPACE, tuning.BOOSTED_TREES_SPACE):
        drawn = tuning.draw_trials(space, 50)
        assert drawn == tuning.draw_trials(space, 50)
        for name, choice in space.items():
            for s in drawn:
                value = s[name]
                assert value in choice.values if isinstance(choice, tuning.Choice) else choice.low <= float(value) <= choice.high


def test_store_load_and_retrain(spark, table, tmp_path):
    path = str(tmp_path / "model")
    with pytest.raises(ValueError):
        models.load_model(spark, path)
    names = feature_columns(table)
    first = models.train_or_load(table, models.random_forest(numTrees=2, maxDepth=3), names, path)
    again = models.train_or_load(table, models.random_forest(numTrees=4, maxDepth=3), names, path)
    assert again.stages[-1].getNumTrees == 2
    assert rows_of(models.predict(first, table), "row_id", "prediction") == rows_of(models.predict(again, table), "row_id", "prediction")
    forced = models.train_or_load(table, models.random_forest(numTrees=4, maxDepth=3), names, path, force=True)
    assert forced.stages[-1].getNumTrees == 4


def run(spark, sales, model, days, **options):
    history = sales.where(F.col("date") < F.lit(START))
    last = START + dt.timedelta(days=days - 1)
    samples = sales.where(F.col("date").between(F.lit(START), F.lit(last)))
    return forecast.recursive_forecast(
        samples, daily_sku(history), daily_category(history), model, holiday_calendar(spark, 2020, 2020), **options
    )


def test_one_day_forecast_equals_serving_features_and_prediction(spark, sales, model):
    history, today = sales.where(F.col("date") < F.lit(START)), sales.where(F.col("date") == F.lit(START))
    from shelfcast.operators.calendar import with_calendar, with_holiday_flag

    rows = with_holiday_flag(with_calendar(today), holiday_calendar(spark, 2020, 2020))
    direct = models.predict(model, forecast.serving_features(rows, daily_sku(history), daily_category(history)))
    assert rows_of(direct, "row_id", "prediction") == rows_of(run(spark, sales, model, 1), "row_id", "sales_quantity")


def test_forecast_covers_every_row_and_ignores_order(spark, sales, model):
    first = run(spark, sales, model, 6)
    again = run(spark, sales.repartition(5), model, 6)
    want = sales.where(F.col("date").between(F.lit(START), F.lit(START + dt.timedelta(days=5)))).count()
    assert first.count() == want
    assert rows_of(first, "row_id", "sales_quantity") == rows_of(again, "row_id", "sales_quantity")


def test_later_days_see_earlier_predictions(spark, sales, model):
    """Step by step with the general as-of lookup gives what the day loop gives."""
    from shelfcast.operators.calendar import with_calendar, with_holiday_flag

    history = sales.where(F.col("date") < F.lit(START))
    predicted = None
    for i in range(3):
        today = sales.where(F.col("date") == F.lit(START + dt.timedelta(days=i)))
        rows = with_holiday_flag(with_calendar(today), holiday_calendar(spark, 2020, 2020))
        pool = history.select("date", "category_id", "sku_id", "sales_price", F.col("sales_quantity").cast("double"))
        if predicted is not None:
            pool = pool.unionByName(predicted.select(pool.columns))
        scored = models.predict(model, forecast.serving_features(rows, daily_sku(pool), daily_category(pool)))
        step = scored.select(*pool.columns[:-1], F.col("prediction").alias("sales_quantity"), "row_id").persist()
        predicted = step if predicted is None else predicted.unionByName(step).persist()
    want = {r["row_id"]: r["sales_quantity"] for r in predicted.collect()}
    got = {r["row_id"]: r["sales_quantity"] for r in run(spark, sales, model, 3).collect()}
    assert got == pytest.approx(want)


def test_horizon_is_checked(spark, sales, model):
    with pytest.raises(ValueError):
        run(spark, sales, model, 6, horizon=3)
    assert run(spark, sales.limit(0), model, 3).count() == 0


def test_rows_without_a_date_are_refused(sales):
    with pytest.raises(ValueError):
        forecast.horizon_dates(sales.withColumn("date", F.lit(None).cast("date")))


def test_unknown_sku_is_forecast(spark, sales, model):
    history = sales.where(F.col("date") < F.lit(START))
    new = spark.createDataFrame([(START, 9, 999, 5.0, None)], SALES)
    out = forecast.recursive_forecast(new, daily_sku(history), daily_category(history), model, holiday_calendar(spark, 2020, 2020))
    assert out.first()["sales_quantity"] is not None


def test_backtest(spark, sales, model):
    compared, metrics = forecast.backtest(sales, model, holiday_calendar(spark, 2020, 2020), START, days=4)
    assert compared.where("sales_quantity_right is null").count() == 0
    assert metrics.first()["test_neg_root_mean_squared_error"] <= metrics.first()["test_neg_mean_absolute_error"] <= 0


def test_forecast_file(spark, sales, model, tmp_path):
    history, future = sales.where(F.col("date") < F.lit(START)), str(tmp_path / "future")
    last = START + dt.timedelta(days=2)
    rows = sales.where(F.col("date").between(F.lit(START), F.lit(last)))
    write_csv(rows.select("row_id", "sku_id", "category_id", "sales_price", "date"), future)
    out = str(tmp_path / "out")
    forecast.forecast_file(spark, future, out, daily_sku(history), daily_category(history), model, holiday_calendar(spark, 2020, 2020))
    written = read_sales_csv(spark, out)
    assert written.columns == ["date", "category_id", "sku_id", "sales_price", "sales_quantity"]
    assert written.count() == rows.count() and written.where("sales_quantity is null").count() == 0


def test_reading_bad_values(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("i,sales_quantity,date,sku_id,category_id,sales_price\n0,1,2020-01-01,1,2,3.5\n1,,2020-13-01,1,2,x\n")
    with pytest.raises(Exception):
        read_sales_csv(spark, str(path)).collect()
    lenient = read_sales_csv(spark, str(path), strict=False).orderBy("date").collect()
    assert lenient[0]["date"] is None and lenient[0]["sales_price"] is None
    assert tuple(lenient[1]) == (day(1), 2, 1, 3.5, 1.0)
    with pytest.raises(Exception):
        read_sales_csv(spark, str(tmp_path / "missing.csv"))


def test_paths_are_new(spark):
    assert new_path(spark, "x") != new_path(spark, "x")


def test_flags_of_inputs_never_missing_change_no_prediction(spark, table):
    names = feature_columns(table)
    fitted = models.train(table, models.boosted_trees(maxIter=3, maxDepth=3), names)
    assert not [c for c in fitted.stages[-2].getInputCols() if c.startswith("__missing_")]
    means, flagged = models.input_means(table, names)
    assert flagged == []
    whole = models.regression_pipeline(models.boosted_trees(maxIter=3, maxDepth=3), names, means).fit(table)
    holes = table.withColumn("lag_1_sales_quantity", F.when(F.col("sku_id") > 3, F.col("lag_1_sales_quantity")))
    one, other = (models.predict(m, holes).select("row_id", F.round("prediction", 9)) for m in (fitted, whole))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
