"""Serving features, recursive forecast, backtest and the forecast job."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfcast.functions.values import array_mean
from shelfcast.operators.asof import lags_asof, means_asof, sample_days
from shelfcast.operators.calendar import with_calendar, with_holiday_flag
from shelfcast.operators.daily import daily, daily_base, roll_up
from shelfcast.operators.evaluation import regression_metrics
from shelfcast.operators.joins import attach, attach_stored, hot_keys, with_actuals
from shelfcast.operators.rows import concat
from shelfcast.plans.clusters import assign_clusters
from shelfcast.plans.models import predict
from shelfcast.schema import (
    CATEGORY,
    DATE,
    HORIZON_DAYS,
    N_ROWS,
    NUM_LAGS,
    PREDICTION,
    PRICE,
    QUANTITY,
    ROW_ID,
    SKU,
    WINDOW_SIZE,
    lag_name,
    sma_name,
)
from shelfcast.session import cut_lineage, new_path
from shelfcast.sources.sales import read_sales_csv, write_forecast


def serving_features(
    samples: DataFrame,
    daily_sku: DataFrame,
    daily_category: DataFrame,
    *,
    lags: int = NUM_LAGS,
    window: int = WINDOW_SIZE,
    inclusive: bool = True,
    clusters: PipelineModel | None = None,
) -> DataFrame:
    """Lag and average columns for rows to be scored, from the history at or before each row's date.

    The lookup works on the distinct (key, date) pairs of the samples; results are joined back with
    hot pairs split, so neither many samples of one SKU nor a long history meets in one task. Every
    sample is kept; a null key leaves its columns null.
    """
    sku_days = cut_lineage(sample_days(samples, SKU))
    recent = lags_asof(sku_days, daily_sku, lags=lags, inclusive=inclusive)
    out = attach(samples, recent, [SKU, DATE], weights=sku_days, how="left")
    category_days = sample_days(samples, CATEGORY)
    means = means_asof(category_days, daily_category, window=window, inclusive=inclusive)
    out = attach_stored(out, means, [CATEGORY, DATE], weights=means, how="left")
    return out if clusters is None else assign_clusters(clusters, out)


def latest_days(history: DataFrame, key: str, k: int, before: dt.date) -> DataFrame:
    """(key, days): the last ``k`` history days of every key before a date, newest first, in one aggregate.

    Windows rank the days of a key, of which there is one a calendar day at most.
    """
    newest = Window.partitionBy(key).orderBy(F.col(DATE).desc())
    recent = (
        history.where((F.col(DATE) < F.lit(before)) & F.col(key).isNotNull())
        .withColumn("__age", F.row_number().over(newest))
        .where(F.col("__age") <= k)
    )
    return recent.groupBy(key).agg(F.sort_array(F.collect_list(_day()), asc=False).alias("days"))


def _day():
    return F.struct(DATE, F.col(PRICE).cast("double").alias(PRICE), F.col(QUANTITY).cast("double").alias(QUANTITY))


def _known_days(days: DataFrame, key: str) -> DataFrame:
    """(key, days) of a table with at most a few rows for any key."""
    return days.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(_day()).alias("days"))


def _days_column(key: str) -> str:
    return f"__days_{key}"


def _day_features(
    today: DataFrame, later: dict[str, DataFrame], hot: dict[str, DataFrame], lags: int, window: int
) -> DataFrame:
    """:func:`serving_features` for the rows of one day, which carry the last days of their keys before the
    horizon; ``later`` has the days since then for the keys that have any."""
    out, recent = today, {}
    for key, k in ((SKU, lags), (CATEGORY, window)):
        known = F.col(_days_column(key))
        if key in later:
            out = attach(out, later[key].withColumnRenamed("days", "__later"), [key], hot=hot[key], how="left")
            none = F.array().cast(later[key].schema["days"].dataType)
            both = F.concat(F.coalesce(known, none), F.coalesce("__later", none))
            out = out.withColumn(_days_column(key), F.slice(F.sort_array(both, asc=False), 1, k)).drop("__later")
        recent[key] = known
    columns = {
        lag_name(i, c): F.get(recent[SKU], F.lit(i - 1))[c] for c in (PRICE, QUANTITY) for i in range(1, lags + 1)
    } | {sma_name(window, c): array_mean(f"{_days_column(CATEGORY)}.{c}") for c in (PRICE, QUANTITY)}
    return out.withColumns(columns).drop(*[_days_column(key) for key in (SKU, CATEGORY)])


def horizon_dates(samples: DataFrame, horizon: int = HORIZON_DAYS) -> list[dt.date]:
    """The dates to forecast, at most ``horizon`` calendar days apart."""
    first, last, undated = samples.agg(F.min(DATE), F.max(DATE), F.count_if(F.col(DATE).isNull())).first()
    if undated:
        raise ValueError(f"{undated} rows to forecast have no date")
    if first is None:
        return []
    span = (last - first).days + 1
    if span > horizon:
        raise ValueError(f"rows to forecast span {span} days, more than the horizon of {horizon}")
    return [first + dt.timedelta(days=i) for i in range(span)]


def recursive_forecast(
    samples: DataFrame,
    daily_sku: DataFrame,
    daily_category: DataFrame,
    model: PipelineModel,
    holidays: DataFrame,
    *,
    clusters: PipelineModel | None = None,
    lags: int = NUM_LAGS,
    window: int = WINDOW_SIZE,
    horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """Predict day by day, each day's predictions being history for the days after it.

    All rows of a day are scored at once, so the result does not depend on any row order. The last days of
    every key before the horizon are looked up once, for the keys of the samples alone, and stored with the
    rows by date. A step reads the rows of its day, and what was observed or predicted for the horizon's
    days before: a table that is no longer than the samples, however long the history. Its only write are
    its predictions. History on a day is visible to the rows of that day, as in :func:`serving_features`;
    of an observed and a predicted row of the same day the one with the higher price counts as the later.
    """
    spark = samples.sparkSession
    inputs = [c for c in samples.columns if c not in (QUANTITY, PREDICTION)]
    prepared = cut_lineage(with_holiday_flag(with_calendar(samples.select(*inputs)), holidays))
    dates = horizon_dates(prepared, horizon)
    wanted = prepared.withColumn(QUANTITY, F.lit(0.0)).select(*inputs, QUANTITY).schema
    if not dates:
        return spark.createDataFrame([], wanted)
    sources = {SKU: (daily_sku, lags), CATEGORY: (daily_category, window)}
    rows, hot, observed, seen = prepared, {}, {}, {}
    for key, (history, k) in sources.items():
        weights = cut_lineage(prepared.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(N_ROWS)))
        hot[key] = hot_keys(weights, [key])
        known = history.where(F.col(DATE) <= F.lit(dates[-1])).join(weights.select(key), key, "left_semi")
        known = cut_lineage(known.select(key, DATE, PRICE, QUANTITY))
        before = latest_days(known, key, k, dates[0]).withColumnRenamed("days", _days_column(key))
        rows = attach(rows, before, [key], hot=hot[key], how="left")
        observed[key] = known.where(F.col(DATE) >= F.lit(dates[0]))
        seen[key] = {r[0] for r in observed[key].select(DATE).distinct().collect()}
    by_day = new_path(spark, "samples")
    rows.withColumn("__day", F.date_format(DATE, "yyyy-MM-dd")).write.partitionBy("__day").parquet(by_day)
    present = {r[0] for r in prepared.select(DATE).distinct().collect()}
    path = new_path(spark, "forecast")
    written: list[str] = []
    for day in dates:
        if day not in present:
            continue
        later: dict[str, DataFrame] = {}
        for key in sources:
            known = []
            if written:
                known.append(daily(spark.read.schema(wanted).parquet(*written), key).select(key, DATE, PRICE, QUANTITY))
            if any(d <= day for d in seen[key]):
                known.append(observed[key].where(F.col(DATE) <= F.lit(day)))
            if known:
                later[key] = _known_days(concat(known), key)
        of_day = spark.read.schema(rows.schema).parquet(f"{by_day}/__day={day.isoformat()}")
        today = _day_features(of_day, later, hot, lags, window)
        today = today if clusters is None else assign_clusters(clusters, today)
        scored = predict(model, today).select(*inputs, F.col(PREDICTION).alias(QUANTITY))
        scored.write.parquet(f"{path}/{day.isoformat()}")
        written.append(f"{path}/{day.isoformat()}")
    return spark.read.schema(wanted).parquet(*written)


def holdout_forecast(
    rows: DataFrame, daily_sku: DataFrame, daily_category: DataFrame, model: PipelineModel, holidays: DataFrame, **options: object
) -> DataFrame:
    """Random rows scored in one pass without recursion: serving features from the given history, then the model."""
    served = serving_features(with_holiday_flag(with_calendar(rows), holidays), daily_sku, daily_category, **options)
    return predict(model, served)


def backtest(
    sales: DataFrame,
    model: PipelineModel,
    holidays: DataFrame,
    start: dt.date,
    *,
    days: int = HORIZON_DAYS,
    clusters: PipelineModel | None = None,
    lags: int = NUM_LAGS,
    window: int = WINDOW_SIZE,
    row_key: str = ROW_ID,
) -> tuple[DataFrame, DataFrame]:
    """Forecast a known window from earlier sales only: the rows with their actuals, and the metrics."""
    end = start + dt.timedelta(days=days - 1)
    history = sales.where(F.col(DATE) < F.lit(start))
    held_out = sales.where(F.col(DATE).between(F.lit(start), F.lit(end)))
    base = daily_base(history)
    forecast = recursive_forecast(
        held_out,
        roll_up(base, SKU),
        roll_up(base, CATEGORY),
        model,
        holidays,
        clusters=clusters,
        lags=lags,
        window=window,
        horizon=days,
    )
    compared = with_actuals(forecast, held_out, [row_key])
    return compared, regression_metrics(compared, f"{QUANTITY}_right", QUANTITY)


def forecast_file(
    spark: SparkSession,
    future_csv: str,
    output: str,
    daily_sku: DataFrame,
    daily_category: DataFrame,
    model: PipelineModel,
    holidays: DataFrame,
    *,
    clusters: PipelineModel | None = None,
    horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """Read the future rows, forecast them, write the filled rows as CSV and return what was written."""
    future = read_sales_csv(spark, future_csv)
    forecast = recursive_forecast(
        future, daily_sku, daily_category, model, holidays, clusters=clusters, horizon=horizon
    )
    write_forecast(forecast, output)
    return read_sales_csv(spark, output)
