"""The training feature table."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession

from shelfcast.operators.calendar import with_calendar, with_holiday_flag
from shelfcast.operators.daily import daily, daily_base, roll_up
from shelfcast.operators.history import lag_table, moving_average_table
from shelfcast.operators.joins import attach, attach_stored
from shelfcast.operators.layout import LaidOut, lay_out
from shelfcast.operators.rows import drop_nulls as without_nulls
from shelfcast.operators.scaling import standardise
from shelfcast.plans.clusters import assign_clusters, clustering_features, fit_clusters
from shelfcast.schema import (
    CATEGORY,
    DATE,
    NUM_CLUSTERS,
    NUM_LAGS,
    QUANTITY,
    SKU,
    WINDOW_SIZE,
)
from shelfcast.session import cut_lineage, drop_path, new_path, release_shuffles, scratch


@dataclass(frozen=True)
class FeatureBuild:
    """A feature table with the models that were fitted on the way."""

    table: DataFrame
    clusters: PipelineModel | None = None
    scaling: DataFrame | None = None

    def cluster_model(self) -> PipelineModel:
        if self.clusters is None:
            raise ValueError("this feature table was built without clusters")
        return self.clusters

    def scaling_table(self) -> DataFrame:
        if self.scaling is None:
            raise ValueError("this feature table was built without normalisation")
        return self.scaling


def with_lags(
    sales: DataFrame, *, lags: int = NUM_LAGS, daily_sku: DataFrame | None = None
) -> DataFrame:
    """Sales rows with the price and quantity of the SKU's previous sale days.

    ``daily_sku`` may be a stored table, which pays where it is much smaller than the sales: it gives the lags
    and the weights of the join. Otherwise it is built here.
    """
    days = daily(sales, SKU) if daily_sku is None else daily_sku
    return attach(sales, lag_table(days, lags=lags), [SKU, DATE], weights=days)


def lay_out_sales(sales: DataFrame, name: str, *, buckets: int, **options: Any) -> LaidOut:
    """Sales as a bucketed catalog table by SKU and date, for :func:`laid_out_lags` without moving them again."""
    return lay_out(sales, [SKU, DATE], name, buckets=buckets, **options)


def laid_out_lags(spark: SparkSession, sales: LaidOut, *, lags: int = NUM_LAGS) -> DataFrame:
    """:func:`with_lags` of sales laid out by SKU and date: only daily rows are exchanged."""
    return sales.attach(lag_table(daily(sales.rows(spark), SKU), lags=lags))


def with_moving_averages(
    sales: DataFrame,
    *,
    window: int = WINDOW_SIZE,
    include_current: bool = True,
    daily_category: DataFrame | None = None,
) -> DataFrame:
    """Sales rows with the category's trailing averages, a stored table that Spark broadcasts if small."""
    days = daily(sales, CATEGORY) if daily_category is None else daily_category
    averages = moving_average_table(days, window=window, include_current=include_current)
    return attach_stored(sales, averages, [CATEGORY, DATE], weights=averages)


def build_features(
    sales: DataFrame,
    holidays: DataFrame,
    *,
    lags: int | None = NUM_LAGS,
    window: int | None = WINDOW_SIZE,
    clusters: int | None = NUM_CLUSTERS,
    drop_nulls: bool = True,
    normalise: bool = False,
    include_current: bool = True,
    seed: int = 42,
    daily_sku: DataFrame | None = None,
    daily_category: DataFrame | None = None,
    train_only: Column | None = None,
) -> FeatureBuild:
    """Calendar, holiday, lag, moving-average and cluster columns for every sales row.

    None for ``lags``, ``window`` or ``clusters`` leaves that step out. Both daily tables come from one
    aggregate to (sku, category, date), unless they are given, so the fact is read for it and for the rows
    and no more. The SKU join runs on the bare sales columns, so the one exchange of the whole fact stays
    narrow. The lags are stored and not the SKU's days; the base is deleted. The joined table is written once if models are to be fitted on it. ``train_only`` is a test on
    rows: where given, clusters and scaling are fitted on the rows that pass it alone.
    """
    table, spark = sales, sales.sparkSession
    base = None
    if (lags and daily_sku is None) or (window and daily_category is None):
        base = new_path(spark, "daily-base")
        both = daily_base(sales, base)
        release_shuffles(spark)
        daily_category = roll_up(both, CATEGORY) if daily_category is None else daily_category
    if lags and daily_sku is None:
        # Dealt by SKU once: the days of a SKU, at most one a date and category, meet there for sums and lags alike.
        found = cut_lineage(lag_table(roll_up(both.repartition(SKU), SKU), lags=lags))
        release_shuffles(spark)
        table = attach(table, found, [SKU, DATE], weights=found)
    elif lags:
        table = with_lags(table, lags=lags, daily_sku=daily_sku)
    if window:
        table = with_moving_averages(
            table, window=window, include_current=include_current, daily_category=daily_category
        )
    if base:
        drop_path(spark, base)
    table = with_holiday_flag(with_calendar(table), holidays)
    added = [c for c in table.columns if c not in sales.columns]
    from_history = [c for c in added if c.startswith(("lag_", "sma_"))]
    calendar = [c for c in added if c not in from_history]
    table = table.select(*sales.columns, *calendar, *from_history)
    model = None
    if clusters or normalise:
        table = cut_lineage(table)
    if clusters:
        names = clustering_features(table)
        model = fit_clusters(table if train_only is None else table.where(train_only), names, k=clusters, seed=seed)
        table = assign_clusters(model, table)
    if drop_nulls:
        table = without_nulls(table)
    scaling = None
    if normalise:
        table, scaling = standardise(table, fit_on=None if train_only is None else table.where(train_only))
    return FeatureBuild(table, model, scaling)


def stored_features(sales: DataFrame, holidays: DataFrame, **options: Any) -> DataFrame:
    """The table of :func:`build_features` without clusters or scaling, stored. The sales are stored first, as they are
    read twice and may come from joins; all but the result is deleted."""
    spark = sales.sparkSession
    path = new_path(spark, "features")
    with scratch(spark):
        rows = cut_lineage(sales)
        release_shuffles(spark)
        table = cut_lineage(build_features(rows, holidays, clusters=None, **options).table, path)
    release_shuffles(spark)
    return table


def feature_columns(table: DataFrame, *, exclude: tuple[str, ...] = (QUANTITY,)) -> list[str]:
    """Model inputs of a feature table: every numeric or boolean column but the target."""
    return clustering_features(table, exclude=exclude)
