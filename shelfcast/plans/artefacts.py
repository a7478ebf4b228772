"""Feature state, scaler, clusters and regressor as one fitted model that is stored and loaded whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasSeed
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.functions.values import as_number
from shelfcast.operators.daily import daily_base, roll_up
from shelfcast.operators.scaling import scaling_parameters
from shelfcast.plans.clusters import assign_clusters
from shelfcast.plans.features import build_features, feature_columns
from shelfcast.plans.forecast import latest_days, recursive_forecast
from shelfcast.plans.models import train
from shelfcast.schema import CATEGORY, DATE, HORIZON_DAYS, NUM_CLUSTERS, NUM_LAGS, PRICE, QUANTITY, SKU, WINDOW_SIZE
from shelfcast.session import cut_lineage

_SCALED = "__scaled_"


def _int(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toInt)


class Standardiser(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns mean and population deviation of its inputs in one aggregate."""

    def __init__(self, inputCols: Sequence[str] = ()):  # noqa: N803
        super().__init__()
        self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> StandardiserModel:
        rows = scaling_parameters(df, self.getInputCols()).collect()
        return self._copyValues(StandardiserModel({r["column"]: (r["mean"], r["std"]) for r in rows}))


class StandardiserModel(Model, HasInputCols, MLWritable, MLReadable):
    """Adds (x - mean) / std of each input under a name of its own, 0 where the deviation is; its state is a
    table (column, mean, std)."""

    def __init__(self, moments: dict[str, tuple[float | None, float | None]] | None = None):
        super().__init__()
        self.moments = moments or {}

    def outputs(self) -> list[str]:
        return [_SCALED + c for c in self.getInputCols()]

    def _transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        added = {}
        for c in self.getInputCols():
            mean, std = self.moments[c]
            moved = as_number(c, types[c]).cast("double") - F.lit(mean)
            added[_SCALED + c] = moved / F.lit(std) if std else F.when(moved.isNotNull(), F.lit(0.0))
        return df.withColumns(added)

    def write(self) -> MLWriter:
        return _Writer(self, lambda path, spark: spark.createDataFrame(
            [(c, *m) for c, m in self.moments.items()], "column string, mean double, std double"
        ).coalesce(1).write.parquet(f"{path}/moments"))

    @classmethod
    def read(cls) -> MLReader:
        def load(path: str, spark: SparkSession) -> StandardiserModel:
            return cls({r["column"]: (r["mean"], r["std"]) for r in spark.read.parquet(f"{path}/moments").collect()})

        return _Reader(load)


class _Writer(MLWriter):
    """Metadata, then what the model itself stores."""

    def __init__(self, model: Params, store):
        super().__init__()
        self.model, self.store = model, store

    def saveImpl(self, path: str) -> None:  # noqa: N802
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        self.store(path, spark)


class _Reader(MLReader):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def load(self, path: str):
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.make(path, spark)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _ForecastParams(HasSeed):
    lags = _int("lags", "sale days of a SKU that its rows look back to")
    window = _int("window", "sale days of a category that are averaged")
    clusters = _int("clusters", "number of clusters, 0: none")
    horizon = _int("horizon", "most calendar days of a forecast")
    normalise = Param(Params._dummy(), "normalise", "whether the regressor sees standardised inputs", typeConverter=TypeConverters.toBoolean)

    def _defaults(self) -> None:
        self._setDefault(lags=NUM_LAGS, window=WINDOW_SIZE, clusters=NUM_CLUSTERS, horizon=HORIZON_DAYS, normalise=False, seed=42)


class DemandForecaster(Estimator, _ForecastParams):
    """From sales rows to a model that forecasts future rows: features, clusters, scaler and ``regressor``.

    ``regressor`` is an estimator of the library's trees, or a transformer that adds the prediction as it
    is. ``holidays`` is a (date, name) table.
    """

    def __init__(self, regressor: Estimator | Transformer, holidays: DataFrame, **params: object):
        super().__init__()
        self._defaults()
        self._set(**params)
        self.regressor, self.holidays = regressor, holidays

    def _fit(self, df: DataFrame) -> DemandForecasterModel:
        get = lambda p: self.getOrDefault(p)
        base = daily_base(df)
        days = {key: cut_lineage(roll_up(base, key)) for key in (SKU, CATEGORY)}
        fitted, grouping = self.regressor, None
        if isinstance(self.regressor, Estimator) or get(self.clusters):
            build = build_features(
                df, self.holidays, lags=get(self.lags), window=get(self.window), clusters=get(self.clusters) or None,
                seed=get(self.seed), daily_sku=days[SKU], daily_category=days[CATEGORY],
            )
            grouping = build.clusters
            if isinstance(self.regressor, Estimator):
                fitted = self._trained(build.table)
        if not isinstance(fitted, PipelineModel):
            fitted = PipelineModel([fitted])
        return self._copyValues(DemandForecasterModel(self._last_days(df, days), self.holidays, fitted, grouping))

    def _trained(self, table: DataFrame) -> PipelineModel:
        names = feature_columns(table)
        if not self.getOrDefault(self.normalise):
            return train(table, self.regressor, names)
        scaler = Standardiser(names).fit(table)
        model = train(scaler.transform(table), self.regressor, scaler.outputs())
        return PipelineModel([scaler, *model.stages])

    def _last_days(self, df: DataFrame, days: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The days of each key that a later row can look back to: all that a forecast needs of the history."""
        last = df.agg(F.date_add(F.max(DATE), 1)).first()[0]
        kept = {}
        for key, k in ((SKU, self.getOrDefault(self.lags)), (CATEGORY, self.getOrDefault(self.window))):
            table = days[key] if last is None else latest_days(days[key], key, k, last).select(key, F.inline("days"))
            kept[key] = cut_lineage(table.select(key, DATE, F.col(PRICE).cast("double"), F.col(QUANTITY).cast("double")))
        return kept


class DemandForecasterModel(Model, _ForecastParams, MLWritable, MLReadable):
    """Forecasts rows that lie after the history it was fitted on, day by day.

    Its state are tables (the last days of every SKU and category, the holidays, the scaler's moments, the
    nodes of the trees) and the centres of the clusters; it is stored and loaded whole, and a folder whose
    writing was interrupted is not taken for a model.
    """

    def __init__(
        self,
        days: dict[str, DataFrame] | None = None,
        holidays: DataFrame | None = None,
        regressor: PipelineModel | None = None,
        grouping: PipelineModel | None = None,
    ):
        super().__init__()
        self._defaults()
        self.days, self.holidays, self.regressor, self.grouping = days or {}, holidays, regressor, grouping

    def _transform(self, df: DataFrame) -> DataFrame:
        get = lambda p: self.getOrDefault(p)
        return recursive_forecast(
            df, self.days[SKU], self.days[CATEGORY], self.regressor, self.holidays, clusters=self.grouping, lags=get(self.lags),
            window=get(self.window), horizon=get(self.horizon),
        )

    def grouped(self, features: DataFrame) -> DataFrame:
        """Feature rows with the cluster of the model."""
        if self.grouping is None:
            raise ValueError("this model was fitted without clusters")
        return assign_clusters(self.grouping, features)

    def write(self) -> MLWriter:
        def store(path: str, spark: SparkSession) -> None:
            for key, table in self.days.items():
                table.write.parquet(f"{path}/days_{key}")
            self.holidays.write.parquet(f"{path}/holidays")
            self.regressor.write().save(f"{path}/regressor")
            if self.grouping is not None:
                self.grouping.write().save(f"{path}/clusters")
            spark.range(1).write.parquet(f"{path}/complete")

        return _Writer(self, store)

    @classmethod
    def read(cls) -> MLReader:
        def load(path: str, spark: SparkSession) -> DemandForecasterModel:
            try:
                whole = spark.read.parquet(f"{path}/complete").count() == 1
            except AnalysisException:
                whole = False
            if not whole:
                raise ValueError(f"{path} holds no whole model")
            days = {key: spark.read.parquet(f"{path}/days_{key}") for key in (SKU, CATEGORY)}
            holidays = spark.read.parquet(f"{path}/holidays")
            stored = DefaultParamsReader.loadMetadata(path, spark)
            number = stored["paramMap"].get("clusters", stored["defaultParamMap"]["clusters"])
            grouping = PipelineModel.load(f"{path}/clusters") if number else None
            return cls(days, holidays, PipelineModel.load(f"{path}/regressor"), grouping)

        return _Reader(load)
