"""Standardisation of numeric columns with population moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.functions.values import as_number
from shelfcast.schema import QUANTITY


def scalable_columns(df: DataFrame, *, include_target: bool = True, target: str = QUANTITY) -> list[str]:
    kinds = (T.NumericType, T.BooleanType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    return [c for c in names if include_target or c != target]


def scaling_parameters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std) with the population standard deviation."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = df.select(*[as_number(c, types[c]).alias(c) for c in columns])
    rows = [
        F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")) for c in columns
    ]
    return numbers.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def apply_scaling(df: DataFrame, parameters: DataFrame) -> DataFrame:
    """(x - mean) / std for every column in ``parameters`` (one small row each), 0 where std is 0."""
    types = {f.name: f.dataType for f in df.schema.fields}
    known = {r["column"]: r for r in parameters.collect()}

    def scaled(c: str) -> Column:
        mean, std = known[c]["mean"], known[c]["std"]
        if mean is None:
            return F.lit(None).cast("double")
        shifted = as_number(c, types[c]) - F.lit(mean)
        return shifted / F.lit(std) if std else F.when(shifted.isNotNull(), F.lit(0.0))

    return df.select(*[scaled(c).alias(c) if c in known else F.col(c) for c in df.columns])


def standardise(
    df: DataFrame, columns: Sequence[str] | None = None, *, fit_on: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The scaled table and the parameters, fitted on the same rows or on those of ``fit_on``.

    Fitting is one aggregate whose few numbers are kept, so the parameters are fixed from then on.
    """
    columns = list(columns or scalable_columns(df))
    fitted = scaling_parameters(df if fit_on is None else fit_on, columns).collect()
    parameters = df.sparkSession.createDataFrame(fitted, "column string, mean double, std double")
    return apply_scaling(df, parameters), parameters
