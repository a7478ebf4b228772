"""Regression error measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rmse(label: Column, prediction: Column) -> Column:
    error = label - prediction
    return F.sqrt(F.avg(error * error))


def mae(label: Column, prediction: Column) -> Column:
    return F.avg(F.abs(label - prediction))


def explained_variance(label: Column, prediction: Column) -> Column:
    """1 - Var(error)/Var(label) over the rows that have both. A constant label scores 1 when the error is
    constant too, else 0."""
    var_error = F.var_pop(label - prediction)
    var_label = F.var_pop(F.when(prediction.isNotNull(), label))
    flat = F.when(var_error == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(var_label == 0, flat).otherwise(F.lit(1.0) - F.try_divide(var_error, var_label))
