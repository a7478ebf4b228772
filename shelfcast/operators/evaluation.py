"""Regression metrics of a prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions import fit_errors
from shelfcast.schema import PREDICTION, QUANTITY


def regression_metrics(
    predictions: DataFrame, label: str = QUANTITY, prediction: str = PREDICTION, by: tuple[str, ...] = ()
) -> DataFrame:
    """Negated RMSE and MAE plus explained variance, in one aggregate, overall or per ``by`` columns.

    ``n_rows`` rows have a label and a prediction and count; ``n_skipped`` lack one of them.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return predictions.groupBy(*by).agg(
        (-fit_errors.rmse(y, p)).alias("test_neg_root_mean_squared_error"),
        (-fit_errors.mae(y, p)).alias("test_neg_mean_absolute_error"),
        fit_errors.explained_variance(y, p).alias("test_explained_variance"),
        F.count(y + p).alias("n_rows"),
        F.count_if((y + p).isNull()).alias("n_skipped"),
    )
