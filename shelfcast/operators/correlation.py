"""Pearson correlation of all column pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.values import as_number

_MATRIX = "a string, b string, corr double"


def correlation_matrix(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(a, b, corr) for every ordered pair of the remaining columns, in one pass over all rows.

    Tasks keep the count, means and products of differences of their rows and update them a batch at a time
    with one matrix product; a task hands on a single row, and these are merged in the same way, which
    keeps small differences of large numbers accurate. Null for a constant column and for one holding
    nulls, where the coefficient is undefined.
    """
    types = {f.name: f.dataType for f in df.schema.fields if f.name not in exclude}
    names = list(types)
    width = len(names)
    numbers = df.select(*[as_number(c, t).cast("double").alias(f"c{i}") for i, (c, t) in enumerate(types.items())])

    # Defined in here and using no function of this package, so that it travels to workers as it is.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products, nulls = 0, np.zeros(width), np.zeros((width, width)), np.zeros(width)
        least, most = np.full(width, np.inf), np.full(width, -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            nulls += [c.null_count for c in batch.columns]
            values = np.stack([pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            with np.errstate(invalid="ignore"):
                own = values.mean(axis=0)
                moved = values - own
                step, m = own - mean, len(values)
                products += moved.T @ moved + np.outer(step, step) * (n * m / (n + m))
                mean += step * (m / (n + m))
            n += m
            least, most = np.minimum(least, values.min(axis=0)), np.maximum(most, values.max(axis=0))
        if n:
            sums = (mean, products, nulls, least, most)
            columns = [pa.array([n], pa.int64()), *(pa.array([x.ravel()], pa.list_(pa.float64())) for x in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    fields = ["n", "mean", "products", "nulls", "least", "most"]
    parts = numbers.mapInArrow(run, "n long, " + ", ".join(f"{c} array<double>" for c in fields[1:])).collect()
    n, mean, products, nulls = 0, np.zeros(width), np.zeros((width, width)), np.zeros(width)
    least, most = np.full(width, np.inf), np.full(width, -np.inf)
    for r in parts:
        step, m = np.array(r["mean"]) - mean, r["n"]
        products += np.array(r["products"]).reshape(width, width) + np.outer(step, step) * (n * m / (n + m))
        mean += step * (m / (n + m))
        nulls += r["nulls"]
        n += m
        least, most = np.minimum(least, r["least"]), np.maximum(most, r["most"])
    # Rounding alone must not make a constant column vary.
    usable = [n > 0 and not nulls[i] and least[i] != most[i] for i in range(width)]
    rows = []
    for i, j in product(range(len(names)), repeat=2):
        value = None
        if usable[i] and usable[j]:
            norm = math.sqrt(products[i, i] * products[j, j])
            value = float(products[i, j] / norm) if norm else None
        rows.append((names[i], names[j], value))
    return df.sparkSession.createDataFrame(rows, _MATRIX)


def wide_correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table for many columns through MLlib's vectorised Gram matrix; no nulls allowed."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = df.select(*[as_number(c, types[c]).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v", handleInvalid="error").transform(numbers)
    matrix = Correlation.corr(vectors.select("v"), "v").first()[0].toArray()
    rows = [
        (a, b, None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, _MATRIX)
