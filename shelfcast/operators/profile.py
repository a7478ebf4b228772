"""Column profiles, value counts and key lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.values import as_number
from shelfcast.operators.quantiles import exact_quantiles
from shelfcast.schema import CLUSTER, DATE, PRICE, QUANTITY
from shelfcast.session import cut_lineage


def null_counts(df: DataFrame, suffix: str = "_null_count") -> DataFrame:
    """One row with the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}{suffix}") for c in df.columns])


def distinct_counts(df: DataFrame, *, approximate: bool = False) -> DataFrame:
    """(column, n_unique) with null counted as a value.

    One scan: every task turns its rows into distinct (column, value) entries before the exchange, so a
    value that many rows share leaves a task once. Values are compared as text, which tells all values of
    the simple types apart.
    """
    if approximate:
        counts = df.agg(
            *[(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in df.columns]
        )
        return counts.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_unique")) for c in df.columns]))
        )
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])
    distinct = df.select(F.inline(entries)).distinct()
    return distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, count, proportion). The counts are stored; the total is a sum over them, not a second scan."""
    counts = cut_lineage(df.groupBy(column).agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("proportion", F.col("count") / total)


def most_frequent(counts: DataFrame, column: str, n: int = 10) -> DataFrame:
    return counts.orderBy(F.col("count").desc(), F.col(column).asc_nulls_first()).limit(n)


def least_frequent(counts: DataFrame, column: str, n: int = 10) -> DataFrame:
    return counts.orderBy(F.col("count").asc(), F.col(column).desc_nulls_last()).limit(n)


def summary(df: DataFrame, *, approximate: bool = False) -> DataFrame:
    """count, null_count, mean, std, min, quartiles and max of every column, dates as day numbers.

    Quartiles are values of the column (nearest rank). ``approximate`` takes them from one sketch
    pass; the exact form needs a few scans of the numeric columns, which are stored once.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = cut_lineage(df.select(*[as_number(c, t).alias(c) for c, t in types.items()]))
    probabilities = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    exact = {} if approximate else exact_quantiles(numbers, numbers.columns, list(probabilities.values()))

    def quantile(c: str, p: float):
        value = F.percentile_approx(c, p, 10_000) if approximate else F.lit(exact[c, p])
        return value.cast("double")

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            *[quantile(c, p).alias(name) for name, p in probabilities.items()],
            F.max(c).alias("max"),
        )
        for c in numbers.columns
    ]
    return numbers.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def filtered_total(df: DataFrame, column: str = QUANTITY, **equal_to: object) -> DataFrame:
    """Sum of ``column`` over the rows whose named columns equal the given values."""
    test = reduce(lambda a, b: a & b, (F.col(c) == F.lit(v) for c, v in equal_to.items()), F.lit(True))
    return df.where(test).agg(F.sum(column).alias(column))


def undefined_dates(df: DataFrame, column: str) -> DataFrame:
    """Distinct dates on which ``column`` is null."""
    return df.where(F.col(column).isNull()).select(DATE).distinct()


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size, mean price and mean quantity of each cluster."""
    return clustered.groupBy(CLUSTER).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg(PRICE).alias("mean_price"),
        F.avg(QUANTITY).alias("mean_quantity"),
    )


def ordered(df: DataFrame, columns: Sequence[str], *, descending: bool = False) -> DataFrame:
    """Sorted output, nulls first in either direction."""
    return df.orderBy(
        *[F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_first() for c in columns]
    )
