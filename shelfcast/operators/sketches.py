"""Profiles of any range of dates from small states a day: counts, and sketches that merge."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.operators.refresh import MONTH, month_of, months_of, read_months, replace_months
from shelfcast.schema import DATE
from shelfcast.session import cut_lineage

#: Accuracy of the sketches: the logarithm of the registers for distinct values (1.04 / sqrt(2 ** 12) is 1.6 %), and
#: the size of the quantile sketch (ranks within about 1.3 % of the rows).
REGISTERS, RANKS = 12, 200

#: Values that the sketch of the most frequent ones follows, and how many are reported.
FOLLOWED, REPORTED = 1000, 10


def day_states(df: DataFrame, columns: Sequence[str], date: str = DATE) -> DataFrame:
    """(date, column, n_rows, n_null, distinct, quantiles, frequent) for every day and column, in one aggregate.

    Tasks build the sketches of their own rows, so a day with most of the rows sends one state a task and
    column. Quantiles are those of the column as a double; other columns have none.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    states = []
    for c in columns:
        value = F.col(f"`{c}`")
        numeric = isinstance(types[c], (T.NumericType, T.BooleanType))
        double = value.cast("int").cast("double") if isinstance(types[c], T.BooleanType) else value.cast("double")
        text = value.cast("string")
        quantiles = F.kll_sketch_agg_double(double, RANKS) if numeric else F.lit(None).cast("binary")
        states.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(value.isNull()).alias("n_null"),
                F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(text)), REGISTERS).alias("distinct"),
                quantiles.alias("quantiles"),
                F.call_function("approx_top_k_accumulate", text, F.lit(FOLLOWED)).alias("frequent"),
            )
        )
    days = df.where(F.col(date).isNotNull()).groupBy(F.col(date).alias(DATE)).agg(F.array(*states).alias("states"))
    return days.select(DATE, F.inline("states"))


def store_days(df: DataFrame, path: str, columns: Sequence[str], date: str = DATE) -> None:
    """Add the states of the days of ``df``, or put them in the place of those stored for the same days.

    Only these days' rows are read; of what is stored, the states of the months they lie in.
    """
    states = cut_lineage(day_states(df, columns, date).withColumn(MONTH, month_of(F.col(DATE))))
    touched = months_of(states)
    if touched:
        held = read_months(df.sparkSession, path, states.schema, touched).join(states.select(DATE).distinct(), DATE, "left_anti")
        replace_months(held.select(*states.columns).unionByName(states), path, touched)


def profile_between(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None, probabilities: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """(column, n_rows, n_null, n_distinct, quantiles, frequent) over the stored days from ``first`` to ``last``.

    Counts are exact. Distinct values and quantiles are as near as the sketches are, quantiles null for
    columns without numbers; ``frequent`` lists (value, count) of the most frequent values, null among them.
    """
    states = spark.read.parquet(path)
    if first is not None:
        states = states.where((F.col(DATE) >= F.lit(first)) & (F.col(MONTH) >= month_of(F.lit(first))))
    if last is not None:
        states = states.where((F.col(DATE) <= F.lit(last)) & (F.col(MONTH) <= month_of(F.lit(last))))
    merged = states.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("__quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(FOLLOWED)).alias("__frequent"),
    )
    some = (F.col("n_rows") > F.col("n_null")) & F.col("__quantiles").isNotNull()
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("__quantiles", F.lit(float(p))) for p in probabilities])
    numbers = merged.withColumn("__any", F.when(some, F.kll_sketch_get_n_double("__quantiles")))
    return numbers.select(
        "column", "n_rows", "n_null", "n_distinct", F.when(F.col("__any") > 0, quantiles).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("__frequent"), F.lit(REPORTED)).alias("frequent"),
    )
