"""Equal-width histograms over whole-number views of the columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.values import as_integer
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS, QUANTITY
from shelfcast.session import cut_lineage


def _log2_bins(n: Column) -> Column:
    """floor(log2(n)) + 1 as the length of n in binary, exact at powers of two."""
    return F.length(F.bin(n))


def _bin_of(x: Column, lo: Column, hi: Column, bins: Column) -> Column:
    """Equal-width bin 0..bins-1 of lo < hi, the last one closed."""
    position = (x - lo).cast("double") / (hi - lo).cast("double") * bins
    return F.least(F.floor(position), bins.cast("long") - F.lit(1)).cast("int")


def column_histograms(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, bin, n, lo, hi) with floor(log2 rows)+1 bins per column, two for two-valued columns.

    One pass takes minimum, maximum and row count, a single row that is read at once; a second bins
    every row inside its task, so the exchange carries only (column, bin) counts. Nulls are not
    counted, but a null is a value when deciding whether a column has two of them. A constant column
    has one bin.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(columns or df.columns)
    whole = df.select(*[as_integer(c, types[c]).alias(c) for c in columns])
    limits = whole.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    bins = limits["__rows"].bit_length()
    ends = [(limits[f"lo_{c}"], limits[f"hi_{c}"]) for c in columns]

    def code(c: str, lo: int | None, hi: int | None) -> Column:
        """Twice the bin number, plus one for a value strictly between the ends; null for null."""
        x = F.col(c)
        if lo is None or lo == hi:
            return F.when(x.isNotNull(), F.lit(0))
        inner = ((x > F.lit(lo)) & (x < F.lit(hi))).cast("int")
        return _bin_of(x, F.lit(lo), F.lit(hi), F.lit(bins)) * F.lit(2) + inner

    codes = F.array(*[code(c, *e) for c, e in zip(columns, ends, strict=True)])
    counted = (
        whole.select(F.posexplode(codes).alias("position", "code"))
        .groupBy("position", "code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # From here on there are at most 130 rows per column.
    of_column = Window.partitionBy("position")
    many = F.max(F.coalesce(F.col("code") % 2, F.lit(1))).over(of_column) == 1
    constant = F.array(*[F.lit(lo == hi) for lo, hi in ends])[F.col("position")]
    place = F.floor(F.col("code") / 2).cast("int")
    return (
        counted.withColumn("bin", F.when(many | constant, place).otherwise(F.signum(place).cast("int")))
        .where(F.col("code").isNotNull())
        .groupBy("position", "bin")
        .agg(F.sum("n").alias("n"))
        .select(
            F.array(*[F.lit(c) for c in columns])[F.col("position")].alias("column"),
            "bin",
            "n",
            *[
                F.array(*[F.lit(e[i]).cast("long") for e in ends])[F.col("position")].alias(name)
                for i, name in enumerate(("lo", "hi"))
            ],
        )
    )


def grouped_histogram(
    df: DataFrame, key: str, column: str = QUANTITY, *, bins: int | None = None
) -> DataFrame:
    """(key, bin, n) of ``column`` per key; floor(log2 rows)+1 bins when ``bins`` is not given.

    Rows are first reduced to distinct (key, value) counts inside each task, so a key with a third of
    all rows only costs its distinct values; the per-key limits are joined back with hot keys split.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    value = as_integer(column, types[column]).alias("__value")
    # Stored, as it gives the limits, the weights of the join and the rows that are placed.
    reduced = cut_lineage(df.where(F.col(key).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n")))
    limits = reduced.groupBy(key).agg(
        F.min("__value").alias("__lo"),
        F.max("__value").alias("__hi"),
        F.sum("__n").alias("__rows"),
        F.count(F.lit(1)).alias(N_ROWS),
    )
    count = F.lit(bins) if bins else _log2_bins(F.col("__rows"))
    placed = attach(reduced.where(F.col("__value").isNotNull()), limits, [key], weights=limits.select(key, N_ROWS))
    lo, hi = F.col("__lo"), F.col("__hi")
    place = F.when(lo == hi, F.lit(0)).otherwise(_bin_of(F.col("__value"), lo, hi, count))
    return (
        placed.select(key, place.alias("bin"), "__n")
        .groupBy(key, "bin")
        .agg(F.sum("__n").alias("n"))
    )
