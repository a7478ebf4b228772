"""Null tests, casts and logarithms."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F, types as T


def all_present(columns: Iterable[str]) -> Column:
    """True when no listed column is null. NaN counts as present."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns), F.lit(True))


def natural_log(column: str) -> Column:
    """ln(x) with -inf at zero and NaN below it, where Spark's own ``ln`` gives null."""
    x = F.col(column)
    return F.when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan"))).otherwise(F.ln(x))


def as_integer(column: str, dtype: T.DataType) -> Column:
    """Whole-number view of a column: dates as day numbers, booleans as 0/1, floats truncated."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(column)).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(F.col(column).cast("date")).cast("long")
    return F.col(column).cast("long")


def as_number(column: str, dtype: T.DataType) -> Column:
    """Double view of a column: dates as day numbers, booleans as 0/1."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return as_integer(column, dtype).cast("double")
    return F.col(column).cast("double")


def bucket_of_100(row_key: Iterable[str | Column], salt: str = "") -> Column:
    """A stable bucket 0..99 from the md5 of the row key (and an optional salt text)."""
    text = F.concat_ws("|", *[F.col(c) if isinstance(c, str) else c for c in row_key], F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(100)


def array_mean(array: str | Column) -> Column:
    """Mean of the non-null elements of an array of doubles, null when there is none."""
    present = F.filter(array, lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v), F.size(present))
