"""Row selection: null filters, samples, shuffles, splits and unions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from shelfcast.functions.values import all_present, bucket_of_100
from shelfcast.schema import CLUSTER, ROW_ID, TEST_PERCENT


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without nulls. Unlike ``na.drop`` this keeps NaN."""
    return df.where(all_present(columns or df.columns))


def split_by_completeness(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows without nulls, and rows with at least one."""
    complete = all_present(columns or df.columns)
    return df.where(complete), df.where(~complete)


def append_unclustered(clustered: DataFrame, rest: DataFrame) -> DataFrame:
    """Clustered rows followed by the rows that got no cluster."""
    return clustered.unionByName(rest.withColumn(CLUSTER, F.lit(None).cast(T.IntegerType())))


def concat(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def shuffled(df: DataFrame, row_key: Sequence[str] = (ROW_ID,), *, seed: int = 42) -> DataFrame:
    """All rows in a repeatable random order."""
    return df.orderBy(F.xxhash64(*row_key, F.lit(seed)), *row_key)


def sample_keys(df: DataFrame, key: str, n: int = 20, *, seed: int = 42) -> DataFrame:
    """``n`` distinct keys drawn without replacement, the same ones on every run."""
    rank = F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed))))
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.orderBy(rank, key).limit(n)


def with_test_flag(
    df: DataFrame, row_key: Sequence[str] = (ROW_ID,), *, test_percent: int = TEST_PERCENT, salt: str = ""
) -> DataFrame:
    return df.withColumn("is_test", bucket_of_100(row_key, salt) < F.lit(test_percent))


def split_train_test(
    df: DataFrame,
    row_key: Sequence[str] = (ROW_ID,),
    *,
    test_percent: int = TEST_PERCENT,
    seed: int | None = None,
    flag: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row key: no sort, no row numbers, same rows on every run.

    With ``seed`` Spark's ``randomSplit`` is used instead. ``flag`` names a column of :func:`with_test_flag`, told before
    and left out of the rows, so that the row key need not be kept for it.
    """
    if flag is not None:
        return df.where(~F.col(flag)).drop(flag), df.where(F.col(flag)).drop(flag)
    if seed is not None:
        share = test_percent / 100
        train, test = df.randomSplit([1 - share, share], seed)
        return train, test
    flag = bucket_of_100(row_key) < F.lit(test_percent)
    return df.where(~flag), df.where(flag)


def with_fold(df: DataFrame, folds: int = 3, row_key: Sequence[str] = (ROW_ID,), *, name: str = "fold") -> DataFrame:
    """Fold number 0..folds-1 from a hash of the row key, salted so that it is free of the test flag."""
    return df.withColumn(name, (bucket_of_100(row_key, "fold") % folds).cast("int"))
