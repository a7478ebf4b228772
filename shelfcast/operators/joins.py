"""Equi-joins of a large table with a table that is unique on the join keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast.schema import N_ROWS, QUANTITY
from shelfcast.session import cut_lineage

# A key with more rows than this is split into parts of about this size.
HOT_ROWS = 1_000_000


def hot_keys(weights: DataFrame, keys: Sequence[str], *, hot_rows: int = HOT_ROWS, path: str | None = None) -> DataFrame:
    """The keys of ``weights`` (keys + n_rows) over ``hot_rows`` and the number of parts each is split into.

    There are at most rows / ``hot_rows`` of them. The list is stored, so Spark knows its bytes and decides
    by them whether to broadcast it.
    """
    parts = F.ceil(F.col(N_ROWS) / F.lit(hot_rows)).cast("int").alias("__parts")
    return cut_lineage(weights.where(F.col(N_ROWS) > hot_rows).select(*keys, parts), path)


def with_part(fact: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``fact`` with the part (``__part``) that a row of a hot key goes to; 0 for other keys."""
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in fact.columns])
    part = F.when(F.col("__parts").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("__parts")).cast("int"))
    return fact.join(hot, list(keys), "left").withColumn("__part", part).drop("__parts")


def with_part_copies(table: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` with every row once for each part (``__part``) of its key."""
    copies = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - F.lit(1))
    return table.join(hot, list(keys), "left").withColumn("__part", F.explode(copies)).drop("__parts")


def attach(
    fact: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    weights: DataFrame | None = None,
    hot: DataFrame | None = None,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``table``, unique on ``keys``, to ``fact``; rows with a null key do not match.

    ``weights`` (keys + n_rows of ``fact``), or the list ``hot`` made from it by :func:`hot_keys`, tells
    which keys are hot. A hot key is spread over several parts: fact rows choose one, the single table row
    is repeated into each. The part comes from the task number and the row's content, so exact copies in
    different tasks spread too, and a task that is run again sends every row to the same part. The plan is
    the same at every size; whether a side is broadcast is left to Spark and the bytes it has seen.

    The parts also keep the joined rows from counting as dealt out by ``keys`` alone, so a grouping that
    follows exchanges partial sums instead of gathering a hot key's rows where they were joined.
    """
    if how not in ("inner", "left"):
        raise ValueError("repeated table rows are only right for inner and left joins")
    keys = list(keys)
    table = table.drop(N_ROWS)
    if weights is None and hot is None:
        return fact.join(table, keys, how)
    hot = hot_keys(weights, keys, hot_rows=hot_rows) if hot is None else hot
    left, right = with_part(fact, hot, keys), with_part_copies(table, hot, keys)
    return left.join(right, [*keys, "__part"], how).drop("__part")


def attach_stored(
    fact: DataFrame, table: DataFrame, keys: Sequence[str], *, weights: DataFrame | None = None, how: str = "inner"
) -> DataFrame:
    """:func:`attach` of a table that is written once first, so Spark knows its bytes before it plans the
    join and does not shuffle ``fact`` for a small one. ``weights`` may be columns of ``table`` itself."""
    stored = cut_lineage(table)
    return attach(fact, stored, keys, weights=stored if weights is table else weights, how=how)


def with_actuals(predicted: DataFrame, actual: DataFrame, keys: Sequence[str], target: str = QUANTITY) -> DataFrame:
    """Inner join of predictions with known values; the known target gets the suffix ``_right``."""
    known = actual.select(*keys, F.col(target).alias(f"{target}_right"))
    return predicted.join(known, list(keys))
