"""Places of rows within ordered groups, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.session import cut_lineage

INDEX, COUNT = "__index", "__count"

_AT, _PART = "__at", "__part"


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with its place in the group from 0 (``__index``) and the rows of the group (``__count``).

    ``group`` columns hold no nulls; nulls in ``order`` come first. Rows are dealt out by ranges of group
    and order and sorted there, so a group of any size spreads over tasks. What meets in a window
    afterwards are counts: one row per group and task that holds some of it. Rows that are equal in all
    columns of ``order`` get different places in no promised order: add a unique column where that matters.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    # The task number stands above bit 33 of the number, the place in the task below.
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_AT, F.monotonically_increasing_id())
    stored = cut_lineage(placed)
    part = F.shiftright(_AT, 33).alias(_PART)
    runs = stored.groupBy(*group, part).agg(F.min(_AT).alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole_group = Window.partitionBy(*group)
    before = F.sum("__n").over(whole_group.orderBy(_PART)) - F.col("__n")
    offsets = runs.select(*group, _PART, (before - F.col("__first")).alias("__offset"), F.sum("__n").over(whole_group).alias(COUNT))
    found = stored.select("*", part).join(offsets, [*group, _PART])
    return found.select(*df.columns, (F.col(_AT) + F.col("__offset")).alias(INDEX), COUNT)
