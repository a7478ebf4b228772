"""Extendible hashing: split only the buckets that are too large, one hash bit at a time."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.session import cut_lineage

SHARD, DEPTH, SHARD_BYTES, SHARD_ROWS = "shard", "local_depth", "shard_bytes", "shard_rows"
_BITS, _SIZE, _CELL = "__shard_bits", "__shard_size", "__shard_cell"

#: Bits taken from each of the two hashes: 15 hexadecimal digits fit a signed 64-bit number.
HASH_BITS = 60

#: Bits by which the cells of an oversized bucket are refined in one pass over its rows.
STEP_BITS = 8


def _binary(hashed: Column) -> Column:
    return F.lpad(F.conv(F.substring(hashed, 1, HASH_BITS // 4), 16, 2), HASH_BITS, "0")


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])


def hash_bits(df: DataFrame, keys: Sequence[str]) -> Column:
    """The bit string of a row: the hash of its keys, then the hash of its place in ``df``.

    The second part only matters for a key whose rows exceed a shard by themselves.
    """
    return F.concat(
        _binary(F.md5(_key_text(keys))),
        _binary(F.md5(F.monotonically_increasing_id().cast("string"))),
    )


def _prefix(depth: int) -> Column:
    return F.substring(_BITS, 1, depth) if depth else F.lit("")


def _cells(rows: DataFrame, depth: int) -> DataFrame:
    """Bytes and rows per prefix of ``depth`` bits, with the range of bit strings inside."""
    return rows.groupBy(_prefix(depth).alias(_CELL)).agg(
        F.sum(_SIZE).alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min(_BITS).alias("low"), F.max(_BITS).alias("high")
    )


def assign_shards(df: DataFrame, keys: Sequence[str], size: Column, max_bytes: int) -> DataFrame:
    """``df`` with the shard of every row: ``shard`` (its hash prefix as bits), ``local_depth`` (their
    number), ``shard_bytes`` and ``shard_rows``.

    A bucket splits on one more bit while it holds over ``max_bytes`` bytes and more than one row, so
    every shard keeps to the limit unless a single row is larger; such a row is alone in its shard.
    Rows of a key stay together unless the key alone exceeds the limit.

    Rows and sizes are written once to the shared folder, so every pass sees the same bits. The passes
    sum sizes by prefix inside each task; only a cell that is still too large is read again with more
    bits. Depths are then read off the sums of all prefixes, from the longest to the empty one.

    Null keys share the hash of a marker, null sizes count 0, repeated rows are rows of their own, an
    empty table gives an empty result, and input columns with the names of results are replaced.
    """
    added = (SHARD, DEPTH, SHARD_BYTES, SHARD_ROWS)
    kept = [c for c in df.columns if c not in added]
    sized = df.withColumn(_SIZE, F.coalesce(size.cast("long"), F.lit(0))).withColumn(_BITS, hash_bits(df, keys))
    rows = cut_lineage(sized.select(*[F.col(f"`{c}`") for c in kept], _SIZE, _BITS))
    slim = rows.select(_SIZE, _BITS)

    total = slim.agg(F.sum(_SIZE)).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(total, 1) / max_bytes))) + 2
    levels: list[tuple[int, DataFrame]] = []
    pending = slim
    while True:
        cells = cut_lineage(_cells(pending, depth))
        too_large = (F.col("bytes") > max_bytes) & (F.col("rows") > 1)
        rest = cells.where(too_large)
        # The lowest bit on which any oversized cell still differs: a lone hot key skips its equal bits.
        spread = rest.agg(
            F.min(F.array_position(F.zip_with(F.split("low", ""), F.split("high", ""), lambda a, b: a != b), True)).alias("bit"),
            F.count(F.lit(1)).alias("n"),
        ).first()
        if not spread["n"] or depth >= 2 * HASH_BITS:
            levels.append((depth, cells))
            break
        levels.append((depth, cells.where(~too_large)))
        pending = pending.join(rest.select(_CELL), _prefix(depth) == F.col(_CELL), "left_semi")
        first_difference = spread["bit"] or 2 * HASH_BITS
        depth = min(2 * HASH_BITS, max(depth, first_difference - 1) + STEP_BITS)

    leaves = reduce(DataFrame.unionByName, [cells.select(_CELL, "bytes", "rows") for _, cells in levels])
    prefixes = F.explode(F.transform(F.sequence(F.lit(0), F.length(_CELL)), lambda n: F.substring(F.col(_CELL), F.lit(1), n)))
    by_prefix = leaves.select(_CELL, "bytes", "rows", prefixes.alias(SHARD))
    sums = by_prefix.groupBy(SHARD).agg(F.sum("bytes").alias(SHARD_BYTES), F.sum("rows").alias(SHARD_ROWS))
    fits = sums.where((F.col(SHARD_BYTES) <= max_bytes) | (F.col(SHARD_ROWS) == 1) | (F.length(SHARD) == 2 * HASH_BITS))
    shortest = F.min(F.struct(F.length(SHARD).alias(DEPTH), SHARD, SHARD_BYTES, SHARD_ROWS))
    directory = cut_lineage(
        by_prefix.select(_CELL, SHARD)
        .join(fits, SHARD)
        .groupBy(_CELL)
        .agg(shortest.alias("best"))
        .select(_CELL, *[f"best.{c}" for c in added])
    )
    parts = []
    for depth, _ in levels:
        at_depth = directory.where(F.length(_CELL) == depth)
        parts.append(rows.join(at_depth, _prefix(depth) == F.col(_CELL)).select(*[F.col(f"`{c}`") for c in kept], *added))
    return reduce(DataFrame.unionByName, parts)


def shard_directory(assigned: DataFrame) -> DataFrame:
    """One row per shard: prefix, depth, bytes and rows. A key's shard is the only prefix of its bits."""
    return assigned.groupBy(SHARD).agg(*[F.max(c).alias(c) for c in (DEPTH, SHARD_BYTES, SHARD_ROWS)])
