"""SimHash near-duplicates: fingerprints, segment-popcount grid, exact links, groups."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField

from shelfcast.llm.arrow import map_column
from shelfcast.llm.components import connected_components
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS
from shelfcast.session import cut_lineage

SEED = 42
BITS = 64

#: Hashes whose bits are counted together.
_CHUNK = 1 << 16

#: A grid cell with more points than this is linked through common neighbours instead of by pairs.
MAX_CELL = 16

_ROW, _FINGERPRINT = "__row", "__fingerprint"


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits that are set in over half the hashes of the word shingles, as a signed 64-bit number.

    A-Z are lower-cased, words are separated by ASCII spaces and joined by one; a text with fewer words
    than a shingle is one shingle, one without words has no bits.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        parts = zip(*[words[i:] for i in range(shingle)])
        hashes = [xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in parts]
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at : at + _CHUNK], dtype="<u8")
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(df: DataFrame, text: str, carry: Sequence[str], shingle: int) -> DataFrame:
    def make():
        return lambda texts: [pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())]

    return map_column(df, text, carry, [StructField(_FINGERPRINT, LongType())], make)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def embedding(bits: Column) -> Column:
    """Bit counts of the 32 two-bit segments, written in unary (0, 1, 3): the Manhattan distance of two
    embeddings is the bit count of their exclusive or, and never more than the distance in bits."""
    even = F.lit(0x5555555555555555)
    above = F.shiftrightunsigned(bits, 1)
    one = bits.bitwiseOR(above).bitwiseAND(even)
    two = bits.bitwiseAND(above).bitwiseAND(even)
    return one.bitwiseOR(F.shiftleft(two, 1))


def grid_masks(max_bits: int) -> list[int]:
    """Masks over an embedding: coordinates in ``max_bits + 3`` groups, each mask leaving out ``max_bits``.

    A Manhattan distance of ``max_bits`` changes at most so many groups, so two points in reach agree
    exactly under some mask.
    """
    groups = max_bits + 3
    edges = [2 * round(i * BITS / 2 / groups) for i in range(groups + 1)]
    ranges = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(ranges, groups - max_bits)]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint_links(prints: DataFrame, max_bits: int, max_cell: int = MAX_CELL) -> DataFrame:
    """(u, v): links that join all the distinct ``prints`` (column fp) within ``max_bits`` bits of each other.

    A grid range join: every point stands in one cell per mask, cells with company are joined to
    themselves, kept if the Manhattan distance of the embeddings allows it and then if the bits do. A
    crowded cell would give the square of its points. Its points instead meet at every number within
    ``max_bits // 2`` bits of them: two prints within an even ``max_bits`` share such a meeting point, and
    whoever shares one is within ``max_bits``. At most a fixed number of prints can share one, so each is
    linked to the least of them there. Both ways are exact, and pairs in both kinds of cells are met.
    """
    if max_bits % 2:
        raise ValueError("meeting points need an even number of bits")
    e = embedding(F.col("fp"))
    masks = F.array(*[F.struct(F.lit(i).alias("grid"), F.lit(m).alias("mask")) for i, m in enumerate(grid_masks(max_bits))])
    points = prints.select("fp", e.alias("e"), F.explode(masks).alias("m")).select(
        "fp", "e", F.col("m.grid").alias("grid"), F.col("e").bitwiseAND(F.col("m.mask")).alias("cell")
    )
    crowd = points.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(points.join(crowd, ["grid", "cell"]))
    few = shared.where(F.col("n") <= max_cell)
    a, b = few.alias("a"), few.alias("b")
    same_cell = (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp"))
    close = (distance(F.col("a.e"), F.col("b.e")) <= max_bits) & (distance(F.col("a.fp"), F.col("b.fp")) <= max_bits)
    pairs = a.join(b, same_cell & close).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))

    flips = [0] + [_signed(sum(1 << i for i in c)) for k in range(1, max_bits // 2 + 1) for c in combinations(range(BITS), k)]
    crowded = shared.where(F.col("n") > max_cell).select("fp").distinct()
    meeting = F.explode(F.transform(F.array(*[F.lit(f) for f in flips]), lambda f: f.bitwiseXOR(F.col("fp"))))
    met = crowded.select("fp", meeting.alias("at"))
    met = met.select("fp", F.min("fp").over(Window.partitionBy("at")).alias("least")).where("least <> fp").distinct()
    met = met.where(distance(F.col("fp"), F.col("least")) <= max_bits)
    return pairs.unionByName(met.select(F.col("fp").alias("u"), F.col("least").alias("v")))


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    *,
    shingle: int = 3,
    max_bits: int = 2,
    carry: Sequence[str] = ("doc_id",),
    only_first: bool = False,
) -> DataFrame:
    """``carry``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (least id reachable through
    links of at most ``max_bits`` bits, itself included) and ``is_first`` (one row of each group).

    Rows and fingerprints are written once to the shared folder. Equal fingerprints are one point in the
    search, so copies are never paired with each other. Null and empty texts have fingerprint zero and
    link like others; null ids sort after all others, a group without any has a null ``component_id``;
    repeated rows belong to one group and only one of them is first; an empty table gives no rows. Input
    columns with the names of results are not carried. Rows of a fingerprint that very many have are spread
    over tasks.

    ``only_first`` returns the first row of each group alone, with ``carry`` and ``fingerprint``; what is
    carried then takes no part in the decision.
    """
    added = ("fingerprint", "component_id", "is_first")
    kept = [c for c in dict.fromkeys(carry) if c not in added]
    names = [f"__carry_{i}" for i in range(len(kept))]
    source = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)], F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").alias("__text")
    )
    hashed = with_fingerprints(source, "__text", [*names, "__id"], shingle)
    rows = cut_lineage(hashed.withColumn(_ROW, F.monotonically_increasing_id()).withColumnRenamed(_FINGERPRINT, "fp"))
    first = F.min(F.struct(F.col("__id").isNull().alias("unknown"), F.col("__id").alias("id"), F.col(_ROW).alias("row")))
    prints = cut_lineage(rows.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias(N_ROWS)))
    roots = connected_components(fingerprint_links(prints.select("fp"), max_bits))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "first", N_ROWS, F.coalesce("root", "fp").alias("root"))
    rooted = cut_lineage(rooted)
    groups = rooted.groupBy("root").agg(F.min("first").alias("least"))
    resolved = cut_lineage(rooted.join(groups, "root").select("fp", "least", N_ROWS))
    if only_first:
        # Only numbers meet in the join; the rows to drop are taken out of those stored by their number.
        dropped = attach(rows.select("fp", _ROW), resolved, ["fp"], weights=resolved).where(F.col(_ROW) != F.col("least.row"))
        joined = rows.join(cut_lineage(dropped.select(_ROW)), _ROW, "left_anti")
        return joined.select(*[F.col(n).alias(c) for c, n in zip(kept, names)], _hexadecimal(F.col("fp")).alias("fingerprint"))
    joined = attach(rows, resolved, ["fp"], weights=resolved)
    return joined.select(
        *[F.col(n).alias(c) for c, n in zip(kept, names)],
        _hexadecimal(F.col("fp")).alias("fingerprint"),
        F.col("least.id").alias("component_id"),
        (F.col(_ROW) == F.col("least.row")).alias("is_first"),
    )


def _hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
