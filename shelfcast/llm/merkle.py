"""Merkle manifest of a table: leaf hashes, a tree per group and one over the groups, proofs by windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.ranks import COUNT, INDEX, ranked
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS
from shelfcast.session import cut_lineage

#: Nodes that have a common parent.
ARITY = 2

#: Levels built in one pass: a window then holds at most ARITY ** LEVELS rows, whatever the group.
LEVELS = 10

_GROUP, _BLOCK, _NODE, _PATH = "__group", "__block", "__node", "__path"
_PATHS = "array<struct<before:binary,after:binary>>"
_RESULTS = ("leaf", "index", "path", "subroot", "root")


def digest(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(*values: Column) -> Column:
    """Digest of the values, each as its byte count, a colon and itself; ``-`` for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(F.concat(*[field(v) for v in values]))


def _div(a: Column, b: int) -> Column:
    """Whole quotient of a count that is not negative."""
    return F.call_function("div", a, F.lit(b).cast("long"))


def _hexadecimal(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(_hexadecimal(s["before"]), node, _hexadecimal(s["after"]))))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level and from left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(_hexadecimal(s["before"]), _hexadecimal(s["after"]))), ""))


def _climb(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``levels`` levels above ``nodes`` (group, index, count, node): the same rows, with the node that the
    first row of each block ends with, and the siblings met from every row up to there.

    A node of a level is kept by the row of its first leaf, so its siblings stand a fixed number of rows
    before and after it. Lag and lead columns at these offsets are masked by the slot of the node among its
    siblings and by the length of their run, which is shorter at the end of a level; first-child rows hash
    the parent. On the way back every row takes over the path of its parent's row, again at a fixed lag.
    """
    rows = nodes.withColumn(_BLOCK, _div(F.col(INDEX), arity**levels))
    window = Window.partitionBy(_GROUP, _BLOCK).orderBy(INDEX)
    none, slots, active = F.lit(""), [], []
    for level in range(levels):
        step = arity**level
        width, place = _div(F.col(COUNT) + (step - 1), step), _div(F.col(INDEX), step)
        slot = place % arity
        slots.append(slot)
        active.append((F.col(INDEX) % step == 0) & (width > 1))
        run = F.least(F.lit(arity).cast("long"), width - (place - slot))
        before = [F.when(slot >= j, F.lag(_NODE, j * step).over(window)).otherwise(none) for j in range(arity - 1, 0, -1)]
        after = [F.when(slot + j < run, F.lead(_NODE, j * step).over(window)).otherwise(none) for j in range(1, arity)]
        rows = rows.withColumns({"__before": F.concat(*before), "__after": F.concat(*after)})
        siblings = F.struct(F.unhex("__before").alias("before"), F.unhex("__after").alias("after"))
        parent = F.when(active[-1] & (slot == 0), digest(F.concat(_NODE, "__after"))).otherwise(F.col(_NODE))
        kept = [F.col(c) for c in rows.columns if c not in (_NODE, "__before", "__after")]
        met = F.when(active[-1], F.array(siblings)).otherwise(F.array().cast(_PATHS))
        rows = rows.select(*kept, parent.alias(_NODE), met.alias(f"__siblings_{level}"))
    rows = rows.withColumn(_PATH, F.array().cast(_PATHS))
    for level in reversed(range(levels)):
        inherited = F.col(_PATH)
        for slot in range(1, arity):
            inherited = F.when(slots[level] == slot, F.lag(_PATH, slot * arity**level).over(window)).otherwise(inherited)
        kept = [F.col(c) for c in rows.columns if c not in (_PATH, f"__siblings_{level}")]
        rows = rows.select(*kept, F.concat(f"__siblings_{level}", inherited).alias(_PATH))
    return rows.drop(_BLOCK)


def _trees(leaves: DataFrame, arity: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Leaves (columns of ``leaves``: group, index, count, node and others) with their whole path, and
    (group, node) of the groups' roots.

    Every pass is stored and passes on one row a block of arity ** levels, so there are as many passes as
    the logarithm of the largest group to that base; only the size of that group reaches the driver.
    """
    size = leaves.agg(F.max(COUNT)).first()[0] or 0
    passes, rows = [], leaves
    while size > 1:
        height = 0
        while height < levels and arity**height < size:
            height += 1
        block = arity**height
        climbed = cut_lineage(_climb(rows, arity, height))
        passes.append((climbed, block))
        heads = climbed.where(F.col(INDEX) % block == 0)
        rows = heads.select(
            _GROUP, _div(F.col(INDEX), block).alias(INDEX), _div(F.col(COUNT) + (block - 1), block).alias(COUNT), _NODE
        )
        size = -(-size // block)
    roots = rows.select(_GROUP, _NODE)
    if not passes:
        return leaves.withColumn(_PATH, F.array().cast(_PATHS)), roots
    whole, _ = passes[-1]
    for below, block in reversed(passes[:-1]):
        above = whole.select(F.col(_GROUP), F.col(INDEX).alias("__over"), F.col(_PATH).alias("__rest"))
        joined = below.withColumn("__over", _div(F.col(INDEX), block)).join(above, [_GROUP, "__over"])
        whole = joined.withColumn(_PATH, F.concat(_PATH, "__rest")).drop("__over", "__rest")
    return whole, roots


def manifest(
    leaves: DataFrame,
    group: str,
    order: Sequence[str],
    leaf: str = "leaf",
    *,
    carry: Sequence[str] = (),
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """``carry`` and per row ``leaf``, ``index`` in its group, ``path`` (siblings before and after, binary,
    level by level up to the root of all groups), ``subroot`` of its group and ``root`` of the table.

    Rows of a group ascend by ``order`` (nulls first), ties by their leaf, so that repeated rows are leaves
    of their own. While a level has several nodes, every ``arity`` consecutive ones become the digest of
    their digests; the last run may be shorter, even one node. The roots of the groups, ordered by the text
    of the group in bytes with null first, are the leaves of one more tree. An empty table has no rows. A
    leaf must not be null. Input columns with the names of results are not carried.

    A group's rows are spread by ranges, windows hold at most arity ** levels rows, and the roots of the
    groups come back to their rows by a join that splits large groups.
    """
    kept = [c for c in dict.fromkeys(carry) if c not in _RESULTS]
    names, keys = [f"__carry_{i}" for i in range(len(kept))], [f"__order_{i}" for i in range(len(order))]
    text = F.col(f"`{group}`").cast("string")
    rows = leaves.select(
        F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), text)).alias(_GROUP),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(order, keys)],
        F.col(f"`{leaf}`").alias(_NODE),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)],
    )
    placed = ranked(rows, [_GROUP], [*keys, _NODE]).drop(*keys).withColumn("__leaf", F.col(_NODE))
    tree, subroots = _trees(cut_lineage(placed), arity, levels)
    # One row per group: the number of its leaves comes with its root.
    sizes = tree.where(F.col(INDEX) == 0).select(_GROUP, F.col(COUNT).alias(N_ROWS))
    subroots = cut_lineage(subroots.join(sizes, _GROUP))
    over = subroots.select(F.lit("").alias(_GROUP), F.col(_GROUP).alias("__name"), _NODE, F.col(_NODE).alias("__subroot"), N_ROWS)
    top, root = _trees(cut_lineage(ranked(over, [_GROUP], ["__name"])), arity, levels)
    root = root.select(_GROUP, F.col(_NODE).alias("__root"))
    groups = top.join(root, _GROUP).select(F.col("__name").alias(_GROUP), "__subroot", "__root", F.col(_PATH).alias("__rest"), N_ROWS)
    groups = cut_lineage(groups)
    joined = attach(tree.drop(_NODE, COUNT), groups, [_GROUP], weights=groups)
    return joined.select(
        *[F.col(n).alias(c) for c, n in zip(kept, names)],
        F.col("__leaf").alias("leaf"),
        F.col(INDEX).alias("index"),
        F.concat(_PATH, "__rest").alias("path"),
        F.col("__subroot").alias("subroot"),
        F.col("__root").alias("root"),
    )


def verified(path: Column, leaf: Column, root: Column) -> Column:
    """Whether a leaf with its siblings gives the root."""
    return fold(leaf, path) == root
