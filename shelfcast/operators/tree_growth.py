"""Regression trees grown leaf by leaf from histograms: one aggregate a growth step, best split first."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from shelfcast.operators.binning import BINS, DRAW, LABEL, MISSING, SCORE
from shelfcast.operators.blocks import cells, chunks
from shelfcast.session import ship

#: Leaves whose histograms one pass over the rows collects.
MAX_SLOTS = 128

_PARTIAL = StructType(
    [
        StructField("slot", IntegerType()),
        StructField("feature", IntegerType()),
        StructField("bin", IntegerType()),
        StructField("g", DoubleType()),
        StructField("h", DoubleType()),
        StructField("n", LongType()),
    ]
)


@dataclass(frozen=True)
class Limits:
    """When a leaf may be split, and how its value is shrunk; None: no limit."""

    leaves: int | None = 31
    depth: int | None = None
    split_rows: int = 2
    leaf_rows: int = 20
    leaf_hessian: float = 1e-3
    gain: float = 0.0
    l1: float = 0.0
    l2: float = 0.0

    def shrunk(self, g: float) -> float:
        return np.sign(g) * max(abs(g) - self.l1, 0.0)

    def value(self, g: float, h: float) -> float:
        return float(-self.shrunk(g) / (h + self.l2)) if h + self.l2 > 0 else 0.0


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1. Rows go left up to a bin, missing ones where ``missing_left`` says."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float = 0.0) -> int:
        for column, x in zip((self.feature, self.bin, self.missing_left, self.left, self.right, self.value, self.gain), (-1, -1, False, -1, -1, value, 0.0)):
            column.append(x)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.bin, self.missing_left, self.left, self.right, self.value))


def route(bins: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The leaf of every row."""
    feature, limit, missing_left, left, right, _ = tree
    node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
    while True:
        own = feature[node]
        inner = own >= 0
        if not inner.any():
            return node
        value = bins[rows, np.maximum(own, 0)]
        goes_left = np.where(value == MISSING, missing_left[node], value <= limit[node])
        node = np.where(inner, np.where(goes_left, left[node], right[node]), node)


def uniform(draw: np.ndarray, number: int) -> np.ndarray:
    """A number in [0, 1) for each row's draw, another one for every ``number``."""
    x = draw.view(np.uint64) + np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


#: Chances of fewer than 1, 2, ... draws of a row when as many rows are drawn as there are.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 16.0)])))


def draws(draw: np.ndarray, number: int) -> np.ndarray:
    """How often a row is in a sample with replacement."""
    return np.searchsorted(_POISSON, uniform(draw, number), side="right").astype(np.float64)


@dataclass(frozen=True)
class Sample:
    """Rows of one tree: all, a share without replacement, or (share None) as many with replacement."""

    number: int = 0
    share: float | None = 1.0

    def weights(self, draw: np.ndarray) -> np.ndarray | None:
        if self.share is None:
            return draws(draw, self.number)
        return None if self.share >= 1 else (uniform(draw, self.number) < self.share).astype(np.float64)


def unpack(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    """(bins, label, score, draw) of the rows of a batch of a binned table."""
    bins, label, score, draw = (
        cells(batch.column(batch.schema.get_field_index(c)), t) for c, t in ((BINS, np.uint8), (LABEL, np.float64), (SCORE, np.float64), (DRAW, np.int64))
    )
    return bins.reshape(len(label), width), label, score, draw


def advanced(score: np.ndarray, bins: np.ndarray, trees: Sequence[tuple[np.ndarray, ...]], rate: float) -> np.ndarray:
    for tree in trees:
        score = score + rate * tree[-1][route(bins, tree)]
    return score


def histograms(
    table: DataFrame,
    width: int,
    trees: Sequence[tuple[np.ndarray, ...]],
    samples: Sequence[Sample],
    slots: Sequence[dict[int, int]],
    features: Sequence[Sequence[int]],
    done: Sequence[tuple[np.ndarray, ...]] = (),
    rate: float = 1.0,
    base: float = 0.0,
) -> DataFrame:
    """(slot, feature, bin, g, h, n): sums over the rows of the wanted leaves, of ``trees`` that are growing.

    ``slots`` names the wanted leaves of each tree. Gradients are those of the squared error at the row's
    score, to which ``base`` and ``rate`` times the trees of ``done`` are added. A task adds up its rows in arrays and hands on sums alone.
    """
    ship(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_slots = sum(map(len, slots))
        sums = np.zeros((3, n_slots, width, MISSING + 1))
        for bins, label, score, draw in (part for batch in batches for part in chunks(*unpack(batch, width))):
            gradient = advanced(score + base, bins, done, rate) - label
            for tree, sample, wanted, allowed in zip(trees, samples, slots, features):
                if not wanted:
                    continue
                slot_of = np.full(len(tree[0]), -1)
                slot_of[list(wanted)] = list(wanted.values())
                slot, weight = slot_of[route(bins, tree)], sample.weights(draw)
                chosen = np.flatnonzero(slot >= 0 if weight is None else (slot >= 0) & (weight > 0))
                own, w = slot[chosen], np.ones(len(chosen)) if weight is None else weight[chosen]
                g = gradient[chosen] * w
                for j in allowed:
                    cell = own * (MISSING + 1) + bins[chosen, j]
                    for part, values in enumerate((g, w, None)):
                        sums[part, :, j] += np.bincount(cell, values, n_slots * (MISSING + 1)).reshape(n_slots, -1)
        slot, feature, bin_ = np.nonzero(sums[2])
        if len(slot):
            g, h, n = (sums[part][slot, feature, bin_] for part in range(3))
            arrays = [pa.array(x.astype(t)) for x, t in zip((slot, feature, bin_, g, h, n), ("i4", "i4", "i4", "f8", "f8", "i8"))]
            yield pa.RecordBatch.from_arrays(arrays, names=_PARTIAL.fieldNames())

    return table.select(BINS, LABEL, SCORE, DRAW).mapInArrow(run, _PARTIAL)


def split_search(sums: np.ndarray, limits: Limits) -> tuple[float, int, bool, np.ndarray] | None:
    """(gain, bin, missing rows left, sums on the left) of the best split of one leaf by one feature, or None.

    ``sums`` holds g, h and n of every bin. Running sums give both sides of every split, with the missing
    rows (if there are any) on either. Ties go to the lowest bin, then to missing rows on the right.
    """
    total, missing = sums.sum(axis=1), sums[:, MISSING]
    present = np.flatnonzero(sums[2, :MISSING] > 0)
    up_to = np.cumsum(sums[:, :MISSING], axis=1)[:, present]

    def gain(part: np.ndarray) -> np.ndarray:
        shrunk, below = np.maximum(np.abs(part[0]) - limits.l1, 0.0), part[1] + limits.l2
        return np.where(below > 0, shrunk * shrunk / np.where(below > 0, below, 1.0), 0.0)

    best = None
    for missing_left in (False, True) if missing[2] > 0 else (False,):
        left = up_to + missing[:, None] if missing_left else up_to
        right = total[:, None] - left
        better = gain(left) + gain(right) - gain(total[:, None])
        least = max(1, limits.leaf_rows)
        allowed = (np.minimum(left[2], right[2]) >= least) & (np.minimum(left[1], right[1]) >= limits.leaf_hessian)
        better = np.where(allowed & (better > limits.gain), better, -np.inf)
        if len(better) and better.max() > (best[0] if best else -np.inf):
            at = int(better.argmax())
            best = float(better[at]), int(present[at]), missing_left, left[:, at]
    return best if total[2] >= limits.split_rows else None


_FOUND = StructType(
    [StructField(n, IntegerType()) for n in ("slot", "feature")]
    + [StructField(n, DoubleType()) for n in ("g", "h", "n", "gain", "bin", "missing_left", "g_left", "h_left", "n_left")]
)


def best_splits(partial: DataFrame, limits: Limits) -> list[dict]:
    """Per slot its totals (g, h, n) and its best split, None where none is allowed.

    The tasks' sums are exchanged once, by slot and feature, and searched where they meet. What reaches the
    driver is a row a slot and feature. Ties go to the first feature.
    """
    ship(partial.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            slot, feature, bin_, *parts = (c.to_numpy() for c in batch.columns)
            key = slot.astype(np.int64) << 32 | feature
            for own in np.unique(key):
                rows = np.flatnonzero(key == own)
                sums = merged.setdefault((int(own >> 32), int(own & 0xFFFFFFFF)), np.zeros((3, MISSING + 1)))
                for part, values in zip(sums, parts):
                    part += np.bincount(bin_[rows], values[rows], MISSING + 1)
        out = []
        for (slot, feature), sums in merged.items():
            found = split_search(sums, limits)
            split = (float("nan"),) * 6 if found is None else (found[0], found[1], found[2], *found[3])
            out.append((slot, feature, *sums.sum(axis=1), *split))
        if out:
            columns = [pa.array(c, pa.int32() if i < 2 else pa.float64()) for i, c in enumerate(zip(*out))]
            yield pa.RecordBatch.from_arrays(columns, names=_FOUND.fieldNames())

    best: dict[int, dict] = {}
    rows = partial.repartition("slot", "feature").mapInArrow(run, _FOUND).collect()
    for row in sorted(rows, key=lambda r: (r["slot"], r["feature"])):
        own = best.setdefault(row["slot"], {"slot": row["slot"], "total": (row["g"], row["h"], int(row["n"])), "best": None})
        if not np.isnan(row["gain"]) and (own["best"] is None or row["gain"] > own["best"]["gain"]):
            own["best"] = {
                "gain": row["gain"], "feature": row["feature"], "bin": int(row["bin"]), "missing_left": bool(row["missing_left"]),
                "g": row["g_left"], "h": row["h_left"], "n": int(row["n_left"]),
            }
    return list(best.values())


@dataclass
class _Node:
    """A leaf, or a split that may still be taken back: best-first choice works on what is known already."""

    number: int
    depth: int
    g: float = 0.0
    h: float = 0.0
    n: int = 0
    split: object = None
    searched: bool = False
    children: tuple[_Node, _Node] | None = None


def grow(look: Callable[[list[Tree], list[dict[int, int]]], list[dict]], n_trees: int, limits: Limits) -> list[Tree]:
    """``n_trees`` trees, growing together; ``look`` gives (total, best) of the wanted leaves, by slot.

    The leaf with the greatest gain is split first, until the limit of leaves. Which leaf that is can be
    told only when the leaves made by the last split have been searched, so each pass searches the children
    of all leaves that could still be reached; there are about as many passes as the trees are deep, and
    the result is that of one split at a time.
    """
    trees = [Tree() for _ in range(n_trees)]
    roots = [_Node(t.add(), 0) for t in trees]
    most = limits.leaves or 1 << 62

    def searchable(node: _Node) -> bool:
        deep = limits.depth is not None and node.depth >= limits.depth
        return not deep and node.n >= max(limits.split_rows, 2 * max(1, limits.leaf_rows))

    def search(wanted: list[tuple[int, _Node]]) -> None:
        for at in range(0, len(wanted), MAX_SLOTS):
            part = wanted[at : at + MAX_SLOTS]
            slots: list[dict[int, int]] = [{} for _ in trees]
            for slot, (t, node) in enumerate(part):
                slots[t][node.number] = slot
            for row in look(trees, slots):
                node = part[row["slot"]][1]
                node.g, node.h, node.n = row["total"]
                node.split = row["best"]
        for _, node in wanted:
            node.searched = True

    def expand(t: int, node: _Node) -> list[tuple[int, _Node]]:
        tree, split = trees[t], node.split
        left = _Node(tree.add(), node.depth + 1, split["g"], split["h"], split["n"])
        right = _Node(tree.add(), node.depth + 1, node.g - split["g"], node.h - split["h"], node.n - split["n"])
        tree.feature[node.number], tree.bin[node.number] = split["feature"], split["bin"]
        tree.missing_left[node.number], tree.gain[node.number] = split["missing_left"], split["gain"]
        tree.left[node.number], tree.right[node.number] = left.number, right.number
        node.children = (left, right)
        return [(t, child) for child in node.children if searchable(child)]

    def choose(t: int) -> tuple[set[int], list[_Node]]:
        """(splits taken, splits to look behind before the choice can go on)."""
        taken, queue = set(), []

        def offer(node: _Node) -> None:
            if node.split is not None:
                heapq.heappush(queue, (-node.split["gain"], node.number, node))

        offer(roots[t])
        while queue and len(taken) + 1 < most:
            _, _, node = queue[0]
            if node.children is None:
                room = most - len(taken) - 1
                return taken, [x for _, _, x in heapq.nsmallest(min(room, len(queue)), queue) if x.children is None]
            heapq.heappop(queue)
            taken.add(node.number)
            for child in node.children:
                offer(child)
        return taken, []

    search([(t, root) for t, root in enumerate(roots)])
    if limits.depth == 0:
        for root in roots:
            root.split = None
    while True:
        fresh: list[tuple[int, _Node]] = []
        waiting = False
        for t in range(n_trees):
            for node in choose(t)[1]:
                waiting = True
                fresh += expand(t, node)
        if not waiting:
            break
        search(fresh)
    return [_finished(roots[t], choose(t)[0], trees[t], limits) for t in range(n_trees)]


def _finished(root: _Node, taken: set[int], grown: Tree, limits: Limits) -> Tree:
    """The tree of the splits taken, its leaves valued."""
    out = Tree()
    pending = [(root, out.add())]
    while pending:
        node, place = pending.pop()
        out.value[place] = limits.value(node.g, node.h)
        if node.number in taken:
            out.feature[place], out.bin[place] = grown.feature[node.number], grown.bin[node.number]
            out.missing_left[place], out.gain[place] = grown.missing_left[node.number], grown.gain[node.number]
            out.left[place], out.right[place] = out.add(), out.add()
            pending += [(node.children[0], out.left[place]), (node.children[1], out.right[place])]
    return out
