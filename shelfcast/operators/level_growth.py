"""Trees by the rules of MLlib's, grown for many trials and folds at once: a level of all of them is one scan of binned rows."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from shelfcast.operators.binning import BINS, DRAW, LABEL
from shelfcast.operators.blocks import cells, chunks, packed
from shelfcast.operators.tree_growth import Tree, uniform
from shelfcast.session import cut_lineage, new_path, ship

#: Most bins that a byte can number.
MAX_BINS = 256

#: Most bytes of the sums that a task of one scan collects; a level with more nodes takes several scans.
SUMS_BYTES = 64 << 20

#: Rows from which candidates for splits are taken, or the square of the bins if that is more.
CANDIDATE_ROWS = 10000

FOLD = "__fold"

#: Stands for a fold in a table that has none.
_NO_FOLD = 255

_BINNED = StructType([StructField(c, BinaryType()) for c in (BINS, LABEL, FOLD, DRAW)])
_SUMS = StructType([StructField("slot", IntegerType()), StructField("sums", BinaryType())])
_SPLITS = StructType(
    [StructField(c, IntegerType()) for c in ("ask", "feature", "bin")] + [StructField(c, DoubleType()) for c in ("n", "g", "n_left", "g_left")]
)


@dataclass(frozen=True)
class Growth:
    """What the trees of a trial depend on; ``share`` of the rows are drawn for a tree, with replacement or without."""

    trees: int
    depth: int
    boosted: bool = False
    rate: float = 1.0
    node_rows: int = 1
    node_share: float = 0.0
    gain: float = 0.0
    bins: int = 32
    features: int | None = None
    share: float = 1.0
    replace: bool = False
    seed: int = 42


@dataclass
class Ensemble:
    """The trees of a trial that have not seen ``fold``: their mean, or boosted the first plus ``rate`` times the others."""

    fold: int
    growth: Growth
    trees: list[Tree] = field(default_factory=list)

    def arrays(self) -> list[tuple[np.ndarray, ...]]:
        return [t.arrays() for t in self.trees]


@dataclass(frozen=True)
class _Sample:
    number: int
    share: float
    replace: bool

    def weights(self, draw: np.ndarray) -> np.ndarray:
        if not self.replace:
            return (uniform(draw, self.number) < self.share).astype(np.float64)
        counts = np.arange(1.0, 32.0)
        below = np.cumsum(np.exp(-self.share) * np.concatenate([[1.0], np.cumprod(self.share / counts)]))
        return np.searchsorted(below, uniform(draw, self.number), side="right").astype(np.float64)


@dataclass(frozen=True)
class FoldBins:
    """Rows as bins, those of every fold's training rows side by side, and the upper edges of the bins by fold."""

    table: DataFrame
    edges: list[list[np.ndarray]]
    rows: list[int]
    path: str


def split_points(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Middles between neighbouring values, all of them or about ``bins`` - 1 that part the rows evenly."""
    order = np.argsort(values)
    values, counts = values[order], counts[order].astype(np.float64)
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < bins:
        return middles
    chosen, stride = [], counts.sum() / bins
    before, target = counts[0], stride
    for i in range(1, len(values)):
        now = before + counts[i]
        if abs(before - target) < abs(now - target):
            chosen.append(middles[i - 1])
            target += stride
        before = now
    return np.array(chosen)


def fold_edges(rows: DataFrame, columns: Sequence[str], folds: int, bins: int, seed: int) -> tuple[list[list[np.ndarray]], list[int]]:
    """Upper edges of the bins of every column, for the rows outside of every fold, and the numbers of these rows.

    As in MLlib they come from about CANDIDATE_ROWS rows, or all where there are no more; one scan serves all folds.
    """
    sizes = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    outside = [sum(n for f, n in sizes.items() if f != i) for i in range(folds)]
    if min(outside) == 0:
        raise ValueError("no rows outside of a fold")
    shares = [min(1.0, max(bins * bins, CANDIDATE_ROWS) / n) for n in outside]
    drawn = rows.select("fold", F.array(*[F.col(f"`{c}`") for c in columns]).alias("x"), F.rand(seed).alias("u"))
    own = F.array(*[F.when((F.col("fold") != i) & (F.col("u") < s), F.lit(i)) for i, s in enumerate(shares)])
    values = drawn.where(F.col("u") < max(shares)).select(F.explode(F.array_compact(own)).alias("own"), "x").select("own", F.posexplode("x").alias("feature", "x"))

    def cut(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        edges = split_points(found["x"].to_numpy(), found["n"].to_numpy(), min(bins, outside[key[0]]))
        return pd.DataFrame({"own": [key[0]], "feature": [key[1]], "edges": [edges]})

    ship(rows.sparkSession)
    counted = values.groupBy("own", "feature", "x").agg(F.count(F.lit(1)).alias("n"))
    edges = [[np.empty(0)] * len(columns) for _ in range(folds)]
    for r in counted.groupBy("own", "feature").applyInPandas(cut, "own int, feature int, edges array<double>").collect():
        edges[r["own"]][r["feature"]] = np.array(r["edges"], dtype=np.float64)
    return edges, outside


def fold_bins(rows: DataFrame, columns: Sequence[str], label: str, folds: int, bins: int, seed: int) -> FoldBins:
    """The stored bins of ``rows`` in (columns, label, fold): a byte a column and fold, a block of rows a record."""
    edges, outside = fold_edges(rows, columns, folds, bins, seed)
    width = len(columns)
    slim = rows.select(*[F.col(f"`{c}`") for c in columns], F.col(label), F.col("fold"), F.xxhash64(F.monotonically_increasing_id()).alias(DRAW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            *values, known, fold, draw = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            out = np.empty((batch.num_rows, folds * width), dtype=np.uint8)
            for i, own in enumerate(edges):
                for j in range(width):
                    out[:, i * width + j] = np.searchsorted(own[j], values[j])
            blocks = [packed(x) for x in (out, known, fold.astype(np.uint8), draw)]
            yield pa.RecordBatch.from_arrays(blocks, names=_BINNED.fieldNames())

    ship(rows.sparkSession)
    path = new_path(rows.sparkSession, "fold-bins")
    return FoldBins(cut_lineage(slim.mapInArrow(run, _BINNED), path), edges, outside, path)


@dataclass(frozen=True)
class Seen:
    """Number of rows, by column the mean of the present values (0 where there is none) and whether any is missing, and
    about CANDIDATE_ROWS rows, or the square of the bins if that is more; missing values are NaN."""

    rows: int
    means: np.ndarray
    missing: np.ndarray
    drawn: np.ndarray

    def edges(self, flagged: Sequence[int], bins: int) -> list[np.ndarray]:
        """Upper edges of the bins of every column with its mean in place of missing values, then of the 0/1 columns that
        tell where the ``flagged`` columns are missing."""
        columns = _filled(list(self.drawn.T), self.means, flagged)
        return [split_points(*np.unique(x, return_counts=True), min(bins, self.rows)) if len(x) else np.empty(0) for x in columns]


def _filled(columns: Sequence[np.ndarray], means: np.ndarray, flagged: Sequence[int]) -> list[np.ndarray]:
    empty = [np.isnan(x) for x in columns]
    return [np.where(e, m, x) if e.any() else x for x, e, m in zip(columns, empty, means)] + [empty[j].astype(np.float64) for j in flagged]


def _below(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many of the sorted edges are below each value; a few edges are compared one by one, which takes less than a search."""
    if len(edges) > 64:
        return np.searchsorted(edges, values)
    found = np.zeros(len(values), np.uint8)
    for edge in edges.tolist():
        found += values > edge
    return found


def _numbers(columns: Sequence[str]) -> Column:
    """A row's numbers as one array, NaN where missing: a column of arrays reaches Python in less than many columns do."""
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in columns])


def seen_rows(rows: DataFrame, columns: Sequence[str], bins: int, seed: int) -> Seen:
    """What the bins of ``rows`` depend on, from a scan for sums and one for the rows drawn."""
    kinds = dict(rows.dtypes)
    number = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) if kinds[c] in ("double", "float") else F.col(f"`{c}`").cast("double") for c in columns]
    sums = [F.sum(x).alias(f"s{j}") for j, x in enumerate(number)]
    counts = [F.count(x).alias(f"n{j}") for j, x in enumerate(number)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *sums, *counts).first()
    if not found["n"]:
        raise ValueError("no rows to fit")
    share = min(1.0, max(bins * bins, CANDIDATE_ROWS) / found["n"])
    drawn = rows.withColumn(DRAW, F.rand(seed)).where(F.col(DRAW) < share).select(_numbers(columns).alias("x")).toArrow().column("x").combine_chunks()
    known = np.array([found[f"n{j}"] for j in range(len(columns))])
    means = np.array([found[f"s{j}"] / k if k else 0.0 for j, k in enumerate(known)])
    return Seen(found["n"], means, known < found["n"], drawn.flatten().to_numpy().reshape(-1, len(columns)))


def whole_bins(rows: DataFrame, columns: Sequence[str], label: str, seen: Seen, flagged: Sequence[int], bins: int, draws: bool) -> FoldBins:
    """The stored bins of all ``rows`` as a single training set, in which missing values are filled and the ``flagged`` columns
    have a 0/1 column more. Without ``draws`` no row can be drawn for a sample."""
    edges = seen.edges(flagged, bins)
    slim = rows.select(_numbers(columns).alias("x"), F.col(label).cast("double").alias(LABEL), *[F.xxhash64(F.monotonically_increasing_id()).alias(DRAW)] * draws)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, known, *draw = batch.columns
            values = np.ascontiguousarray(numbers.flatten().to_numpy().reshape(-1, len(columns)).T)
            out = np.empty((batch.num_rows, len(edges)), dtype=np.uint8)
            for j, x in enumerate(_filled(values, seen.means, flagged)):
                out[:, j] = _below(edges[j], x)
            draw = packed(draw[0].to_numpy() if draws else np.empty((batch.num_rows, 0)))
            blocks = [packed(out), packed(known.to_numpy()), packed(np.full(batch.num_rows, _NO_FOLD, np.uint8)), draw]
            yield pa.RecordBatch.from_arrays(blocks, names=_BINNED.fieldNames())

    ship(rows.sparkSession)
    path = new_path(rows.sparkSession, "bins")
    return FoldBins(cut_lineage(slim.mapInArrow(run, _BINNED), path), [edges], [seen.rows], path)


def _parts(batch: pa.RecordBatch, across: int) -> Iterator[tuple[np.ndarray, ...]]:
    bins, label, fold, draw = (
        cells(batch.column(batch.schema.get_field_index(c)), t) for c, t in ((BINS, np.uint8), (LABEL, np.float64), (FOLD, np.uint8), (DRAW, np.int64))
    )
    return chunks(bins.reshape(len(label), across), label, fold, draw if len(draw) else np.zeros(len(label), np.int64))


def _training(every: np.ndarray, fold: np.ndarray, i: int, width: int) -> tuple[np.ndarray | slice, np.ndarray]:
    """The rows outside of a fold, and their bins with a row a feature."""
    known = np.flatnonzero(fold != i)
    rows = slice(None) if len(known) == len(fold) else known
    return rows, np.ascontiguousarray(every[rows, i * width : (i + 1) * width].T)


def _leaf(bins: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node in which every row ends; ``bins`` has a row a feature. Whole rows of bins are compared, split by split:
    for trees as deep as those here that takes less than following every row on its own."""
    feature, limit, _, left, right, _ = (a.tolist() for a in tree)

    def below(node: int) -> np.ndarray | np.int32:
        if feature[node] < 0:
            return np.int32(node)
        return np.where(bins[feature[node]] <= limit[node], below(left[node]), below(right[node]))

    found = below(0)
    return found if found.ndim else np.full(bins.shape[1], found)


def _predicted(bins: np.ndarray, trees: Sequence[tuple[np.ndarray, ...]], growth: Growth) -> np.ndarray:
    out = np.zeros(bins.shape[1])
    for i, tree in enumerate(trees):
        out += (growth.rate if growth.boosted and i else 1.0) * tree[-1][_leaf(bins, tree)]
    return out if growth.boosted else out / len(trees)


@dataclass
class _Growing:
    """A tree that has (node, depth, rows) still to be searched. Trees of the same ``origin`` and splits see the same rows and targets."""

    ensemble: Ensemble
    number: int
    tree: Tree
    open: list[tuple[int, int, float]]
    done: list[tuple[np.ndarray, ...]]

    def sample(self) -> _Sample | None:
        g = self.ensemble.growth
        return _Sample(g.seed + self.number, g.share, g.replace) if g.replace or g.share < 1 else None

    def origin(self) -> tuple:
        g = self.ensemble.growth
        return self.ensemble.fold, self.sample(), (g.rate if len(self.done) > 1 else 0, *_key(self.done))


def _key(trees: Sequence[tuple[np.ndarray, ...]]) -> tuple:
    return tuple(tuple(tuple(a.tolist()) for a in t) for t in trees)


@dataclass(frozen=True)
class _Ask:
    """A node whose best split is wanted from the sums of ``slot``."""

    slot: int
    tree: int
    node: int
    depth: int
    least: float
    gain: float
    allowed: list[int] | None


def _searched(sums: np.ndarray, ask: _Ask) -> tuple:
    """(feature, bin, n, g, n left, g left) of the split that lowers the variance most, feature -1 if none may; ties go to
    the first feature and bin."""
    n, g = sums[0, 0].sum(), sums[1, 0].sum()
    left = np.cumsum(sums, axis=2)
    right_n, right_g = n - left[0], g - left[1]
    allowed = np.minimum(left[0], right_n) >= max(ask.least, 1.0)
    if ask.allowed is not None:
        allowed[[j for j in range(len(allowed)) if j not in set(ask.allowed)]] = False
    if not allowed.any():
        return -1, -1, n, g, 0.0, 0.0
    safe = lambda x: np.where(allowed, x, 1.0)
    found = np.where(allowed, (left[1] ** 2 / safe(left[0]) + right_g**2 / safe(right_n) - g * g / n) / n, -np.inf)
    j, b = np.unravel_index(int(found.argmax()), found.shape)
    # A gain within the rounding of the sums is none.
    if found[j, b] < ask.gain or found[j, b] <= 1e-14 * (g / n) ** 2:
        return -1, -1, n, g, 0.0, 0.0
    return int(j), int(b), n, g, float(left[0, j, b]), float(left[1, j, b])


def _scan(rows: FoldBins, bins: int, work: Sequence[tuple[_Growing, dict[int, int]]], asks: Sequence[_Ask]) -> list:
    """The splits asked for, from one scan. ``work`` names trees and the slots of their nodes."""
    folds, width, n_slots = len(rows.edges), len(rows.edges[0]), sum(len(slots) for _, slots in work)
    by_fold: dict[int, list[tuple]] = {}
    for growing, slots in work:
        origin = growing.origin()[2]
        by_fold.setdefault(growing.ensemble.fold, []).append((growing.sample(), growing.done, origin, growing.ensemble.growth, growing.tree.arrays(), slots))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_slots, 2, width, bins))
        for every, label, fold, draw in (part for batch in batches for part in _parts(batch, folds * width)):
            for i, items in by_fold.items():
                known, own = _training(every, fold, i, width)
                y, d, targets, weights = label[known], draw[known], {}, {None: None}
                for sample, done, origin, growth, tree, slots in items:
                    if origin not in targets:
                        # Boosted trees after the first learn twice the residual, which is minus the gradient of the squared error.
                        targets[origin] = 2.0 * (y - _predicted(own, done, growth)) if done else y
                    if sample not in weights:
                        weights[sample] = sample.weights(d)
                    _add(sums, own, tree, slots, targets[origin], weights[sample])
        if sums.any():
            held = [s for s in range(n_slots) if sums[s, 0].any()]
            arrays = [pa.array(held, pa.int32()), pa.array([sums[s].tobytes() for s in held], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=_SUMS.fieldNames())

    wanted: dict[int, list[tuple[int, _Ask]]] = {}
    for place, ask in enumerate(asks):
        wanted.setdefault(ask.slot, []).append((place, ask))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(data.as_buffer(), np.float64).reshape(2, width, bins)
                merged[slot] = merged[slot] + part if slot in merged else part
        out = [(place, *_searched(sums, ask)) for slot, sums in merged.items() for place, ask in wanted[slot]]
        if out:
            arrays = [pa.array(c, pa.int32() if i < 3 else pa.float64()) for i, c in enumerate(zip(*out))]
            yield pa.RecordBatch.from_arrays(arrays, names=_SPLITS.fieldNames())

    ship(rows.table.sparkSession)
    return rows.table.mapInArrow(collect, _SUMS).repartition("slot").mapInArrow(choose, _SPLITS).collect()


def _add(sums: np.ndarray, own: np.ndarray, tree: tuple[np.ndarray, ...], slots: dict[int, int], target: np.ndarray, weight: np.ndarray | None) -> None:
    """Rows and targets of the nodes in ``slots``, by feature and bin; the slots of a tree are numbered one after the other."""
    first, n, bins = min(slots.values()), len(slots), sums.shape[3]
    place = np.full(len(tree[0]), -1)
    place[list(slots)] = [s - first for s in slots.values()]
    at = place[_leaf(own, tree)]
    chosen = np.flatnonzero(at >= 0 if weight is None else (at >= 0) & (weight > 0))
    whole = len(chosen) == len(at)
    base = (at if whole else at[chosen]) * bins
    g, w = target if whole else target[chosen], None if weight is None else weight[chosen]
    g = g if w is None else g * w
    for j, values in enumerate(own):
        cell = base + (values if whole else values[chosen])
        sums[first : first + n, 0, j] += np.bincount(cell, w, n * bins).reshape(n, bins)
        sums[first : first + n, 1, j] += np.bincount(cell, g, n * bins).reshape(n, bins)


def grow(rows: FoldBins, bins: int, growths: Sequence[Growth]) -> list[list[Ensemble]]:
    """By fold the ensembles of all ``growths``, each level of their open trees from one scan (or several, SUMS_BYTES)."""
    made = [[Ensemble(i, g) for g in growths] for i in range(len(rows.edges))]
    width = len(rows.edges[0])
    most = max(1, SUMS_BYTES // (2 * width * bins * 8))

    def begin(ensemble: Ensemble, number: int) -> _Growing:
        tree = Tree()
        return _Growing(ensemble, number, tree, [(tree.add(), 0, float("inf"))], ensemble.arrays() if ensemble.growth.boosted else [])

    growing = [begin(e, t) for own in made for e in own for t in range(1 if e.growth.boosted else e.growth.trees)]
    while growing:
        _level(rows, bins, growing, most)
        following = []
        for one in growing:
            if one.open:
                following.append(one)
                continue
            one.ensemble.trees.append(one.tree)
            if one.ensemble.growth.boosted and len(one.ensemble.trees) < one.ensemble.growth.trees:
                following.append(begin(one.ensemble, one.number + 1))
        growing = following
    return made


def _level(rows: FoldBins, bins: int, growing: Sequence[_Growing], most: int) -> None:
    """Search all open nodes and put their children in their place."""
    width = len(rows.edges[0])
    alike: dict[tuple, list[int]] = {}
    for t, one in enumerate(growing):
        # Trees that agree up to here need their sums once: trials of a fold often share the first levels.
        alike.setdefault((one.origin(), _key([one.tree.arrays()])), []).append(t)
    nodes = [(members, node) for members in alike.values() for node in sorted({n for t in members for n, _, _ in growing[t].open})]
    found: list[tuple[_Ask, object]] = []
    for at in range(0, len(nodes), most):
        slots: dict[int, dict[int, int]] = {}
        asks: list[_Ask] = []
        for slot, (members, node) in enumerate(nodes[at : at + most]):
            slots.setdefault(members[0], {})[node] = slot
            for t in members:
                one, g = growing[t], growing[t].ensemble.growth
                least = max(g.node_rows, g.node_share * rows.rows[one.ensemble.fold])
                few = g.features is not None and g.features < width
                allowed = random.Random(f"{g.seed} {one.number} {node}").sample(range(width), g.features) if few else None
                asks += [_Ask(slot, t, n, depth, least, g.gain, allowed) for n, depth, _ in one.open if n == node]
        answers = _scan(rows, bins, [(growing[t], own) for t, own in slots.items()], asks)
        found += [(asks[r["ask"]], r) for r in answers]
    for one in growing:
        one.open = []
    for ask, r in sorted(found, key=lambda f: (f[0].tree, f[0].node)):
        one = growing[ask.tree]
        tree, growth = one.tree, one.ensemble.growth
        tree.value[ask.node] = r["g"] / r["n"] if r["n"] else 0.0
        if r["feature"] < 0 or ask.depth >= growth.depth:
            continue
        tree.feature[ask.node], tree.bin[ask.node] = r["feature"], r["bin"]
        left, right = (r["n_left"], r["g_left"]), (r["n"] - r["n_left"], r["g"] - r["g_left"])
        tree.left[ask.node], tree.right[ask.node] = (tree.add(g / n) for n, g in (left, right))
        for child, (n, _) in ((tree.left[ask.node], left), (tree.right[ask.node], right)):
            if ask.depth + 1 < growth.depth and n >= 2 * max(1, ask.least):
                one.open.append((child, ask.depth + 1, n))


@dataclass(frozen=True)
class NodeSums:
    """Of a node's rows: how many, and their weight, weighted targets and squares of targets."""

    rows: int
    n: float
    g: float
    squares: float


def node_sums(rows: FoldBins, ensemble: Ensemble) -> list[list[NodeSums]]:
    """By tree and node what its training rows add up to, in one scan."""
    folds, width, i = len(rows.edges), len(rows.edges[0]), ensemble.fold
    arrays, growth = ensemble.arrays(), ensemble.growth
    samples = [_Growing(ensemble, t, tree, [], []).sample() for t, tree in enumerate(ensemble.trees)]
    names = ("held", "n", "g", "squares")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(t[0]), 4)) for t in arrays]
        for every, label, fold, draw in (part for batch in batches for part in _parts(batch, folds * width)):
            known, own = _training(every, fold, i, width)
            y, d, predicted = label[known], draw[known], 0.0
            for t, tree in enumerate(arrays):
                leaf = _leaf(own, tree)
                target = 2.0 * (y - predicted) if growth.boosted and t else y
                weight = np.ones(len(y)) if samples[t] is None else samples[t].weights(d)
                each = (weight > 0, weight, weight * target, weight * target**2)
                sums[t] += np.stack([np.bincount(leaf, x, len(tree[0])) for x in each], axis=1)
                if growth.boosted:
                    predicted = predicted + (growth.rate if t else 1.0) * tree[-1][leaf]
        found = [(t, node, *x) for t, of in enumerate(sums) for node, x in enumerate(of) if x[0]]
        if found:
            kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["tree", "node", *names])

    ship(rows.table.sparkSession)
    schema = "tree int, node int, " + ", ".join(f"{c} double" for c in names)
    whole = [np.zeros((len(t[0]), 4)) for t in arrays]
    for r in rows.table.mapInArrow(collect, schema).groupBy("tree", "node").agg(*[F.sum(c).alias(c) for c in names]).collect():
        whole[r["tree"]][r["node"]] = [r[c] for c in names]
    for (feature, _, _, left, right, _), of in zip(arrays, whole):
        # Children come after their parent.
        for node in reversed(range(len(feature))):
            if feature[node] >= 0:
                of[node] = of[left[node]] + of[right[node]]
    return [[NodeSums(int(x[0]), *map(float, x[1:])) for x in of] for of in whole]


def mean_errors(ensembles: Sequence[Ensemble], rows: FoldBins) -> list[float]:
    """Mean absolute error of ensembles of one fold on the rows of that fold, in one scan."""
    folds, width, fold = len(rows.edges), len(rows.edges[0]), ensembles[0].fold
    every = [(e.arrays(), e.growth) for e in ensembles]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, off = 0, np.zeros(len(every))
        for bins, label, of, _ in (part for batch in batches for part in _parts(batch, folds * width)):
            held = np.flatnonzero(of == fold)
            own, y = np.ascontiguousarray(bins[held, fold * width : (fold + 1) * width].T), label[held]
            n += len(held)
            off += [float(np.abs(_predicted(own, trees, growth) - y).sum()) for trees, growth in every]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *[pa.array([x]) for x in off]], names=["n", *[f"off{i}" for i in range(len(every))]])

    ship(rows.table.sparkSession)
    schema = StructType([StructField("n", LongType()), *[StructField(f"off{i}", DoubleType()) for i in range(len(every))]])
    found = rows.table.mapInArrow(run, schema)
    return list(found.agg(*[F.try_divide(F.sum(f"off{i}"), F.sum("n")) for i in range(len(every))]).first())
