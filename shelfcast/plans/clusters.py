"""K-means clusters of complete feature rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.operators.blocks import cells, chunks, packed
from shelfcast.operators.points import Points, store_points
from shelfcast.schema import CLUSTER, NUM_CLUSTERS, QUANTITY
from shelfcast.session import cut_lineage, drop_path, ship

_POINTS = "__points"

_HELPERS = ("__complete", "__raw", "__scaled", "__cluster")


def clustering_features(df: DataFrame, exclude: Sequence[str] = (QUANTITY, CLUSTER)) -> list[str]:
    """Every numeric or boolean column but the excluded ones, ids included as plain numbers."""
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def _vector_stages(features: Sequence[str]) -> list:
    """Doubles, a completeness flag and the standardised vector; incomplete rows pass through as zeros."""
    number = {c: f"CAST(`{c}` AS DOUBLE)" for c in features}
    complete = " AND ".join(f"({x} IS NOT NULL AND NOT isnan({x}))" for x in number.values())
    filled = ", ".join(f"coalesce(nanvl({x}, 0D), 0D) AS `__in_{c}`" for c, x in number.items())
    return [
        SQLTransformer(statement=f"SELECT *, {complete} AS __complete, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__in_{c}" for c in features], outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True),
    ]


def _complete_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    tests = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features]
    keep = tests[0]
    for t in tests[1:]:
        keep &= t
    return df.where(keep)


def fit_clusters(
    df: DataFrame, features: Sequence[str] | None = None, *, k: int = NUM_CLUSTERS, seed: int = 42
) -> PipelineModel:
    """Scaler and k-means fitted on the complete rows, kept together so that serving scales as training did.

    The models are MLlib's; their fit, which keeps every row as objects, is done by scans of points stored in blocks: first
    centres by k-means||, then Lloyd steps.
    """
    features = list(features or clustering_features(df))
    cluster = f"SELECT *, CASE WHEN __complete THEN __cluster END AS {CLUSTER} FROM __THIS__"
    *inputs, scaler = _vector_stages(features)
    means = KMeans(k=k, seed=seed, featuresCol="__scaled", predictionCol="__cluster")
    spark = df.sparkSession
    points = store_points(_complete_rows(df, features), features, seed)
    centres, cost, steps = _k_means(points, k, seed, means.getInitSteps(), means.getMaxIter(), means.getTol())
    drop_path(spark, points.path)
    ml = spark._jvm.org.apache.spark.ml
    dense = lambda kind, x: kind(_java_doubles(spark, x))
    scaling = ml.feature.StandardScalerModel(scaler.uid, dense(ml.linalg.DenseVector, points.std), dense(ml.linalg.DenseVector, points.mean))
    old = spark._jvm.org.apache.spark.mllib
    found = spark.sparkContext._gateway.new_array(old.linalg.Vector, len(centres))
    for i, c in enumerate(centres):
        found[i] = dense(old.linalg.DenseVector, c)
    grouping = ml.clustering.KMeansModel(means.uid, old.clustering.KMeansModel(found, "euclidean", float(cost), steps))
    return PipelineModel([*inputs, _as_fitted(scaler, scaling), _as_fitted(means, grouping), SQLTransformer(statement=cluster)])


def _java_doubles(spark: SparkSession, values: np.ndarray) -> JavaObject:
    out = spark.sparkContext._gateway.new_array(spark._jvm.double, len(values))
    for i, x in enumerate(values.tolist()):
        out[i] = x
    return out


def _as_fitted(estimator: Estimator, made: JavaObject) -> Model:
    """MLlib's model ``made``, with the settings of the estimator."""
    estimator._transfer_params_to_java()
    made.setParent(estimator._java_obj)
    model = estimator._copyValues(estimator._create_model(made))
    model._transfer_params_to_java()
    return model


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (centre, point) without the points' own squares."""
    return (centres**2).sum(axis=1)[:, None] - 2 * centres @ x


def _first_centres(points: Points, k: int, seed: int, steps: int) -> np.ndarray:
    """k-means||: every step draws about 2 ``k`` points, far ones with a greater chance; ``k`` centres are chosen among them
    by the number of points they are nearest to."""
    width, scale = points.width, np.divide(1.0, points.std, out=np.zeros(points.width), where=points.std > 0)
    centres = ((points.pick - points.mean) * scale)[None, :]
    # The sum of squared distances from the first centre follows from the moments.
    total = points.rows * float((centres**2).sum()) + (points.rows - 1) * float((scale > 0).sum())

    def cost(blocks: Iterator[np.ndarray], _: np.random.Generator) -> np.ndarray:
        return np.array([sum(np.maximum((x**2).sum(axis=0) + _distances(x, centres).min(axis=0), 0).sum() for x in blocks)])

    def draw(blocks: Iterator[np.ndarray], random: np.random.Generator) -> np.ndarray:
        drawn = [np.empty((0, width))]
        for x in blocks:
            far = np.maximum((x**2).sum(axis=0) + _distances(x, centres).min(axis=0), 0)
            drawn.append(x[:, random.random(len(far)) < far * (2 * k / total)].T)
        return np.concatenate(drawn)

    def sizes(blocks: Iterator[np.ndarray], _: np.random.Generator) -> np.ndarray:
        return sum((np.bincount(_distances(x, centres).argmin(axis=0), minlength=len(centres)) for x in blocks), np.zeros(len(centres)))

    for step in range(steps):
        if step:
            total = float(sum(part[0] for part in points.scan(cost)))
        if total <= 0:
            break
        found = [part.reshape(-1, width) for part in points.scan(draw, seed + step)]
        centres = np.concatenate([centres, *found])
    centres = np.unique(centres, axis=0)
    if len(centres) <= k:
        return centres
    return _weighted_centres(centres, np.sum(points.scan(sizes), axis=0), k, seed)


def _weighted_centres(points: np.ndarray, weights: np.ndarray, k: int, seed: int, steps: int = 30) -> np.ndarray:
    """k-means++ and Lloyd steps of few weighted points."""
    random = np.random.default_rng(seed)

    def drawn(chances: np.ndarray) -> int:
        total = np.cumsum(chances)
        return min(int(np.searchsorted(total, random.random() * total[-1], side="right")), len(points) - 1)

    chosen = [points[drawn(weights)]]
    for _ in range(1, k):
        nearest = np.min([((points - c) ** 2).sum(axis=1) for c in chosen], axis=0)
        chances = weights * nearest
        chosen.append(points[drawn(chances if chances.sum() > 0 else nearest + 1)])
    centres, before = np.stack(chosen), None
    for _ in range(steps):
        nearest = _distances(points.T, centres).argmin(axis=0)
        if before is not None and (nearest == before).all():
            break
        before = nearest
        for i in range(k):
            own = weights * (nearest == i)
            if own.sum() > 0:
                centres[i] = own @ points / own.sum()
    return centres


def _k_means(points: Points, k: int, seed: int, init_steps: int, steps: int, tolerance: float) -> tuple[np.ndarray, float, int]:
    """Centres, the cost of the last step and how many steps were taken; a centre without points stays where it is."""
    centres, cost, taken, width = _first_centres(points, k, seed, init_steps), 0.0, 0, points.width

    def work(blocks: Iterator[np.ndarray], _: np.random.Generator) -> np.ndarray:
        totals = np.zeros((len(centres), width + 2))
        for x in blocks:
            distances = _distances(x, centres)
            least = distances.min(axis=0)
            mine = distances == least
            if np.count_nonzero(mine) != len(least):
                # As near to several centres: the first of them.
                mine = np.arange(len(centres))[:, None] == distances.argmin(axis=0)
            nearest = mine.astype(np.float64)
            totals[:, 0] += nearest.sum(axis=1)
            totals[0, 1] += np.vdot(x, x) + least.sum()
            totals[:, 2:] += nearest @ x.T
        return totals

    while taken < steps:
        totals = np.sum(points.scan(work), axis=0).reshape(len(centres), width + 2)
        n, cost, taken = totals[:, :1], float(totals[0, 1]), taken + 1
        moved = np.where(n > 0, totals[:, 2:] / np.maximum(n, 1), centres)
        still = ((moved - centres) ** 2).sum(axis=1).max() <= tolerance**2
        centres = moved
        if still:
            break
    return centres, cost, taken


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``cluster_id``: the nearest centre for complete rows, null for the rest; one pass, no union."""
    out = model.transform(df)
    helpers = [c for c in out.columns if c in _HELPERS or c.startswith("__in_")]
    return out.drop(*helpers)


def farther_rows(scaled: DataFrame, centres: Sequence[np.ndarray], tolerance: float = 1e-9) -> tuple[int, int, int]:
    """Rows, rows without a cluster, and rows to whose standardised vector (``__scaled``) another centre is nearer than
    that of their cluster, by more than ``tolerance`` in squared distance."""
    width, every = len(centres[0]), np.stack(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(3, np.int64)
        for batch in batches:
            points = batch.column(0).flatten().to_numpy().reshape(-1, width)
            cluster = batch.column(1).to_numpy()
            for x, own in chunks(points, cluster):
                distances = np.stack([((x - c) ** 2).sum(axis=1) for c in every])
                known = own >= 0
                chosen = distances[np.where(known, own, 0), np.arange(len(own))]
                found += [len(own), np.count_nonzero(~known), np.count_nonzero(known & (chosen > distances.min(axis=0) + tolerance))]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found.tolist()], names=["n", "without", "farther"])

    ship(scaled.sparkSession)
    numbers = scaled.select(vector_to_array("__scaled").alias("x"), F.coalesce(CLUSTER, F.lit(-1)).cast("int").alias("own"))
    counted = numbers.mapInArrow(run, "n long, without long, farther long")
    return tuple(counted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in counted.columns]).first())


def _moments(rows: DataFrame, features: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, and the mean and population deviation of every feature (1 where it does not vary)."""
    number = {c: F.col(f"`{c}`").cast("double") for c in features}
    aggregates = [F.avg(x).alias(f"m{i}") for i, x in enumerate(number.values())] + [F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(number.values())]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *aggregates).first()
    mean, std = (np.array([found[f"{kind}{i}"] or 0.0 for i in range(len(number))]) for kind in "ms")
    return found["n"], mean, np.where(std > 0, std, 1.0)


def _spread_centres(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the points, each drawn with a chance that grows with its squared distance from those before."""
    random = np.random.default_rng(seed)
    chosen = [points[random.integers(len(points))]]
    nearest = ((points - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = nearest.sum()
        at = int(np.searchsorted(np.cumsum(nearest), random.random() * total)) if total > 0 else random.integers(len(points))
        chosen.append(points[min(at, len(points) - 1)])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.stack(chosen)


def _packed_points(rows: DataFrame) -> DataFrame:
    """``rows`` stored as doubles in blocks, which every step hands to Python whole."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                yield pa.RecordBatch.from_arrays([packed(points)], names=[_POINTS])

    numbers = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(rows.columns)])
    return cut_lineage(numbers.mapInArrow(run, f"{_POINTS} binary"))


def step_sums(points: np.ndarray, centres: Mapping[int, np.ndarray], totals: Mapping[int, np.ndarray]) -> None:
    """Add to ``totals`` a row a centre: rows nearest to it, cost (the first centre's row has that of all), sums."""
    every, at = np.concatenate(list(centres.values())), 0
    own = (points**2).sum(axis=1)
    distances = (every**2).sum(axis=1)[:, None] - 2 * every @ points.T
    nearest = np.empty(distances.shape)
    for k, c in centres.items():
        part = distances[at : at + len(c)]
        least = part.min(axis=0)
        mine = part == least
        if np.count_nonzero(mine) != len(points):
            # As near to several centres: the first of them.
            mine = np.arange(len(c))[:, None] == part.argmin(axis=0)
        nearest[at : at + len(c)] = mine
        totals[k][0, 1] += (own + least).sum()
        at += len(c)
    summed, n, at = nearest @ points, nearest.sum(axis=1), 0
    for k, c in centres.items():
        totals[k][:, 0] += n[at : at + len(c)]
        totals[k][:, 2:] += summed[at : at + len(c)]
        at += len(c)


def shared_step(rows: DataFrame, mean: np.ndarray, std: np.ndarray, centres: Mapping[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One Lloyd step of every k of ``centres`` in a single scan: {k: (rows of each centre, their sums, cost)}.

    ``rows`` holds the features alone, or blocks of them. Tasks add up per (k, centre), so what is exchanged and
    what reaches the driver is a row a centre.
    """
    width, in_blocks = len(mean), rows.columns == [_POINTS]
    sums = [f"s{j}" for j in range(width)]
    schema = "k int, centre int, n long, cost double, " + ", ".join(f"{c} double" for c in sums)
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(c), width + 2)) for k, c in centres.items()}
        for batch in batches:
            if in_blocks:
                points = cells(batch.column(0), np.float64).reshape(-1, width)
            else:
                points = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            for (part,) in chunks(points):
                step_sums((part - mean) / std, centres, totals)
        out = [(k, i, *row) for k, t in totals.items() for i, row in enumerate(t)]
        arrays = [pa.array([r[j] for r in out]) for j in range(width + 4)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * (width + 1)]
        yield pa.RecordBatch.from_arrays([a.cast(t) for a, t in zip(arrays, kinds)], names=["k", "centre", "n", "cost", *sums])

    numbers = rows if in_blocks else rows.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(rows.columns)])
    totals = numbers.mapInArrow(run, schema).groupBy("k", "centre").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *sums)])
    found = {k: (np.zeros(len(c)), np.zeros_like(c), 0.0) for k, c in centres.items()}
    for r in totals.collect():
        n, summed, cost = found[r["k"]]
        n[r["centre"]], summed[r["centre"]] = r["n"], [r[c] for c in sums]
        found[r["k"]] = (n, summed, cost + r["cost"])
    return found


def shared_lloyd(
    rows: DataFrame, mean: np.ndarray, std: np.ndarray, centres: Mapping[int, np.ndarray], *, steps: int, tolerance: float
) -> dict[int, tuple[np.ndarray, float]]:
    """{k: (centres, cost)} after Lloyd steps of all k together, one scan of ``rows`` a step.

    A k is done when no centre moves further than ``tolerance``, and then leaves the scans; a centre without
    rows stays where it is. The cost is that of the centres returned.
    """
    moving, done = dict(centres), {}
    for step in range(steps + 1):
        for k, (n, summed, cost) in shared_step(rows, mean, std, moving).items():
            old = moving[k]
            new = np.where(n[:, None] > 0, summed / np.maximum(n, 1)[:, None], old)
            if step == steps or np.sqrt(((new - old) ** 2).sum(axis=1)).max() <= tolerance:
                done[k] = (old, cost)
                del moving[k]
            else:
                moving[k] = new
        if not moving:
            break
    return done


def elbow(
    df: DataFrame,
    features: Sequence[str] | None = None,
    *,
    max_k: int = 15,
    seed: int = 42,
    steps: int = 20,
    tolerance: float = 1e-4,
    sample: int = 2000,
) -> DataFrame:
    """(k, wcss) for k = 1..max_k over the complete rows, standardised by population moments.

    All k take their Lloyd steps in the same scans of the rows stored in blocks, so the table is read once a step
    and not once for every k and step. The first centres are drawn from about ``sample`` rows, chosen by a hash of their content,
    far ones with a greater chance. k = 1 is the total sum of squares.
    """
    features = list(features or clustering_features(df))
    rows = _complete_rows(df, features).select(*features)
    n, mean, std = _moments(rows, features)
    if n < 2:
        raise ValueError("the elbow table needs at least two complete rows")
    numbers = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    share = F.pmod(F.xxhash64(*numbers, F.monotonically_increasing_id()), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30)) + 1
    drawn = rows.where(share).select(*numbers).toPandas().to_numpy(dtype=np.float64)
    if len(drawn) < max_k:
        drawn = np.array([tuple(r) for r in rows.select(*numbers).limit(max(sample, max_k)).collect()], dtype=np.float64)
    points = (drawn[np.lexsort(drawn.T)] - mean) / std
    centres = {k: _spread_centres(points, k, seed + k) if k > 1 else np.zeros((1, len(features))) for k in range(1, max_k + 1)}
    found = shared_lloyd(_packed_points(rows), mean, std, centres, steps=steps, tolerance=tolerance)
    return df.sparkSession.createDataFrame([(k, found[k][1]) for k in sorted(found)], "k int, wcss double")
