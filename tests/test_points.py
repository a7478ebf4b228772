"""Points in blocks and the clusters fitted on them, against MLlib's scaler and k-means."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from shelfcast.operators.points import narrowed, store_points, widened
from shelfcast.plans import clusters


def test_narrow_forms_are_exact():
    rng = np.random.default_rng(1)
    whole = [rng.integers(0, 9, 50), rng.integers(-4, 4, 50) + 1990, rng.integers(0, 60_000, 50), rng.integers(0, 1 << 31, 50), np.full(50, 7)]
    others = [rng.normal(size=50), rng.integers(0, 9, 50) / 4, np.where(np.arange(50) == 3, 2.0**60, 1.5), np.where(np.arange(50) == 3, np.inf, 1.0), rng.integers(0, 9, 50) * 1e300]
    x = np.stack([np.asarray(c, dtype=np.float64) for c in (*whole, *others)])
    data = narrowed(x)
    assert (widened(data, len(x), 50) == x).all()
    assert len(data) < 9 * len(x) + 50 * (1 + 1 + 2 + 4 + 1 + 8 + 4 + 4 + 4 + 8) + 1


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    values = [(int(g), float(g * 40 + rng.normal()), float(rng.normal() - g * 30), 5.0) for g in rng.integers(0, 3, 900)]
    return spark.createDataFrame(values, "g int, a double, b double, c double").repartition(3).persist()


def test_moments_are_those_of_the_rows(rows):
    points = store_points(rows, ["a", "b", "c"], 3)
    own = np.array([tuple(r) for r in rows.select("a", "b", "c").collect()])
    assert points.rows == 900 and points.mean == pytest.approx(own.mean(axis=0)) and points.std == pytest.approx(own.std(axis=0, ddof=1))
    assert tuple(points.pick) in {tuple(r) for r in own}


def test_clusters_without_a_fit_of_mllib(spark, rows, monkeypatch, tmp_path):
    def fails(*_):
        pytest.fail("a fit of MLlib keeps every row as objects")

    names = ["a", "b", "c"]
    want = StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True)
    monkeypatch.setattr(KMeans, "_fit", fails)
    with monkeypatch.context() as patched:
        patched.setattr(StandardScaler, "_fit", fails)
        model = clusters.fit_clusters(rows, names, k=3)
    raw = PipelineModel(model.stages[:2]).transform(rows)
    scaler = want.fit(raw)
    assert model.stages[2].mean.toArray() == pytest.approx(scaler.mean.toArray())
    assert model.stages[2].std.toArray() == pytest.approx(scaler.std.toArray())
    found = clusters.assign_clusters(model, rows)
    assert found.columns == [*rows.columns, "cluster_id"]
    pairs = {tuple(r) for r in found.select("g", "cluster_id").distinct().collect()}
    assert len(pairs) == len({g for g, _ in pairs}) == len({c for _, c in pairs}) == 3
    scaled = PipelineModel(model.stages[:3]).transform(found)
    assert clusters.farther_rows(scaled, model.stages[3].clusterCenters()) == (900, 0, 0)
    moved = scaled.withColumn("cluster_id", F.when(F.col("g") == 1, 1 - F.least("cluster_id", F.lit(1))).when(F.col("g") == 2, F.col("cluster_id")))
    want = {g: scaled.where(F.col("g") == g).count() for g in (0, 1)}
    assert clusters.farther_rows(moved, model.stages[3].clusterCenters()) == (900, want[0], want[1])
    own = {r["cluster_id"]: r["s"] for r in scaled.groupBy("cluster_id").agg(F.array(*[F.avg(F.get(clusters_array(), F.lit(j))) for j in range(3)]).alias("s")).collect()}
    for i, centre in enumerate(model.stages[3].clusterCenters()):
        assert centre == pytest.approx(own[i], abs=1e-9)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    one, other = (sorted(map(tuple, clusters.assign_clusters(m, rows).collect())) for m in (model, again))
    assert one == other


def clusters_array():
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("__scaled")


def test_fewer_points_than_clusters_and_none(spark):
    few = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "a double")
    found = clusters.assign_clusters(clusters.fit_clusters(few, ["a"], k=5), few).collect()
    assert found[0]["cluster_id"] == found[1]["cluster_id"] != found[2]["cluster_id"]
    with pytest.raises(ValueError):
        clusters.fit_clusters(few.where("a > 9"), ["a"], k=2)
