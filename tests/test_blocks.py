"""Rows packed in blocks come back whole, and Lloyd steps over them are those of a plain loop."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfcast.operators.binning import binned
from shelfcast.operators.blocks import BLOCK_ROWS, cells, packed
from shelfcast.plans import clusters, models


def test_cells_are_read_where_they_are():
    values = np.arange(5 * BLOCK_ROWS // 2, dtype=np.float64)
    column = packed(values)
    assert len(column) == 3 and np.array_equal(cells(column, np.float64), values)
    assert np.array_equal(cells(column.slice(1, 1), np.float64), values[BLOCK_ROWS : 2 * BLOCK_ROWS])
    sizes = np.array([3, 1, 4])
    assert [len(c.as_py()) for c in packed(np.arange(8, dtype=np.uint8), sizes)] == [3, 1, 4]
    assert not len(packed(values[:0])) and not len(cells(pa.array([], pa.binary()), np.int64))


def test_a_binned_table_has_a_record_for_many_rows(spark):
    n = 3 * BLOCK_ROWS
    df = spark.range(0, n, 1, 1).selectExpr("CAST(id % 7 AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y")
    table, _ = binned(df, ["x"], "y", [np.arange(7.0)])
    assert table.count() <= 6
    assert sorted(np.concatenate([np.frombuffer(r["__label"], np.float64) for r in table.collect()])) == list(range(n))


def test_scores_stored_on_the_way_keep_the_blocks(spark, monkeypatch):
    """Blocks that are not full lie between others."""
    rows = spark.range(0, 5000, 1, 3).selectExpr("CAST(id % 13 AS DOUBLE) AS x", "CAST(id * id % 29 AS DOUBLE) AS sales_quantity")
    learner = models.leafwise_boosting(rounds=4, numLeaves=4, minDataInLeaf=1)
    whole = models.predict(models.train(rows, learner, ["x"]), rows).orderBy("x").toPandas()
    monkeypatch.setattr("shelfcast.plans.ensembles.STORE_EVERY", 1)
    stored = models.predict(models.train(rows, learner, ["x"]), rows).orderBy("x").toPandas()
    assert np.allclose(whole["prediction"], stored["prediction"])


def test_step_sums_are_those_of_a_plain_loop():
    random = np.random.default_rng(5)
    points = random.integers(0, 4, (300, 3)).astype(float)
    # Two centres of k = 3 are the same: rows go to the first.
    centres = {1: np.zeros((1, 3)), 3: np.array([[1.0, 1, 1], [1.0, 1, 1], [3.0, 2, 0]])}
    totals = {k: np.zeros((len(c), 5)) for k, c in centres.items()}
    for part in (points[:100], points[100:]):
        clusters.step_sums(part, centres, totals)
    for k, c in centres.items():
        distance = ((points[:, None] - c) ** 2).sum(axis=2)
        nearest = distance.argmin(axis=1)
        assert np.isclose(totals[k][:, 1].sum(), distance.min(axis=1).sum())
        for i in range(k):
            assert totals[k][i, 0] == (nearest == i).sum() and np.allclose(totals[k][i, 2:], points[nearest == i].sum(axis=0))
