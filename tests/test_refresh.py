"""Stored window tables after corrections equal those built anew, and only touched months are read and written."""

from __future__ import annotations

import os
import random

import pytest

from rows import SALES, day, rows_of
from shelfcast.operators import refresh


def _frames(spark, rows):
    return spark.createDataFrame(rows, SALES)


def _sales(rng, n=220):
    return [
        (day(rng.randint(1, 28), rng.randint(1, 12), 2020), rng.randint(0, 2), rng.randint(0, 5), float(rng.randint(1, 9)), rng.randint(1, 9))
        for _ in range(n)
    ]


@pytest.mark.parametrize("kind", ["lags", "averages", "averages_before"])
def test_refreshed_equals_rebuilt(spark, tmp_path, kind):
    """Two rounds of inserts, updates and deletes, months emptied and new ones among them."""
    make = {
        "lags": refresh.stored_lags,
        "averages": refresh.stored_averages,
        "averages_before": lambda path: refresh.stored_averages(path, 3, False),
    }[kind]
    key = 2 if kind == "lags" else 1
    rng = random.Random(len(kind))
    rows = _sales(rng) + [(None, 1, 1, 2.0, 3), (day(3), None, None, 2.0, 3)]
    stored = make(str(tmp_path / "kept"))
    stored.build(_frames(spark, rows))
    for round_ in range(2):
        before = list(rows)
        rng.shuffle(rows)
        gone, rows = rows[:12], rows[12:]
        rows = [(*r[:4], r[4] + 5) if rng.random() < 0.05 else r for r in rows] + _sales(rng, 6)
        if round_ == 1:
            gone += [r for r in rows if r[0] and r[0].month == 5]
            rows = [r for r in rows if not (r[0] and r[0].month == 5)]
        rows.append((day(9, 1 + round_, 2022), 1, 1, 4.0, 4))
        different = set(map(repr, before)) ^ set(map(repr, rows))
        changed = [(r[key], r[0]) for r in before + rows + gone if repr(r) in different]
        counted = [(r[key], r[0]) for r in before + rows if before.count(r) != rows.count(r)]
        cells = spark.createDataFrame([*changed, *counted], f"{stored.key} long, date date")
        stored.refresh(_frames(spark, rows), cells)
        anew = make(str(tmp_path / f"new{round_}"))
        anew.build(_frames(spark, rows))
        assert rows_of(stored.rows(spark)) == rows_of(anew.rows(spark))


def test_only_touched_months_are_read_and_written(spark, tmp_path, monkeypatch):
    rows = [(day(d, m, y), 1, s, 2.0, 3) for y in (2019, 2020, 2021) for m in range(1, 13) for d in range(1, 11) for s in (1, 2)]
    stored = refresh.stored_lags(str(tmp_path))
    stored.build(_frames(spark, rows))

    def files():
        return {
            os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
            for name in ("days", "windows") for folder, _, names in os.walk(tmp_path / name) for f in names if f.endswith(".parquet")
        }

    read, own = [], refresh.StoredWindows._read
    monkeypatch.setattr(refresh.StoredWindows, "_read", lambda self, s, name, months=None: read.append((name, months)) or own(self, s, name, months))
    before = files()
    rows.append((day(20, 6, 2020), 1, 2, 9.0, 9))
    stored.refresh(_frames(spark, rows), spark.createDataFrame([(2, day(20, 6, 2020))], "sku_id long, date date"))
    months = {m for name, found in read if name != "counts" for m in (found or ["all"])}
    assert months == {"m202005", "m202006", "m202007"}
    changed = {f for f, t in files().items() if before.get(f) != t}
    assert changed and all("m202006" in f or "m202007" in f for f in changed)
    plan = own(stored, spark, "days", ["m202006"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__month" in plan and "m202006" in plan.split("PartitionFilters")[1][:200]
    after = stored.rows(spark).where("sku_id = 2 AND date = '2020-07-01'").first()
    assert after.lag_1_sales_quantity == 9


def test_nothing_changed(spark, tmp_path):
    stored = refresh.stored_averages(str(tmp_path))
    stored.build(_frames(spark, [(day(1), 1, 1, 2.0, 3)]))
    stored.refresh(_frames(spark, [(day(1), 1, 1, 2.0, 3)]), spark.createDataFrame([(None, None)], "category_id long, date date"))
    assert stored.rows(spark).count() == 1


def test_months_are_written_once(spark, tmp_path):
    """A table that reads the months it replaces is written to them by one job; nothing is left beside them."""
    path = str(tmp_path / "kept")
    rows = spark.createDataFrame([(1, "m202001"), (2, "m202002"), (3, "m202003")], f"n long, {refresh.MONTH} string")
    refresh.replace_months(rows, path, None)
    held = refresh.read_months(spark, path, rows.schema, ["m202001", "m202002"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("months", "")
    refresh.replace_months(held.where("n = 2").selectExpr("n + 10 AS n", refresh.MONTH), path, ["m202001", "m202002"])
    assert len(jobs("months")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows_of(refresh.read_months(spark, path, rows.schema)) == [(3, "m202003"), (12, "m202002")]
    assert sorted(f for f in os.listdir(path) if not f.startswith("_SUCCESS")) == [f"{refresh.MONTH}=m20200{m}" for m in (2, 3)]
    refresh.replace_months(rows.where("n = 1"), path, None)
    assert rows_of(refresh.read_months(spark, path, rows.schema)) == [(1, "m202001")]
