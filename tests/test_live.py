"""Live tables: any order of rows over several batches, restarts in the middle of a batch, bounded files."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql.types import DoubleType

from rows import SALES, day, rows_of
from shelfcast.operators import refresh
from shelfcast.operators.daily import daily
from shelfcast.operators.history import lag_table, moving_average_table
from shelfcast.streaming.live import LiveDaily, keep_live


def _rows(seed: int, n: int = 150) -> list[tuple]:
    rng = random.Random(seed)
    return [(day(rng.randint(1, 28), rng.randint(1, 5)), rng.randint(0, 2), rng.randint(0, 4), float(rng.randint(1, 9)), rng.randint(1, 9)) for _ in range(n)]


def test_out_of_order_batches_end_as_the_batch_tables(spark, tmp_path):
    """Every row may be late; the last version of all rows is right, whatever came out before."""
    rows = _rows(1) + [(None, 1, 1, 1.0, 1), (day(1), None, None, 1.0, 1)]
    source = tmp_path / "in"
    for i in range(5):
        spark.createDataFrame(rows[i::5], SALES).coalesce(1).write.mode("append").parquet(str(source))
    every = spark.createDataFrame(rows, SALES)
    for key, make, table in (("sku_id", refresh.stored_lags, lag_table), ("category_id", refresh.stored_averages, moving_average_table)):
        live, stored = LiveDaily(str(tmp_path / f"daily_{key}"), key), make(str(tmp_path / f"windows_{key}"), quantity=DoubleType())
        stream = spark.readStream.schema(SALES).option("maxFilesPerTrigger", 2).parquet(str(source))
        query = keep_live(stream, live, str(tmp_path / f"progress_{key}"), [stored])
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3
        days = daily(every.where(f"{key} IS NOT NULL AND date IS NOT NULL"), key)
        days = days.withColumn("sales_quantity", days["sales_quantity"].cast("double"))
        assert rows_of(live.rows(spark), *days.columns) == rows_of(days)
        expected = table(days.drop("n_rows"))
        assert rows_of(stored.rows(spark), *expected.columns) == rows_of(expected)


def test_a_batch_that_failed_in_the_middle_is_run_again(spark, tmp_path, monkeypatch):
    from shelfcast.streaming import live as module

    live = LiveDaily(str(tmp_path / "daily"), "sku_id")
    first, second = (spark.createDataFrame(_rows(s, 60), SALES) for s in (2, 3))
    live.merge(first, 0)
    own = module.replace_months

    def broken(table, path, months):
        own(table.where(table["__month"].isin(months[:2])), path, months[:2])
        raise RuntimeError("lost after two months")

    monkeypatch.setattr(module, "replace_months", broken)
    with pytest.raises(RuntimeError):
        live.merge(second, 1)
    monkeypatch.setattr(module, "replace_months", own)
    live.merge(second, 1)
    live.merge(second, 1)
    days = daily(first.unionByName(second), "sku_id")
    days = days.withColumn("sales_quantity", days["sales_quantity"].cast("double"))
    assert rows_of(live.rows(spark), *days.columns) == rows_of(days)


def test_files_do_not_grow_with_batches(spark, tmp_path):
    live = LiveDaily(str(tmp_path / "daily"), "sku_id")
    sizes = []
    for batch in range(4):
        live.merge(spark.createDataFrame(_rows(batch, 40), SALES).coalesce(1), batch)
        sizes.append(sum(f.endswith(".parquet") for _, _, files in os.walk(tmp_path / "daily") for f in files))
    assert sizes[-1] <= sizes[0] + 20 and max(sizes) <= 5 * 4


def test_live_files_are_many_and_small(spark, monkeypatch):
    """No file of the live queries grows beyond its share of the shuffle partitions, and there are two batches."""
    from shelfcast.checks import streams

    seen, own = [], streams.keep_live
    monkeypatch.setattr(streams, "keep_live", lambda *a, **more: seen.append(own(*a, **more)) or seen[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    folders, path = [], streams.new_path
    monkeypatch.setattr(streams, "new_path", lambda s, name: folders.append((name, path(s, name))) or folders[-1][1])
    try:
        streams.live_averages(spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = spark.read.parquet(dict(folders)["sales-files"]).groupBy("_metadata.file_path").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 1500
    assert len([p for p in seen[0].recentProgress if p["numInputRows"]]) == 2
