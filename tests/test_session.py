"""The shared folder: taken from the session, made for a local one without the setting, cleared by scope."""

from __future__ import annotations

import os
import subprocess
import sys

from pyspark.sql import functions as F

from shelfcast.session import cut_lineage, new_path, scratch, shared_dir

HERE = os.path.dirname(os.path.abspath(__file__))


class _Unset:
    """A session without ``spark.checkpoint.dir`` that, as Spark does, refuses to change it."""

    def __init__(self, spark, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": spark.sparkContext.applicationId})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})


def test_a_local_session_needs_no_setting(spark):
    unset = _Unset(spark, "local[2]")
    assert os.path.isdir(shared_dir(unset)) and shared_dir(unset) == shared_dir(unset)


def test_a_cluster_needs_the_setting(spark):
    try:
        shared_dir(_Unset(spark, "spark://somewhere"))
    except ValueError:
        return
    raise AssertionError("a folder of one machine would not be seen by the others")


def test_a_stock_session_stores_tables(tmp_path):
    """In a process of its own, with an empty configuration folder."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from shelfcast.session import cut_lineage\n"
        "assert cut_lineage(spark.range(3)).count() == 3\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(HERE)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_scoped_folders_go_with_their_scope(spark):
    outside = new_path(spark, "kept")
    cut_lineage(spark.range(2), outside)
    with scratch(spark):
        inside = new_path(spark, "gone")
        assert cut_lineage(spark.range(2), inside).count() == 2
    assert spark.read.parquet(outside).count() == 2
    assert not spark._jvm.java.io.File(inside.removeprefix("file:")).exists()


def test_every_module_is_collected_with_and_without_the_subpackage():
    """``conftest`` names more than one file here, so no test may import from it."""
    for folder, _, files in os.walk(HERE):
        for name in files:
            if name.startswith("test_") and name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "from conf" + "test import" not in f.read(), name


def test_a_fit_reads_splits_of_bounded_size(spark, tmp_path):
    """What a task of a fit keeps goes by the split it reads, whatever the size of the files."""
    from shelfcast import session

    path = str(tmp_path / "one")
    cut_lineage(spark.range(0, 5_000_000, 1, 1).selectExpr("xxhash64(id) AS x"), path)
    with session.small_splits(spark):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(16 << 20)
        parts = spark.read.parquet(path).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) * 8 <= (16 + 8) << 20
