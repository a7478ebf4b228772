"""Session for local runs, and the shared folder in which jobs keep intermediate tables."""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local[*]-style session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfcast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_scope: ContextVar[list[str] | None] = ContextVar("folders of the innermost scratch block", default=None)


@functools.lru_cache(maxsize=None)
def _temporary(application: str) -> str:
    return tempfile.mkdtemp(prefix="shelfcast-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; for a local master without it, one temporary folder
    an application."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _temporary(spark.sparkContext.applicationId)


def new_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A path in the shared folder that no other run uses; deleted when the session's JVM ends, or unless it is
    ``lasting`` with the :func:`scratch` block it was made in."""
    made = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _on_storage(spark, made, lambda fs, path: fs.deleteOnExit(path))
    if not lasting and (scope := _scope.get()) is not None:
        scope.append(made)
    return made


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders made by :func:`new_path` inside the block go with it: for work whose result is written
    elsewhere or collected before the block ends, so that a long session does not fill the shared folder."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new_path` that no live DataFrame reads any more."""
    _on_storage(spark, path, lambda fs, p: fs.delete(p, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_on_storage(spark, path, lambda fs, p: fs.exists(p)))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    return sorted(s.getPath().getName() for s in _on_storage(spark, path, lambda fs, p: fs.listStatus(p)) if s.isDirectory())


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder within its storage, in place of what is at ``target``."""
    drop_path(spark, target)
    if not _on_storage(spark, path, lambda fs, p: fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target))):
        raise OSError(f"{path} could not be moved to {target}")


def _on_storage(spark: SparkSession, path: str, action):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return action(hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path)


#: Size of the row groups of intermediate tables, and of the splits that fits read: a split holds whole groups.
GROUP_BYTES, SPLIT_BYTES = 8 << 20, 16 << 20

_SPLITS = "spark.sql.files.maxPartitionBytes"


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in splits of at most SPLIT_BYTES inside the block: for fits, which keep their rows in a form
    several times as large as the file's. The session's own setting is put back."""
    before = spark.conf.get(_SPLITS)
    spark.conf.set(_SPLITS, str(min(_bytes(spark, before), SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_SPLITS, before)


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a short plan that survives lost executors."""
    spark = df.sparkSession
    path = path or new_path(spark, "table")
    df.write.option("parquet.block.size", GROUP_BYTES).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of jobs that are over deleted now: Spark does so when the driver collects its garbage, which
    with much memory is seldom. For jobs that move whole facts several times."""
    gc.collect()
    spark._jvm.System.gc()


@functools.lru_cache(maxsize=None)
def _package(application: str) -> str:
    top = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="shelfcast-code-"), "shelfcast_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    return target


def ship(spark: SparkSession) -> None:
    """Give the workers of this application the package's code, once; its functions are imported there."""
    before = _package.cache_info().misses
    archive = _package(spark.sparkContext.applicationId)
    if _package.cache_info().misses > before:
        spark.sparkContext.addPyFile(archive)
