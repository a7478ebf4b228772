"""Facts laid out by their join keys once, so that joins to them later move only the other side."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.operators.joins import HOT_ROWS, hot_keys, with_part, with_part_copies
from shelfcast.schema import N_ROWS
from shelfcast.session import new_path

PART = "__part"


@dataclass(frozen=True)
class LaidOut:
    """A bucketed catalog table of rows with the keys ``keys`` (and the part of a hot key), and its hot keys."""

    name: str
    keys: tuple[str, ...]
    buckets: int
    hot: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).drop(PART)

    def attach(self, table: DataFrame, how: str = "inner", *, lookup: str | None = None) -> DataFrame:
        """Join ``table``, unique on the keys, as :func:`shelfcast.operators.joins.attach` does.

        ``table`` is written in the same buckets first, its row of a hot key once for each part. The join then
        finds equal keys in equal buckets, so the laid out rows are read where they are and not exchanged.
        That table is called ``lookup`` in the catalog, by default a name of its own; once the result has been
        used it may be dropped. Its files go with the session.
        """
        if how not in ("inner", "left"):
            raise ValueError("repeated table rows are only right for inner and left joins")
        spark = table.sparkSession
        copies = with_part_copies(table.drop(N_ROWS), spark.read.parquet(self.hot), self.keys)
        beside = lookup or f"shelfcast_{uuid.uuid4().hex}"
        _store(copies, self.keys, beside, self.buckets, new_path(spark, "laid-out-lookup"))
        return spark.table(self.name).join(spark.table(beside), [*self.keys, PART], how).drop(PART)


def _store(df: DataFrame, keys: Sequence[str], name: str, buckets: int, path: str | None) -> None:
    columns = [*keys, PART]
    # Dealt out as the buckets are, so that a task writes whole buckets: one file each.
    writer = df.repartition(buckets, *columns).write.bucketBy(buckets, *columns).sortBy(*columns)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def lay_out(
    fact: DataFrame,
    keys: Sequence[str],
    name: str,
    *,
    buckets: int,
    hot_rows: int = HOT_ROWS,
    path: str | None = None,
    hot_path: str | None = None,
) -> LaidOut:
    """Write ``fact`` as the catalog table ``name`` in ``buckets`` files by its keys, for many joins on them.

    Keys with more than ``hot_rows`` rows are split into parts of about that size, which are part of what the
    buckets go by: a hot key lies in several of them. Rows with a null key are kept, and match nothing. The fact
    is moved this once. Choose buckets of some 200 MB, and the same number for facts joined with each other.
    Without ``path`` the table goes to the warehouse; the list of hot keys goes to ``hot_path``, by
    default a folder that lasts as long as the session.
    """
    keys = tuple(keys)
    weights = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(N_ROWS))
    hot_path = hot_path or new_path(fact.sparkSession, "laid-out-hot", lasting=True)
    hot = hot_keys(weights, keys, hot_rows=hot_rows, path=hot_path)
    _store(with_part(fact, hot, keys), keys, name, buckets, path)
    return LaidOut(name, keys, buckets, hot_path)
