"""Arrow functions over a text column, with batches balanced by bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from shelfcast.session import ship

#: Bytes of a batch that Spark hands to a worker; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def text_batches(texts: Sequence[str], limit: int) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``limit`` characters at most; a longer text stands alone."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def map_columns(
    df: DataFrame,
    columns: Sequence[str],
    carry: Sequence[str],
    added: Sequence[StructField],
    make: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """``carry`` columns unchanged, followed by ``added`` columns computed from ``columns``.

    ``make`` runs once per task in the worker and returns the function from arrays to the new arrays.
    Batches are limited by bytes, through the session's setting for Arrow batches, since a limit by rows
    does not bound long texts. Inputs travel under names of their own, so ``carry`` may contain any names but those added.
    """
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    names = {field.name for field in added}
    carry = [c for c in carry if c not in names]
    schema = StructType([*[df.schema[c] for c in carry], *added])
    width = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            if batch.num_rows:
                new = compute(*batch.columns[width:])
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], names=[f.name for f in schema.fields])

    inputs = [F.col(f"`{c}`").alias(f"__column_{i}") for i, c in enumerate(columns)]
    return df.select(*[F.col(f"`{c}`") for c in carry], *inputs).mapInArrow(run, schema)


def map_column(
    df: DataFrame,
    column: str,
    carry: Sequence[str],
    added: Sequence[StructField],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """:func:`map_columns` of a single column."""
    return map_columns(df, [column], carry, added, make)
