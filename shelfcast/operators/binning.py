"""Feature values as small whole numbers: the table that histogram trees are grown on."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from shelfcast.operators.blocks import BLOCK_ROWS, packed
from shelfcast.session import cut_lineage, new_path, ship

#: Bin of null and NaN; the most bins of present values is one less than the numbers of a byte.
MISSING = 255
MAX_BINS = 255

BINS, LABEL, SCORE, DRAW = "__bins", "__label", "__score", "__draw"

#: A record holds a block of rows, and their number and the sum of their labels.
N_LABELS, LABEL_SUM = "__n", "__label_sum"

BINNED = StructType(
    [StructField(c, BinaryType()) for c in (BINS, LABEL, SCORE, DRAW)] + [StructField(N_LABELS, LongType()), StructField(LABEL_SUM, DoubleType())]
)


def number(column: str) -> Column:
    """A feature as a double, null where it is missing."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def bin_edges(df: DataFrame, features: Sequence[str], max_bin: int = MAX_BINS) -> list[np.ndarray]:
    """Upper edges of the bins of every feature: its values where there are at most ``max_bin`` of them, else
    as many approximate quantiles. Values beyond the last edge belong to the last bin.

    A sketch of the number of values decides which features are listed in full, so no long list is built;
    what reaches the driver is at most ``max_bin`` numbers a feature.
    """
    if not 2 <= max_bin <= MAX_BINS:
        raise ValueError(f"max_bin is between 2 and {MAX_BINS}")
    numbers = df.select(*[number(c).alias(f"f{i}") for i, c in enumerate(features)])
    names = numbers.columns
    about = numbers.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    listed = [c for c in names if about[c] <= 2 * max_bin]
    values: dict[str, list[float]] = {}
    if listed:
        found = numbers.agg(*[F.collect_set(c).alias(c) for c in listed]).first()
        values = {c: sorted(found[c]) for c in listed if len(found[c]) <= max_bin}
    dense = [c for c in names if c not in values]
    if dense:
        shares = [(i + 1) / max_bin for i in range(max_bin)]
        cut = numbers.approxQuantile(dense, shares, 0.1 / max_bin)
        values |= {c: sorted(set(q)) for c, q in zip(dense, cut)}
    return [np.array(values[c], dtype=np.float64) for c in names]


def bin_numbers(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    """(rows, features) bins of columns of doubles, NaN being missing."""
    out = np.empty((len(columns[0]), len(columns)), dtype=np.uint8)
    for j, (values, own) in enumerate(zip(columns, edges)):
        place = np.minimum(np.searchsorted(own, values), max(len(own) - 1, 0))
        out[:, j] = np.where(np.isnan(values), MISSING, place)
    return out


def binned(df: DataFrame, features: Sequence[str], label: str, edges: Sequence[np.ndarray]) -> tuple[DataFrame, str]:
    """The stored table (bins, label, score 0, a random but repeatable number) of the rows with a label, and its path.

    A row takes one byte a feature; rows lie in blocks, so that a scan hands whole blocks to Python. The number is a
    hash of the row's content and its place in its task.
    """
    ship(df.sparkSession)
    known = df.where(number(label).isNotNull())
    draw = F.xxhash64(F.monotonically_increasing_id(), *[F.col(f"`{c}`") for c in dict.fromkeys([*features, label])])
    slim = known.select(*[number(c).alias(f"f{i}") for i, c in enumerate(features)], number(label).alias(LABEL), draw.alias(DRAW))
    width = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[:width]]
            known, draws = (batch.column(width + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            blocks = [packed(x) for x in (bin_numbers(columns, edges), known, np.zeros(len(known)), draws)]
            starts = np.arange(0, len(known), BLOCK_ROWS)
            n = np.diff(np.append(starts, len(known)))
            yield pa.RecordBatch.from_arrays([*blocks, pa.array(n, pa.int64()), pa.array(np.add.reduceat(known, starts))], names=BINNED.fieldNames())

    path = new_path(df.sparkSession, "binned")
    return cut_lineage(slim.mapInArrow(run, BINNED), path), path
