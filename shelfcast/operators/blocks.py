"""Numbers of many rows in one binary cell, for tables that a fit scans again and again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows of a cell, and rows that are worked on at a time.
BLOCK_ROWS, CHUNK_ROWS = 1024, 16384


def packed(values: np.ndarray, sizes: np.ndarray | None = None) -> pa.Array:
    """The rows of an array, BLOCK_ROWS or the given number of them a cell."""
    starts = np.arange(0, len(values), BLOCK_ROWS) if sizes is None else np.cumsum(sizes) - sizes
    return pa.array([part.tobytes() for part in np.split(values, starts[1:])] if len(starts) else [], pa.binary())


def cells(column: pa.Array, dtype: type) -> np.ndarray:
    """The numbers of all cells of a column, one after the other, read where they are."""
    if not len(column):
        return np.empty(0, dtype)
    _, offsets, data = column.buffers()
    place = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    start, end = int(place[column.offset]), int(place[column.offset + len(column)])
    return np.frombuffer(data, np.uint8)[start:end].view(dtype) if end > start else np.empty(0, dtype)


def chunks(*columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """CHUNK_ROWS of every column at a time."""
    for i in range(0, len(columns[0]), CHUNK_ROWS):
        yield tuple(c[i : i + CHUNK_ROWS] for c in columns)
