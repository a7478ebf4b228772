"""Rows of numbers stored in blocks for fits that scan them again and again, each column of a block in the narrowest form that holds it exactly."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.session import cut_lineage, new_path, ship

_WHOLE = (np.uint8, np.uint16, np.uint32)
_FORMS = (*_WHOLE, np.float32, np.float64)

#: Points of a record, and those that are worked on at a time in scans.
CELL_ROWS, CACHED_ROWS = 4096, 2048

_STORED = "n int, points binary, sums binary, squares binary, pick binary"


def narrowed(columns: np.ndarray) -> bytes:
    """The columns (a row of the array each): whole numbers as distances from the least, others as floats if that is exact."""
    forms, least, parts = np.empty(len(columns), np.uint8), np.zeros(len(columns)), []
    for j, x in enumerate(columns):
        low, high = x.min(), x.max()
        whole = -(2.0**52) < low and high < 2.0**52 and high - low < 2.0**32 and bool((np.floor(x) == x).all())
        if whole:
            form = next(i for i, t in enumerate(_WHOLE) if high - low <= np.iinfo(t).max)
            least[j], x = low, x - low
        else:
            with np.errstate(over="ignore"):
                form = len(_WHOLE) if bool((x.astype(np.float32) == x).all()) else len(_FORMS) - 1
        forms[j] = form
        parts.append(x.astype(_FORMS[form]).tobytes())
    return b"".join([forms.tobytes(), least.tobytes(), *parts])


def _forms(data: memoryview | bytes, width: int, n: int) -> Iterator[tuple[np.ndarray, float]]:
    """Every column as it is stored, and its least number."""
    least, at = np.frombuffer(data, np.float64, width, width).tolist(), 9 * width
    for form, low in zip(np.frombuffer(data, np.uint8, width).tolist(), least):
        values = np.frombuffer(data, _FORMS[form], n, at)
        at += values.nbytes
        yield values, low


def widened(data: memoryview | bytes, width: int, n: int) -> np.ndarray:
    """The inverse of :func:`narrowed`."""
    return np.stack([values + np.float64(low) for values, low in _forms(data, width, n)])


def standardised(data: memoryview | bytes, width: int, n: int, mean: Sequence[float], scale: Sequence[float]) -> Iterator[np.ndarray]:
    """(x - mean) * scale of a block, so many points at a time that they stay in the processor's cache."""
    columns = list(_forms(data, width, n))
    for at in range(0, n, CACHED_ROWS):
        out = np.empty((width, min(CACHED_ROWS, n - at)))
        for j, (values, low) in enumerate(columns):
            np.subtract(values[at : at + CACHED_ROWS], mean[j] - low, out=out[j])
            out[j] *= scale[j]
        yield out


@dataclass(frozen=True)
class Points:
    """Stored points of ``width`` numbers: how many, their means and deviations (of a sample; 0 where nothing varies), and one of them."""

    table: DataFrame
    path: str
    width: int
    rows: int
    mean: np.ndarray
    std: np.ndarray
    pick: np.ndarray

    def scan(self, work: Callable[[Iterator[np.ndarray], np.random.Generator], np.ndarray], seed: int = 0) -> list[np.ndarray]:
        """What ``work`` makes of the standardised blocks of every task, a point a column."""
        width, mean, scale = self.width, self.mean.tolist(), np.divide(1.0, self.std, out=np.zeros(self.width), where=self.std > 0).tolist()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def blocks() -> Iterator[np.ndarray]:
                for batch in batches:
                    for n, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                        yield from standardised(data.as_buffer(), width, n, mean, scale)

            found = np.ascontiguousarray(work(blocks(), _task_random(seed)), dtype=np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["found"])

        ship(self.table.sparkSession)
        return [np.frombuffer(r["found"]) for r in self.table.select("n", "points").mapInArrow(run, "found binary").collect()]


def _task_random(seed: int) -> np.random.Generator:
    from pyspark import TaskContext

    return np.random.default_rng([seed & 0xFFFFFFFF, TaskContext.get().partitionId()])


def store_points(rows: DataFrame, columns: Sequence[str], seed: int) -> Points:
    """The numbers of rows that have them all, stored in blocks, with their moments."""
    width, spark = len(columns), rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = _task_random(seed)
        for batch in batches:
            every = batch.column(0).flatten().to_numpy().reshape(-1, width)
            for at in range(0, len(every), CELL_ROWS):
                x = np.ascontiguousarray(every[at : at + CELL_ROWS].T)
                sums = x.sum(axis=1)
                squares = ((x - (sums / x.shape[1])[:, None]) ** 2).sum(axis=1)
                pick = np.ascontiguousarray(x[:, random.integers(x.shape[1])])
                cells = [pa.array([c], pa.binary()) for c in (narrowed(x), sums.tobytes(), squares.tobytes(), pick.tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), *cells], names=["n", "points", "sums", "squares", "pick"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, total = _task_random(seed + 1), None
        for batch in batches:
            for r in batch.to_pylist():
                part = (r["n"], *[np.frombuffer(r[c]) for c in ("sums", "squares", "pick")])
                total = part if total is None else _joined(total, part, random)
        if total is not None:
            cells = [pa.array([x.tobytes()], pa.binary()) for x in total[1:]]
            yield pa.RecordBatch.from_arrays([pa.array([total[0]], pa.int64()), *cells], names=["n", "sums", "squares", "pick"])

    ship(spark)
    path = new_path(spark, "points")
    array = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    table = cut_lineage(rows.select(array.alias("x")).mapInArrow(run, _STORED), path)
    parts = table.drop("points").mapInArrow(add_up, "n long, sums binary, squares binary, pick binary").collect()
    if not parts:
        raise ValueError("no complete rows to fit")
    total, *others = ((r["n"], *[np.frombuffer(r[c]) for c in ("sums", "squares", "pick")]) for r in parts)
    random = np.random.default_rng(seed)
    for part in others:
        total = _joined(total, part, random)
    n, sums, squares, pick = total
    return Points(table, path, width, n, sums / n, np.sqrt(squares / max(n - 1, 1)), pick)


def _joined(a: tuple, b: tuple, random: np.random.Generator) -> tuple:
    """Of two lots of points the number, sums, squared distances from the means, and one point drawn evenly."""
    n = a[0] + b[0]
    squares = a[2] + b[2] + (a[1] / a[0] - b[1] / b[0]) ** 2 * (a[0] * b[0] / n)
    return n, a[1] + b[1], squares, a[3] if random.random() * n < a[0] else b[3]
