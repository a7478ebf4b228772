"""Exact nearest-rank quantiles without sorting the table or gathering it in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of an interval whose values are looked at themselves.
FEW = 10_000


@dataclass
class _Target:
    column: str
    p: float
    rank: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    inside: int = 0
    answer: float | None = None

    def inner(self) -> Column:
        """The column's value inside the open interval, null elsewhere."""
        x = F.col(self.column)
        test = x.isNotNull()
        if self.lo is not None:
            test &= x > F.lit(self.lo)
        if self.hi is not None:
            test &= x < F.lit(self.hi)
        return F.when(test, x)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *, error: float = 1e-3
) -> dict[tuple[str, float], float | None]:
    """Value at rank ``ceil(p * n)`` of each double column, nulls left out; None for an empty column.

    Each round asks Spark for approximate quantiles just below and above every rank, then counts the
    rows below, at and between them. Either an end point is the answer or the open interval between
    them, some ``4 * error`` of the rows, is the next round's input. Only counts and end points reach
    the driver, and in the end the values of an interval of at most FEW rows. A bracket that misses its rank
    is replaced by the interval next to it, so the answer is exact whatever the sketch returned.
    """
    df = df.select(*dict.fromkeys(columns))
    sizes = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    targets = [
        _Target(c, p, max(1, math.ceil(p * sizes[c])), inside=sizes[c]) for c in df.columns for p in probabilities
    ]
    open_targets = [t for t in targets if sizes[t.column]]
    while open_targets:
        few = [t for t in open_targets if t.inside <= FEW]
        if few:
            _finish(df, few)
        many = [t for t in open_targets if t.inside > FEW]
        if many:
            _narrow(df, many, error)
        open_targets = [t for t in many if t.answer is None]
    return {(t.column, t.p): t.answer for t in targets}


def _finish(df: DataFrame, targets: list[_Target]) -> None:
    """The answers of intervals with few rows, from their sorted values."""
    values = df.agg(*[F.sort_array(F.collect_list(t.inner())).alias(f"t{i}") for i, t in enumerate(targets)]).first()
    for i, t in enumerate(targets):
        t.answer = values[f"t{i}"][t.rank - t.below - 1]


def _narrow(df: DataFrame, targets: list[_Target], error: float) -> None:
    inner = df.select(*[t.inner().alias(f"t{i}") for i, t in enumerate(targets)])
    asked = [_around(t, error) for t in targets]
    probabilities = sorted({q for pair in asked for q in pair})
    found = inner.approxQuantile(inner.columns, probabilities, error)
    ends = []
    for pair, values in zip(asked, found, strict=True):
        at = dict(zip(probabilities, values, strict=True)) if values else {}
        ends.append((at.get(pair[0], math.nan), at.get(pair[1], math.nan)))
    counts = inner.agg(*[c for i, (lo, hi) in enumerate(ends) for c in _counts(i, lo, hi)]).first()
    for i, (t, (lo, hi)) in enumerate(zip(targets, ends, strict=True)):
        _place(t, lo, hi, *[counts[f"{name}{i}"] for name in ("below", "at_lo", "between", "at_hi")])


def _around(t: _Target, error: float) -> tuple[float, float]:
    share = (t.rank - t.below) / t.inside
    return max(0.0, share - 2 * error), min(1.0, share + 2 * error)


def _counts(i: int, lo: float, hi: float) -> list[Column]:
    x = F.col(f"t{i}")
    return [
        F.count_if(x < F.lit(lo)).alias(f"below{i}"),
        F.count_if(x == F.lit(lo)).alias(f"at_lo{i}"),
        F.count_if((x > F.lit(lo)) & (x < F.lit(hi))).alias(f"between{i}"),
        F.count_if((x == F.lit(hi)) & (F.lit(hi) != F.lit(lo))).alias(f"at_hi{i}"),
    ]


def _place(t: _Target, lo: float, hi: float, below: int, at_lo: int, between: int, at_hi: int) -> None:
    rank = t.rank - t.below
    if rank <= below:
        t.hi, t.inside = lo, below
    elif rank <= below + at_lo:
        t.answer = lo
    elif rank <= below + at_lo + between:
        t.lo, t.hi, t.below, t.inside = lo, hi, t.below + below + at_lo, between
    elif rank <= below + at_lo + between + at_hi:
        t.answer = hi
    else:
        passed = below + at_lo + between + at_hi
        t.lo, t.below, t.inside = hi, t.below + passed, t.inside - passed
