"""Calendar expressions over a date column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfcast.schema import DATE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(text: str | Column, strict: bool = True) -> Column:
    """ISO text to date. Strict raises on bad text (ANSI mode), lenient gives null."""
    return F.to_date(_col(text)) if strict else F.try_to_date(_col(text))


def iso_weekday(date: str | Column = DATE) -> Column:
    """Monday=1 .. Sunday=7."""
    return F.weekday(_col(date)) + F.lit(1)


def basic_parts(date: str | Column = DATE) -> dict[str, Column]:
    d = _col(date)
    return {"year": F.year(d), "month": F.month(d), "day": F.day(d), "weekday": iso_weekday(d)}


def extended_parts(date: str | Column = DATE) -> dict[str, Column]:
    d = _col(date)
    return {"week": F.weekofyear(d), "quarter": F.quarter(d), "day_of_year": F.dayofyear(d)}


def is_weekend(date: str | Column = DATE, weekend_from: int = 5) -> Column:
    """True from ISO weekday ``weekend_from`` on; the default counts Friday as well."""
    return iso_weekday(date) >= F.lit(weekend_from)


def date_from_parts(year: str = "year", month: str = "month", day: str = "day") -> Column:
    return F.make_date(F.col(year), F.col(month), F.col(day))
