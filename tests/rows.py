"""Helpers shared by the tests: the schema of hand-made sales, dates, rows in a fixed order."""

from __future__ import annotations

import datetime as dt

SALES = "date date, category_id long, sku_id long, sales_price double, sales_quantity long"


def day(n: int, month: int = 1, year: int = 2020) -> dt.date:
    return dt.date(year, month, n)


def rows_of(df, *columns):
    out = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
