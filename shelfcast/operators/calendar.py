"""Calendar columns and the holiday flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions import dates
from shelfcast.schema import DATE, HOLIDAY


def with_calendar(df: DataFrame, *, extended: bool = False, weekend_from: int = 5) -> DataFrame:
    """Add year, month, day, weekday; with ``extended`` also week, quarter, day_of_year, is_weekend."""
    columns = dates.basic_parts()
    if extended:
        columns |= dates.extended_parts()
        columns["is_weekend"] = dates.is_weekend(weekend_from=weekend_from)
    return df.withColumns(columns)


def with_holiday_flag(df: DataFrame, holidays: DataFrame, *, flag: str = HOLIDAY) -> DataFrame:
    """True where the date is in the calendar table, null where the date is null or in a year before the
    calendar's first or after its last, of which the calendar says nothing.

    No broadcast hint: a calendar built by :func:`shelfcast.sources.holidays.holiday_calendar` or read
    from a file has known size, so Spark broadcasts it below its own threshold.
    """
    days = holidays.where(F.col(DATE).isNotNull()).select(DATE).distinct().withColumn("__holiday", F.lit(True))
    joined = df.join(days, DATE, "left")
    span = days.agg(F.struct(F.min(F.year(DATE)).alias("first"), F.max(F.year(DATE)).alias("last")).alias("span")).scalar()
    known = F.year(DATE).between(span["first"], span["last"])
    value = F.when(known, F.coalesce("__holiday", F.lit(False)))
    return joined.select(*[F.col(c) for c in df.columns], value.alias(flag))
