"""Holiday calendar as a table (date, name), built from rules with Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Fixed-date public holidays of Ukraine (month, day, name, first year, last year).
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day", 1900, 2100),
    (1, 7, "Orthodox Christmas", 1990, 2023),
    (3, 8, "International Women's Day", 1900, 2100),
    (5, 1, "Labour Day", 1900, 2100),
    (5, 2, "Labour Day", 1900, 2017),
    (5, 9, "Victory Day", 1945, 2023),
    (5, 8, "Day of Remembrance and Victory", 2024, 2100),
    (6, 28, "Constitution Day", 1997, 2100),
    (7, 28, "Statehood Day", 2022, 2023),
    (7, 15, "Statehood Day", 2024, 2100),
    (8, 24, "Independence Day", 1992, 2100),
    (10, 14, "Defenders' Day", 2015, 2022),
    (10, 1, "Defenders' Day", 2023, 2100),
    (12, 25, "Christmas Day", 2017, 2100),
]

# Movable holidays as days after Orthodox Easter.
EASTER_HOLIDAYS = [(0, "Easter Sunday"), (49, "Trinity Sunday")]


def orthodox_easter(year):
    """Gregorian date of Orthodox Easter, 1900 to 2099 (Meeus' Julian rule plus 13 days)."""
    d = (F.lit(19) * (year % 19) + F.lit(15)) % 30
    e = (F.lit(2) * (year % 4) + F.lit(4) * (year % 7) - d + F.lit(34)) % 7
    return F.date_add(F.make_date(year, F.lit(4), F.lit(4)), (d + e).cast("int"))


def holiday_calendar(spark: SparkSession, first_year: int = 1990, last_year: int = 2030) -> DataFrame:
    """One row per holiday of the given years (1900 to 2099); :func:`with_substitutes` adds days off for weekends."""
    if first_year < 1900 or last_year > 2099:
        raise ValueError("the rule for Easter holds from 1900 to 2099")
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    year = F.col("year")
    fixed = [
        F.struct(F.make_date(year, F.lit(m), F.lit(d)).alias("date"), F.lit(name).alias("name"), year.between(a, b).alias("valid"))
        for m, d, name, a, b in FIXED_HOLIDAYS
    ]
    movable = [
        F.struct(F.date_add(orthodox_easter(year), n).alias("date"), F.lit(name).alias("name"), F.lit(True).alias("valid"))
        for n, name in EASTER_HOLIDAYS
    ]
    return years.select(F.inline(F.array(*fixed, *movable))).where("valid").select("date", "name")


def with_substitutes(calendar: DataFrame, *, first: str = "1995-01-27", last: str = "2022-03-14") -> DataFrame:
    """``calendar`` with the days off that holidays on a Saturday or Sunday move to.

    Each date gives one day off, on the next working day that is neither a holiday nor taken by an earlier one.
    The rule holds for holidays from ``first`` to ``last``; the defaults are those of the labour code, which
    suspended it in March 2022. Days off owed lie within the year of the holiday: the last days of a year
    must hold none that is moved.

    Owed days are a queue: a holiday at a weekend adds one, a free working day takes one. Its length is the
    running sum less the least running sum so far, over the days of a year.
    """
    own = calendar.where(F.col("date").isNotNull()).select("date").distinct().withColumn("holiday", F.lit(True))
    years = own.select(F.year("date").alias("year")).distinct()
    every = F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))))
    days = years.select("year", every.alias("date")).join(own, "date", "left")
    weekend = F.weekday("date") >= 5
    moved = F.col("holiday") & weekend & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    free = F.col("holiday").isNull() & ~weekend
    so_far = Window.partitionBy("year").orderBy("date")
    days = days.withColumn("free", free).withColumn("step", F.when(moved, 1).when(free, -1).otherwise(0))
    days = days.withColumn("total", F.sum("step").over(so_far))
    days = days.withColumn("owed", F.col("total") - F.least(F.lit(0), F.min("total").over(so_far)))
    days = days.withColumn("owed_before", F.lag("owed", 1, 0).over(so_far))
    added = days.where(F.col("free") & (F.col("owed_before") > 0)).select("date", F.lit("Substitute day").alias("name"))
    return calendar.select("date", "name").unionByName(added)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """A calendar kept as CSV with the columns date and name."""
    return spark.read.option("header", True).csv(path).select(F.to_date("date").alias("date"), "name")
