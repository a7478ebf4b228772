"""Calendar, daily tables, lags, averages, joins and the feature table on hand-made rows."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rows import SALES, day, rows_of
from shelfcast.operators.calendar import with_calendar, with_holiday_flag
from shelfcast.operators.daily import as_arrays, daily, daily_base, daily_category, daily_sku, from_arrays, gap_report, roll_up
from shelfcast.operators.history import lag_table, moving_average_table
from shelfcast.operators.joins import attach, attach_stored, hot_keys
from shelfcast.operators.rows import drop_nulls, split_by_completeness
from shelfcast.operators.scaling import apply_scaling, standardise
from shelfcast.plans.features import build_features, feature_columns, with_lags
from shelfcast.sources.holidays import holiday_calendar, with_substitutes
from shelfcast.sources.sales import sales_from_lineitem


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES)


def test_repeated_day_shares_one_daily_row_and_its_lags(spark):
    rows = sales(
        spark,
        [(day(1), 7, 1, 5.0, 4), (day(2), 7, 1, 10.0, 1), (day(2), 7, 1, 20.0, 2), (day(9), 7, 1, 1.0, 1)],
    )
    assert rows_of(daily_sku(rows)) == [(1, day(1), 5.0, 4, 1), (1, day(2), 15.0, 3, 2), (1, day(9), 1.0, 1, 1)]
    lagged = rows_of(with_lags(rows), "date", "lag_1_sales_price", "lag_1_sales_quantity", "lag_2_sales_price", "lag_3_sales_price")
    assert lagged == [
        (day(1), None, None, None, None),
        (day(2), 5.0, 4, None, None),
        (day(2), 5.0, 4, None, None),
        (day(9), 15.0, 3, 5.0, None),
    ]


def test_null_quantity_sums_to_zero_and_null_key_is_dropped(spark):
    rows = sales(spark, [(day(1), 7, 1, 5.0, None), (day(2), 7, None, 5.0, 1), (day(3), 7, 1, None, 2)])
    by_day = {r["date"]: r for r in daily_sku(rows).where("sku_id = 1").collect()}
    assert by_day[day(1)]["sales_quantity"] == 0
    assert by_day[day(3)]["sales_price"] is None
    assert rows_of(with_lags(rows), "sku_id", "date") == [(1, day(1)), (1, day(3))]


def test_moving_average_needs_five_values(spark):
    values = [(day(i), 7, i, None if i == 3 else float(i), i) for i in range(1, 9)]
    short = [(day(i), 8, i, 1.0, 1) for i in range(1, 5)]
    table = moving_average_table(daily_category(sales(spark, values + short)))
    got = {(r["category_id"], r["date"].day): (r["sma_5_sales_price"], r["sma_5_sales_quantity"]) for r in table.collect()}
    assert got[7, 4] == (None, None)
    assert got[7, 5] == (None, 3.0)
    assert got[7, 7] == (None, 5.0)
    assert got[7, 8] == (6.0, 6.0)
    assert all(got[8, i] == (None, None) for i in range(1, 5))
    past = moving_average_table(daily_category(sales(spark, values)), include_current=False)
    assert {r["date"].day: r["sma_5_sales_quantity"] for r in past.collect()}[6] == 3.0


def test_weekday_weekend_and_iso_week(spark):
    dates = [dt.date(2020, 10, 29), dt.date(2020, 10, 30), dt.date(2020, 10, 31), dt.date(2020, 11, 1), dt.date(2021, 1, 3)]
    out = with_calendar(spark.createDataFrame([(d,) for d in dates], "date date"), extended=True).orderBy("date").collect()
    assert [r["weekday"] for r in out] == [4, 5, 6, 7, 7]
    assert [r["is_weekend"] for r in out] == [False, True, True, True, True]
    assert out[-1]["week"] == 53
    strict = with_calendar(spark.createDataFrame([(dates[1],)], "date date"), extended=True, weekend_from=6)
    assert strict.first()["is_weekend"] is False


def test_holidays_at_weekends_move_to_the_next_working_days(spark):
    """Days off of 2019 and 2021 as they were; two holidays at one weekend give two, and none is given after the rule ends."""
    calendar = holiday_calendar(spark, 2018, 2024)
    out = with_substitutes(calendar)
    days = {r[0].isoformat() for r in out.where("name = 'Substitute day'").collect()}
    assert {d for d in days if d[:4] == "2019"} == {"2019-04-29", "2019-06-17", "2019-08-26"}
    assert {d for d in days if d[:4] == "2021"} == {"2021-05-03", "2021-05-04", "2021-05-10", "2021-06-21", "2021-12-27"}
    assert not {d for d in days if d > "2022-03-14"} and out.count() == calendar.count() + len(days)
    # Holidays given twice, without a date, or none at all.
    twice = with_substitutes(calendar.unionByName(calendar).unionByName(calendar.limit(1).selectExpr("CAST(NULL AS DATE) AS date", "name")))
    assert {r[0].isoformat() for r in twice.where("name = 'Substitute day'").collect()} == days
    assert with_substitutes(calendar.limit(0)).collect() == []


def test_holiday_flag(spark):
    rows = spark.createDataFrame([(dt.date(2020, 8, 24),), (dt.date(2020, 8, 25),), (None,)], "date date")
    flagged = {r[0]: r[1] for r in with_holiday_flag(rows, holiday_calendar(spark, 2019, 2021)).collect()}
    assert flagged == {dt.date(2020, 8, 24): True, dt.date(2020, 8, 25): False, None: None}
    twice = holiday_calendar(spark, 2020, 2020).unionByName(holiday_calendar(spark, 2020, 2020))
    assert with_holiday_flag(rows, twice).count() == 3


def test_orthodox_easter_dates(spark):
    known = {2015: dt.date(2015, 4, 12), 2016: dt.date(2016, 5, 1), 2019: dt.date(2019, 4, 28), 2020: dt.date(2020, 4, 19), 2021: dt.date(2021, 5, 2)}
    got = holiday_calendar(spark, 2015, 2021).where("name = 'Easter Sunday'").collect()
    assert known.items() <= {r["date"].year: r["date"] for r in got}.items()


def test_null_filter_keeps_nan_and_parts_are_disjoint(spark):
    rows = spark.createDataFrame([(1, math.nan), (2, None), (None, 1.0), (3, 2.0)], "a int, b double")
    complete, rest = split_by_completeness(rows)
    assert {r["a"] for r in complete.collect()} == {1, 3}
    assert complete.count() + rest.count() == 4
    assert drop_nulls(rows).count() == 2


def test_gap_report_and_arrays(spark):
    rows = sales(spark, [(day(i), 7, 1, float(i), i) for i in (1, 2, 9)])
    assert rows_of(gap_report(rows, "sku_id")) == [(1, 9, 3)]
    table = daily_sku(rows)
    assert rows_of(from_arrays(as_arrays(table, "sku_id"), "sku_id")) == rows_of(table.drop("n_rows"))


def skewed(spark):
    """901 of 1000 rows are exact copies of one row, spread over the tasks."""
    return spark.range(0, 1000, 1, 10).select(
        F.lit(day(1)).alias("date"),
        F.lit(7).cast("long").alias("category_id"),
        F.when(F.col("id") % 10 > 0, F.lit(0)).otherwise(F.col("id")).cast("long").alias("sku_id"),
        F.lit(2.0).alias("sales_price"),
        F.lit(1).cast("long").alias("sales_quantity"),
    )


def test_split_join_equals_plain_join(spark):
    fact = skewed(spark)
    table = daily_sku(fact)
    plain = fact.join(table.drop("n_rows").withColumnRenamed("sales_quantity", "q").drop("sales_price"), ["sku_id", "date"])
    renamed = table.withColumnRenamed("sales_quantity", "q").drop("sales_price")
    split = attach(fact, renamed, ["sku_id", "date"], weights=table, hot_rows=50)
    assert split.count() == 1000
    assert rows_of(split) == rows_of(plain.select(*split.columns))
    heavy = hot_keys(table, ["sku_id", "date"], hot_rows=50).collect()
    assert [r["__parts"] for r in heavy] == [19]
    unknown = fact.withColumn("sku_id", F.when(F.col("sku_id") > 0, F.lit(None)).otherwise(F.col("sku_id")))
    kept = attach(unknown, renamed, ["sku_id", "date"], weights=table, hot_rows=50, how="left")
    assert kept.count() == 1000


def test_copies_of_a_hot_row_spread_over_parts(spark):
    fact = skewed(spark)
    spread = fact.select(F.pmod(F.xxhash64(F.spark_partition_id(), *fact.columns), F.lit(18)).alias("p")).distinct()
    assert spread.count() > 3


def test_repeated_rows_are_refused_where_they_would_stay_unmatched(spark):
    fact = skewed(spark)
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            attach(fact, daily_sku(fact), ["sku_id", "date"], weights=daily_sku(fact), how=how)


def test_stored_table_is_broadcast_by_its_bytes(spark):
    fact, table = skewed(spark), daily_sku(skewed(spark)).drop("sales_price", "sales_quantity").withColumn("x", F.lit(1))
    out = attach_stored(fact, table, ["sku_id", "date"], weights=table)
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") >= 2
    assert out.count() == fact.count()


def test_hot_sku_is_exchanged_again_after_the_part_join(spark, tmp_path):
    items = spark.range(1000).selectExpr(
        "id AS l_orderkey", "IF(id % 2 = 0, 1, id) AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "1.0D AS l_quantity",
        "2.0D AS l_extendedprice", "timestamp_ntz'1999-01-01' AS l_shipdate",
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1000).selectExpr("id AS p_partkey", "concat('Brand#', id % 25) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = daily_sku(sales_from_lineitem(spark, str(tmp_path)))
        plan = days._jdf.queryExecution().executedPlan().toString()
        assert plan.index("hashpartitioning(sku_id") < plan.index("SortMergeJoin")
        assert days.count() == 500  # the odd ids; the even ones are all SKU 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_both_daily_tables_roll_up_from_one_aggregate(spark):
    fact = feature_rows(spark)
    base = daily_base(fact)
    for key in ("sku_id", "category_id"):
        assert rows_of(roll_up(base, key)) == rows_of(daily(fact, key))


def test_dates_outside_the_calendar_are_unknown(spark):
    df = spark.createDataFrame([(dt.date(1989, 1, 1),), (dt.date(1990, 1, 1),), (dt.date(2031, 1, 1),), (None,)], "date date")
    flags = with_holiday_flag(df, holiday_calendar(spark, 1990, 2030)).collect()
    assert [r["is_ukrainian_holiday"] for r in sorted(flags, key=lambda r: str(r["date"]))] == [None, True, None, None]
    with pytest.raises(ValueError):
        holiday_calendar(spark, 1990, 2100)


def feature_rows(spark):
    return sales(
        spark,
        [(day(1 + d, m), 1 + s % 2, s, 1.0 * s + d, (s * d) % 7) for m in (1, 2) for d in range(20) for s in range(1, 5)],
    )


def test_feature_table_flags(spark):
    rows = feature_rows(spark)
    calendar = holiday_calendar(spark, 2020, 2020)
    bare = build_features(rows, calendar, lags=None, window=None, clusters=None, drop_nulls=False)
    assert bare.table.count() == rows.count()
    assert not [c for c in bare.table.columns if c.startswith(("lag_", "sma_"))]
    with pytest.raises(ValueError):
        bare.cluster_model()
    with pytest.raises(ValueError):
        bare.scaling_table()
    kept = build_features(rows, calendar, clusters=None, drop_nulls=False).table
    assert kept.count() == rows.count()
    assert kept.where("lag_3_sales_price is null").count() == 3 * 4
    dropped = build_features(rows, calendar, clusters=None).table
    assert dropped.count() == rows.count() - 4 * 4
    assert "date" in dropped.columns and "sales_quantity" not in feature_columns(dropped)


def test_feature_table_with_clusters_and_scaling(spark):
    rows = feature_rows(spark)
    build = build_features(rows, holiday_calendar(spark, 2020, 2020), clusters=3, drop_nulls=False)
    nulls = build.table.where("cluster_id is null").count()
    assert nulls == build.table.where("lag_3_sales_price is null or sma_5_sales_price is null").count()
    assert build.table.select("cluster_id").distinct().count() == 4
    scaled = build_features(rows, holiday_calendar(spark, 2020, 2020), clusters=3, normalise=True)
    moments = scaled.table.agg(F.avg("sales_price"), F.stddev_pop("sales_price"), F.avg("year"), F.max("year")).first()
    assert moments[0] == pytest.approx(0, abs=1e-9) and moments[1] == pytest.approx(1)
    assert moments[2] == moments[3] == 0.0
    assert scaled.scaling_table().where("column = 'sales_quantity'").count() == 1
    assert scaled.cluster_model() is not None


def test_scaling_constant_and_null_columns(spark):
    rows = spark.createDataFrame([(7.0, 1, None), (7.0, 3, None), (None, None, None)], "a double, b int, c double")
    out, parameters = standardise(rows)
    assert rows_of(out, "a", "b") == [(0.0, -1.0), (0.0, 1.0), (None, None)]
    assert out.where("c is not null").count() == 0
    assert rows_of(apply_scaling(rows, parameters), "b") == rows_of(out, "b")


def test_lags_of_one_sku_are_shifted_values(spark):
    rows = feature_rows(spark).where("sku_id = 3")
    table = daily_sku(rows).orderBy("date").collect()
    lags = {r["date"]: r for r in lag_table(daily_sku(rows)).collect()}
    for i, row in enumerate(table):
        for k in (1, 2, 3):
            want = table[i - k]["sales_price"] if i >= k else None
            assert lags[row["date"]][f"lag_{k}_sales_price"] == want
