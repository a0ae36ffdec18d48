import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.plans.calendar import calendar_columns, retail_calendar, with_retail_calendar


def test_default_calendar_shape(spark):
    cal = retail_calendar(spark)
    stats = cal.agg(F.count(F.lit(1)), F.count_distinct("calendar_date"), F.min("calendar_date"), F.max("calendar_date")).collect()[0]
    assert tuple(stats) == (2184, 2184, dt.date(2021, 1, 3), dt.date(2026, 12, 26))
    # every retail week has 7 consecutive days starting on Sunday
    weeks = cal.groupBy("retail_year", "retail_week").agg(
        F.count(F.lit(1)).alias("n"), F.min("day_of_week").alias("lo"), F.max("day_of_week").alias("hi")
    )
    assert weeks.where("n != 7 OR lo != 1 OR hi != 7").count() == 0
    assert weeks.count() == 312


def test_calendar_golden_rows(spark):
    cal = retail_calendar(spark)
    cols = ["retail_year", "retail_week", "retail_month", "retail_quarter", "day_of_week", "day_name",
            "retail_week_label", "retail_year_week_id", "retail_month_name", "retail_quarter_str"]
    got = {r["calendar_date"]: tuple(r[c] for c in cols) for r in cal.where(
        F.col("calendar_date").isin(dt.date(2021, 1, 3), dt.date(2023, 12, 31), dt.date(2024, 12, 28), dt.date(2026, 12, 27))
    ).collect()}
    assert got[dt.date(2021, 1, 3)] == (2021, 1, 1, 1, 1, "Sunday", "2021-Wk01", "2021-1", "2021-M01", "1")
    assert got[dt.date(2023, 12, 31)] == (2024, 1, 1, 1, 1, "Sunday", "2024-Wk01", "2024-1", "2024-M01", "1")
    assert got[dt.date(2024, 12, 28)] == (2024, 52, 12, 4, 7, "Saturday", "2024-Wk52", "2024-52", "2024-M12", "4")
    assert dt.date(2026, 12, 27) not in got


def test_445_month_lengths(spark):
    cal = retail_calendar(spark, years=1)
    weeks = cal.groupBy("retail_month").agg((F.count(F.lit(1)) / 7).alias("w")).orderBy("retail_month")
    assert [int(r.w) for r in weeks.collect()] == [4, 4, 5] * 4


def test_projection_matches_table_and_nulls_outside(spark):
    facts = spark.createDataFrame(
        [(dt.date(2022, 5, 17),), (dt.date(2020, 1, 1),), (dt.date(2027, 1, 1),)], "d date"
    )
    got = with_retail_calendar(facts, "d").select("d", "retail_year", "retail_week", "retail_week_label").collect()
    cal = retail_calendar(spark).where(F.col("calendar_date") == dt.date(2022, 5, 17)).collect()[0]
    by_day = {r.d: r for r in got}
    assert (by_day[dt.date(2022, 5, 17)].retail_year, by_day[dt.date(2022, 5, 17)].retail_week) == (cal.retail_year, cal.retail_week)
    assert by_day[dt.date(2020, 1, 1)].retail_year is None and by_day[dt.date(2020, 1, 1)].retail_week_label is None
    assert by_day[dt.date(2027, 1, 1)].retail_year is None


def test_months_of_other_week_patterns(spark):
    cols = calendar_columns("d", dt.date(2023, 1, 1), 1, pattern=(4, 4, 4), weeks_per_year=53)  # 48 weeks in the pattern: the rest are month 12
    weeks = spark.sql("SELECT sequence(DATE'2022-12-31', DATE'2024-01-07') ds").select(F.explode("ds").alias("d"))
    got = weeks.select("d", cols["retail_week"].alias("w"), cols["retail_month"].alias("m")).orderBy("d").collect()
    assert [(r.w, r.m) for r in got] == [(None, None), *[(w, min((w - 1) // 4 + 1, 12)) for w in range(1, 54) for _ in range(7)], (None, None)]


def test_the_calendar_of_a_date_stays_small(spark):
    """The generated code of a step grows with its expressions, and a method above 8,000 bytes is not compiled."""
    days = spark.range(10).select(F.expr("date_add(DATE'2021-01-03', CAST(id AS INT))").alias("d"))
    cols = calendar_columns("d")
    text = days.select(cols["retail_month"].alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < text.count("datediff") <= 6
