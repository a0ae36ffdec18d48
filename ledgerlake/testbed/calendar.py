"""Retail calendar on the order dates: calendar of 8 retail years from Sunday 1995-01-01."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import money
from ledgerlake.plans.calendar import calendar_for_span, with_retail_calendar
from ledgerlake.testbed.base import CAL_START, CAL_YEARS, registry, table

QUERIES, ORACLE, q = registry()

CAL = {"start": CAL_START, "years": CAL_YEARS}

# Oracle: the same rule written independently with DuckDB date arithmetic.
ORACLE_CAL_COLS = """
  CAST(CASE WHEN w.wk < 4 THEN 1 WHEN w.wk < 8 THEN 2 WHEN w.wk < 13 THEN 3 WHEN w.wk < 17 THEN 4
       WHEN w.wk < 21 THEN 5 WHEN w.wk < 26 THEN 6 WHEN w.wk < 30 THEN 7 WHEN w.wk < 34 THEN 8
       WHEN w.wk < 39 THEN 9 WHEN w.wk < 43 THEN 10 WHEN w.wk < 47 THEN 11 ELSE 12 END AS INTEGER)"""


def _week_cte(date_expr: str) -> str:
    return f"""CAST(floor(date_diff('day', DATE '1995-01-01', {date_expr}) / 7) AS INTEGER)"""


@q(
    "retail_calendar",
    f"""
WITH span AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(d AS DATE) AS calendar_date FROM span, generate_series(span.lo, span.hi, INTERVAL 1 DAY) t(d)),
w AS (
  SELECT calendar_date, {_week_cte('calendar_date')} AS idx FROM days
),
w2 AS (
  SELECT calendar_date, idx, CAST(1995 + idx // 52 AS INTEGER) AS yr, CAST(idx % 52 AS INTEGER) AS wk FROM w
  WHERE idx >= 0 AND idx < 8 * 52
),
w3 AS (
  SELECT w.calendar_date, w.idx, w.yr, w.wk + 1 AS week, {ORACLE_CAL_COLS} AS month FROM w2 w
)
SELECT calendar_date, dayname(calendar_date) AS day_name, CAST(dayofweek(calendar_date) + 1 AS INTEGER) AS day_of_week,
  yr AS retail_year, week AS retail_week,
  CAST(DATE '1995-01-01' + INTERVAL (idx * 7) DAY AS DATE) AS retail_week_start_date,
  CAST(DATE '1995-01-01' + INTERVAL (idx * 7 + 6) DAY AS DATE) AS retail_week_end_date,
  month AS retail_month, CAST(ceil(month / 3) AS INTEGER) AS retail_quarter,
  CAST(yr AS VARCHAR) AS retail_year_str, CAST(week AS VARCHAR) AS retail_week_str,
  CAST(month AS VARCHAR) AS retail_month_str, CAST(CAST(ceil(month / 3) AS INTEGER) AS VARCHAR) AS retail_quarter_str,
  printf('%04d-M%02d', yr, month) AS retail_month_name, printf('%04d-Wk%02d', yr, week) AS retail_week_label,
  CAST(yr AS VARCHAR) || '-' || CAST(week AS VARCHAR) AS retail_year_week_id,
  CAST(yr AS VARCHAR) || '-' || CAST(month AS VARCHAR) AS retail_year_month_id
FROM w3
""",
)
def q_retail_calendar(spark, sf):
    """The calendar for every day the orders table spans (bounds computed by Spark from the data)."""
    o = table(spark, sf, "orders")
    return calendar_for_span(spark, F.min("o_orderdate"), F.max("o_orderdate"), o, **CAL)


@q(
    "calendar_sales",
    f"""
WITH o AS (
  SELECT {_week_cte('CAST(o_orderdate AS DATE)')} AS idx, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders
),
w AS (SELECT CAST(1995 + idx // 52 AS INTEGER) AS yr, CAST(idx % 52 AS INTEGER) AS wk, price FROM o WHERE idx >= 0 AND idx < 8 * 52)
SELECT yr AS retail_year, {ORACLE_CAL_COLS} AS retail_month, printf('%04d-M%02d', yr, {ORACLE_CAL_COLS}) AS retail_month_name,
       COUNT(*) AS orders, CAST(SUM(price) AS DECIMAL(38,2)) AS sales
FROM w GROUP BY ALL
""",
)
def q_calendar_sales(spark, sf):
    """Sales per retail month: the calendar is attached as computed columns, so no join or broadcast."""
    o = table(spark, sf, "orders").select("o_orderdate", money("o_totalprice").alias("price"))
    o = with_retail_calendar(o, "o_orderdate", **CAL).where(F.col("retail_year").isNotNull())
    return o.groupBy("retail_year", "retail_month", "retail_month_name").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").cast("decimal(38,2)").alias("sales")
    )
