"""4-4-5 retail calendar.

Every retail week starts on a Sunday; year ``first_year + k`` is the k-th block
of ``weeks_per_year`` consecutive weeks after ``start``. Because the attributes
are a pure function of the date, they are provided both as a generated
dimension (``retail_calendar``) and as column expressions
(``with_retail_calendar``) that attach the same attributes to a fact table
without any join or shuffle. Dates outside the calendar get NULLs, as a left
join to the finite table would give (trap G22).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's calendar starts on Sunday 2021-01-03 and runs
# 6 retail years of 52 weeks each, months following the 4-4-5 week pattern.
DEFAULT_START = dt.date(2021, 1, 3)
DEFAULT_YEARS = 6
WEEKS_PER_YEAR = 52
PATTERN_445 = (4, 4, 5)

CALENDAR_COLUMNS = [
    "calendar_date",
    "day_name",
    "day_of_week",
    "retail_year",
    "retail_week",
    "retail_week_start_date",
    "retail_week_end_date",
    "retail_month",
    "retail_quarter",
    "retail_year_str",
    "retail_week_str",
    "retail_month_str",
    "retail_quarter_str",
    "retail_month_name",
    "retail_week_label",
    "retail_year_week_id",
    "retail_year_month_id",
]


def _month_of_week(week: Column, pattern: Sequence[int], weeks_per_year: int) -> Column:
    """Retail month from week number: the pattern repeats every quarter; weeks past the last bound -> 12.

    Looked up in a list, so that ``week`` stands in the expression once: generated methods of more than
    8,000 bytes are not compiled by the JVM."""
    months = [month for month in range(1, 13) for _ in range(pattern[(month - 1) % len(pattern)])]
    months = (months + [12] * weeks_per_year)[: max(weeks_per_year, 1)]
    return F.get(F.array(*[F.lit(m) for m in months]), week - F.lit(1))


def calendar_columns(
    date_col: Column | str,
    start: dt.date = DEFAULT_START,
    years: int = DEFAULT_YEARS,
    first_year: int | None = None,
    pattern: Sequence[int] = PATTERN_445,
    weeks_per_year: int = WEEKS_PER_YEAR,
    prefix: str = "",
) -> dict[str, Column]:
    """Calendar attributes of ``date_col`` as a name -> Column mapping (``calendar_date`` excluded)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    d = d.cast("date")
    fy = first_year if first_year is not None else start.year
    offset = F.datediff(d, F.lit(start))
    week_idx = F.floor(offset / F.lit(7)).cast("int")
    inside = (offset >= 0) & (week_idx < F.lit(years * weeks_per_year))

    def guard(c: Column) -> Column:
        return F.when(inside, c)

    year = guard(F.lit(fy) + F.floor(week_idx / F.lit(weeks_per_year)).cast("int"))
    week = guard(F.pmod(week_idx, F.lit(weeks_per_year)) + F.lit(1))
    week_start = guard(F.date_add(F.lit(start), week_idx * 7))
    month = guard(_month_of_week(week, pattern, weeks_per_year))
    quarter = guard(F.ceil(month / F.lit(3)).cast("int"))
    cols = {
        "day_name": guard(F.date_format(d, "EEEE")),
        "day_of_week": guard(F.dayofweek(d)),
        "retail_year": year,
        "retail_week": week,
        "retail_week_start_date": week_start,
        "retail_week_end_date": guard(F.date_add(week_start, 6)),
        "retail_month": month,
        "retail_quarter": quarter,
        "retail_year_str": year.cast("string"),
        "retail_week_str": week.cast("string"),
        "retail_month_str": month.cast("string"),
        "retail_quarter_str": quarter.cast("string"),
        "retail_month_name": F.format_string("%04d-M%02d", year, month),
        "retail_week_label": F.format_string("%04d-Wk%02d", year, week),
        "retail_year_week_id": F.concat(year.cast("string"), F.lit("-"), week.cast("string")),
        "retail_year_month_id": F.concat(year.cast("string"), F.lit("-"), month.cast("string")),
    }
    # format_string renders NULL arguments as text; keep the labels NULL outside the calendar.
    cols["retail_month_name"] = guard(cols["retail_month_name"])
    cols["retail_week_label"] = guard(cols["retail_week_label"])
    return {prefix + k: v for k, v in cols.items()}


def with_retail_calendar(df: DataFrame, date_col: str, **kwargs) -> DataFrame:
    """Attach calendar attributes to each row: the join to the calendar done as a projection."""
    return df.withColumns(calendar_columns(date_col, **kwargs))


def retail_calendar(
    spark: SparkSession,
    start: dt.date = DEFAULT_START,
    years: int = DEFAULT_YEARS,
    first_year: int | None = None,
    pattern: Sequence[int] = PATTERN_445,
    weeks_per_year: int = WEEKS_PER_YEAR,
) -> DataFrame:
    """The calendar as a table: one row per day, ``years * weeks_per_year * 7`` rows."""
    if start.weekday() != 6:
        raise ValueError("retail weeks start on a Sunday")
    weeks = spark.range(years * weeks_per_year).select(
        F.date_add(F.lit(start), (F.col("id") * 7).cast("int")).alias("_ws")
    )
    days = weeks.select(F.explode(F.sequence(F.col("_ws"), F.date_add(F.col("_ws"), 6))).alias("calendar_date"))
    cols = calendar_columns("calendar_date", start, years, first_year, pattern, weeks_per_year)
    return days.select("calendar_date", *[v.alias(k) for k, v in cols.items()])


def calendar_for_span(
    spark: SparkSession,
    lo: Column,
    hi: Column,
    bounds_source: DataFrame,
    **kwargs,
) -> DataFrame:
    """Calendar rows for every day between two dates computed from ``bounds_source``.

    ``bounds_source`` is aggregated to one row (``lo``/``hi`` are aggregate
    expressions over it); the days are generated from that row, so no join is
    needed. Days outside the calendar are dropped.
    """
    span = bounds_source.agg(lo.cast("date").alias("_lo"), hi.cast("date").alias("_hi"))
    days = span.select(F.explode(F.sequence("_lo", "_hi")).alias("calendar_date"))
    cols = calendar_columns("calendar_date", **kwargs)
    out = days.select("calendar_date", *[v.alias(k) for k, v in cols.items()])
    return out.where(F.col("retail_year").isNotNull())
