"""Gap filling over date spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_spine(spark, start: Column | str | dt.date, end: Column | str | dt.date, name: str = "day") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive. Size is bounded by the span, not by data."""
    s = F.lit(start).cast("date") if not isinstance(start, Column) else start
    e = F.lit(end).cast("date") if not isinstance(end, Column) else end
    return spark.range(1).select(F.explode(F.sequence(s, e)).alias(name))


def zero_fill_daily(
    df: DataFrame,
    day: str,
    values: Sequence[str],
    start: dt.date | str,
    end: dt.date | str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add missing days between ``start`` and ``end`` with 0 in ``values``.

    ``df`` must already be one row per (keys, day). With ``keys`` each key gets
    the full spine (keys x days).
    """
    if keys:
        # Each key expands its own day sequence (a generator, not a cartesian join).
        spine = df.select(*keys).distinct().withColumn(
            day, F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
        )
    else:
        spine = date_spine(df.sparkSession, start, end, day)
    filled = spine.join(df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))), [*keys, day], "left")
    return filled.withColumns({v: F.coalesce(F.col(v), F.lit(0)) for v in values})
