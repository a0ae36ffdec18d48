"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions._util import as_col


def local_date(ts: Column | str, zone: str = "Europe/London") -> Column:
    """UTC timestamp -> calendar date in ``zone`` (``CAST(DATETIME(ts, zone) AS DATE)``).

    Works on ``timestamp_ntz`` (wall-clock UTC, as landed parquet is read) without
    depending on the session time zone.
    """
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(ts)))


def utc_date(ts: Column | str) -> Column:
    """``DATE(ts)`` in UTC."""
    return F.to_date(as_col(ts))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """``DATE_DIFF(later, earlier, DAY)`` as an integer."""
    return F.datediff(as_col(later), as_col(earlier))
