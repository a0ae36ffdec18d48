"""Numeric helpers: safe casts, null defaulting, guarded ratios, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions._util import as_col

MONEY = "decimal(18,2)"


def safe_num(c: Column | str, to: str = "double") -> Column:
    """``SAFE_CAST(x AS FLOAT64)``: NULL instead of an error on bad input."""
    return as_col(c).try_cast(to)


def safe_bool(c: Column | str) -> Column:
    return as_col(c).try_cast("boolean")


def safe_ts(c: Column | str) -> Column:
    return as_col(c).try_cast("timestamp")


def money(c: Column | str) -> Column:
    """Exact money: cast to ``decimal(18,2)`` before summing or rounding (trap G9)."""
    return as_col(c).try_cast(MONEY)


def n0(c: Column | str) -> Column:
    """NULL -> 0."""
    return F.coalesce(as_col(c), F.lit(0))


def ratio(num: Column | str, den: Column | str, scale: float = 1.0, digits: int | None = None) -> Column:
    """``num / NULLIF(den, 0) * scale``, optionally rounded; never raises on zero."""
    out = F.try_divide(as_col(num), F.nullif(as_col(den), F.lit(0)))
    if scale != 1.0:
        out = out * F.lit(scale)
    return F.round(out, digits) if digits is not None else out


def pct_change(today: Column | str, yesterday: Column | str) -> Column:
    """Day-over-day percent change with the report's three rules.

    0 -> 0 when both are 0; 100 when only yesterday is 0; otherwise the change in
    percent rounded half-to-even to a whole number.
    """
    t, y = as_col(today), as_col(yesterday)
    change = F.bround((t - y).cast("double") / y.cast("double") * F.lit(100.0), 0)
    return (
        F.when((t == 0) & (y == 0), F.lit(0.0))
        .when(y == 0, F.lit(100.0))
        .otherwise(change)
    )


def bucket(
    c: Column | str,
    tiers: Sequence[tuple[float, str]],
    default: str,
    inclusive: bool = True,
) -> Column:
    """Ordered threshold tiers: first ``(bound, label)`` with ``c >= bound`` wins.

    ``inclusive=False`` uses ``c > bound`` for that comparison instead. Tiers are
    checked in the given order, like a searched CASE.
    """
    x = as_col(c)
    expr = None
    for bound, label in tiers:
        cond = x >= F.lit(bound) if inclusive else x > F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
