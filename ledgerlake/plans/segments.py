"""Customer segment rules as column expressions.

Every rule is a searched CASE evaluated in order, first match wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions import bucket
from ledgerlake.functions._util import as_col

# Segment labels and day/order thresholds of the reference's
# customer model, in the order its CASE expressions test them.
RFM_RULES = [
    # (min_days, max_days or None, min_orders, max_orders or None, label)
    (None, 89, 4, None, "High Value Recent Customers"),
    (None, 89, 1, 3, "Recent Customers"),
    (90, 269, 4, None, "High Value Customer"),
    (90, 269, 2, 3, "Potential High Value"),
    (90, 269, 1, 1, "First Time Customers"),
    (270, 364, 4, None, "High Value Lapsing"),
    (270, 364, 1, 3, "Lapsing"),
    (365, None, 4, None, "High Value Lapsed"),
    (365, None, 2, 3, "Lapsed"),
    (365, None, 1, 1, "Lapsed One Time"),
]
RFM_FALLBACK = "Uncategorised"

RECENCY_CATEGORIES = [(90, "Recent (0-3 months)"), (270, "Active (3-9 months)"), (365, "Lapsing (9-12 months)")]
RECENCY_FALLBACK = "Lapsed (12+ months)"

FREQUENCY_CATEGORIES = [(4, "High Value (4+ orders)")]
FREQUENCY_EXACT = [(3, "Repeat (3 orders)"), (2, "Repeat (2 orders)"), (1, "One-time")]
FREQUENCY_FALLBACK = "No orders"

MONETARY_TIERS = [(500, "Tier 1 (£500+)"), (200, "Tier 2 (£200-499)"), (100, "Tier 3 (£100-199)"), (50, "Tier 4 (£50-99)")]
MONETARY_LAST = (0, "Tier 5 (<£50)")
LTV_TIERS = [(1000, "VIP (£1000+)"), (500, "High Value (£500-999)"), (200, "Medium Value (£200-499)"), (100, "Standard (£100-199)")]
LTV_LAST = (0, "Low Value (<£100)")
NO_PURCHASES = "No purchases"

COHORT_INACTIVE = [(365, 729, "PY1INACT"), (730, 1094, "PY2INACT"), (1095, None, "PY3INACT")]


def _between(x: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= F.lit(lo))
    if hi is not None:
        cond = cond & (x <= F.lit(hi))
    return cond


def rfm_segment(days_since_last: Column | str, total_orders: Column | str) -> Column:
    d, n = as_col(days_since_last), as_col(total_orders)
    expr = None
    for dlo, dhi, nlo, nhi, label in RFM_RULES:
        cond = _between(d, dlo, dhi) & _between(n, nlo, nhi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(RFM_FALLBACK))


def cohort_segment(
    first_order_date: Column | str,
    orders_last_365: Column | str,
    days_since_last: Column | str,
    as_of: Column,
) -> Column:
    """NEW / PYNEW by first-order calendar year, PYNON if active in the trailing year, else inactivity bands."""
    fy, this_year = F.year(as_col(first_order_date)), F.year(as_of)
    recent, d = as_col(orders_last_365), as_col(days_since_last)
    expr = (
        F.when(fy == this_year, F.lit("NEW"))
        .when(fy == this_year - 1, F.lit("PYNEW"))
        .when((recent > 0) & (fy < this_year - 1), F.lit("PYNON"))
    )
    for lo, hi, label in COHORT_INACTIVE:
        expr = expr.when(_between(d, lo, hi), F.lit(label))
    return expr.otherwise(F.lit(RFM_FALLBACK))


def recency_category(days_since_last: Column | str) -> Column:
    d = as_col(days_since_last)
    expr = None
    for bound, label in RECENCY_CATEGORIES:
        expr = F.when(d < bound, F.lit(label)) if expr is None else expr.when(d < bound, F.lit(label))
    return expr.otherwise(F.lit(RECENCY_FALLBACK))


def frequency_category(total_orders: Column | str) -> Column:
    n = as_col(total_orders)
    expr = F.when(n >= FREQUENCY_CATEGORIES[0][0], F.lit(FREQUENCY_CATEGORIES[0][1]))
    for value, label in FREQUENCY_EXACT:
        expr = expr.when(n == value, F.lit(label))
    return expr.otherwise(F.lit(FREQUENCY_FALLBACK))


def _tiers(x: Column, tiers, last) -> Column:
    head = bucket(x, tiers, default="__next__")
    return F.when(head != "__next__", head).when(x > last[0], F.lit(last[1])).otherwise(F.lit(NO_PURCHASES))


def monetary_tier(net_revenue: Column | str) -> Column:
    return _tiers(as_col(net_revenue), MONETARY_TIERS, MONETARY_LAST)


def ltv_tier(net_revenue: Column | str) -> Column:
    return _tiers(as_col(net_revenue), LTV_TIERS, LTV_LAST)


def customer_type(total_orders: Column | str) -> Column:
    return F.when(as_col(total_orders) > 1, F.lit("Returning customer")).otherwise(F.lit("New customer"))
