import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import segments as seg
from ledgerlake.plans.customer import ChannelRules, customer_360, primary_value

RFM_GOLDEN = [
    ((89, 4), "High Value Recent Customers"), ((89, 3), "Recent Customers"), ((90, 4), "High Value Customer"),
    ((90, 2), "Potential High Value"), ((269, 1), "First Time Customers"), ((270, 4), "High Value Lapsing"),
    ((364, 1), "Lapsing"), ((365, 4), "High Value Lapsed"), ((365, 2), "Lapsed"), ((365, 1), "Lapsed One Time"),
    ((10, 0), "Uncategorised"), ((None, 5), "Uncategorised"),
]


def test_rfm_golden(spark):
    df = spark.createDataFrame([k for k, _ in RFM_GOLDEN], "d int, n int")
    got = [r[0] for r in df.select(seg.rfm_segment("d", "n")).collect()]
    assert got == [v for _, v in RFM_GOLDEN]


def test_cohort_golden(spark):
    as_of = dt.date(2026, 6, 30)
    data = [
        (dt.date(2026, 1, 5), 1, 10), (dt.date(2025, 12, 31), 1, 10), (dt.date(2023, 3, 1), 1, 365),
        (dt.date(2023, 3, 1), 0, 366), (dt.date(2022, 3, 1), 0, 730), (dt.date(2020, 3, 1), 0, 1095),
    ]
    df = spark.createDataFrame(data, "f date, r int, d int")
    got = [x[0] for x in df.select(seg.cohort_segment("f", "r", "d", F.lit(as_of))).collect()]
    assert got == ["NEW", "PYNEW", "PYNON", "PY1INACT", "PY2INACT", "PY3INACT"]


def test_tiers(spark):
    df = spark.createDataFrame([(1000.0,), (500.0,), (99.0,), (0.0,), (None,)], "v double")
    got = [tuple(r) for r in df.select(seg.monetary_tier("v"), seg.ltv_tier("v")).collect()]
    assert got[0] == ("Tier 1 (£500+)", "VIP (£1000+)")
    assert got[2] == ("Tier 4 (£50-99)", "Low Value (<£100)")
    assert got[3] == ("No purchases", "No purchases") and got[4] == ("No purchases", "No purchases")


RULES = ChannelRules(
    groups={"web": [1], "pos": [2], "tiktok": [3], "marketplace": [4], "magento": [9]},
    acquisition=[([1], "Web"), ([2], "POS")],
    place_by_date={"2024-08-30": "London Roadshow"},
    place_labels=[([1], "Web")],
)
SCHEMA = "email string, order_id long, order_date date, gross_sales double, net_sales double, app_id long, source_name string, customer_id long"


def test_customer_360_measures(spark):
    data = [
        ("a", 1, dt.date(2024, 8, 30), 100.0, 90.0, 2, "pos", 7),
        ("a", 1, dt.date(2024, 8, 30), 10.0, 10.0, 2, "pos", 7),  # second row of the same order
        ("a", 2, dt.date(2024, 12, 1), 50.0, 50.0, 1, "web", 7),
        ("b", 3, dt.date(2023, 1, 1), 20.0, 20.0, 9, "imp", 8),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    out = {r.email: r for r in customer_360(df, RULES, dt.date(2025, 1, 1)).collect()}
    a = out["a"]
    assert (a.total_orders, a.pos_orders, a.web_orders, a.shopify_orders) == (2, 1, 1, 2)
    assert a.orders_last_90_days == 1 and a.orders_last_365_days == 2
    assert a.gross_revenue == 160.0 and a.net_revenue == 150.0 and a.total_refunded == 10.0
    assert a.avg_gross_order_value == pytest.approx(160.0 / 3)  # per input row, as AVG over order rows
    assert a.channel_behavior == "Omnichannel" and a.unique_channels_used == 2
    assert a.dominant_channel_by_revenue == "POS"
    assert a.acquisition_channel == "POS" and a.customer_acquisition_location == "London Roadshow"
    assert a.pos_acquisition_city == "London Roadshow" and a.first_order_source == "pos"
    assert a.days_since_last_order == 31 and a.refund_rate_pct == 6.25
    b = out["b"]
    assert b.channel_behavior == "Other" and b.dominant_channel_by_revenue == "Web"  # all zero -> Web
    assert b.acquisition_channel == "Unknown" and b.customer_acquisition_location == "Other"
    assert b.shopify_orders == 0 and b.magento_orders == 1


def test_primary_value_exact_with_tie_break(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "k int, v string")
    got = {r.k: r.primary_value for r in primary_value(df, "k", "v").collect()}
    assert got == {1: "a", 2: "z"}


def test_primary_value_approx_agrees_on_clear_majority(spark):
    data = [(k, "x" if i % 3 else "y") for k in range(5) for i in range(30)] + [(9, None), (9, None), (9, "q")]
    df = spark.createDataFrame(data, "k int, v string")
    exact = {r.k: r.primary_value for r in primary_value(df, "k", "v").collect()}
    approx = {r.k: r.primary_value for r in primary_value(df, "k", "v", approx=True).collect()}
    assert exact == approx == {0: "x", 1: "x", 2: "x", 3: "x", 4: "x", 9: None}


def test_order_in_both_halves_counts_once(spark):
    rows = [("a", 1, dt.date(2024, 1, 1), 10.0, 10.0, None), ("a", 1, dt.date(2024, 1, 1), 5.0, 5.0, None)]
    df = spark.createDataFrame(rows, "email string, order_id int, order_date date, gross_sales double, net_sales double, app_id long")
    r = customer_360(df, ChannelRules(groups={g: [i] for i, g in enumerate(("web", "pos", "tiktok", "marketplace"))}, import_group=None),
                     dt.date(2024, 2, 1), source=None, customer_id=None).first()
    assert r.total_orders == 1 and r.gross_revenue == 15.0
    assert r.has_web_orders is False and r.channel_behavior == "Other"  # NULL channels: FALSE, not NULL


def test_refund_only_rows_are_not_counted_as_orders(spark):
    from ledgerlake.plans.customer import customer_summary

    ledger = spark.createDataFrame([(1, 1), (2, None), (3, 3), (3, None)], "order_id int, orders_order_id int")
    emails = spark.createDataFrame(
        [(1, 7, "a", "UK", dt.date(2024, 1, 2)), (2, 7, "a", "UK", dt.date(2023, 1, 2)), (3, 8, "b", None, dt.date(2024, 1, 1))],
        "order_id int, customer_id int, email string, billing_address_country string, order_date date",
    )
    got = {r.email: (r.billing_order_country, r.orders, r.customer_type) for r in customer_summary(ledger, emails, emails).collect()}
    assert got == {"a": ("UK", 1, "New customer"), "b": (None, 1, "New customer")}
