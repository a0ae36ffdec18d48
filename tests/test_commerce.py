"""Golden rows from FIXTURES.md §3 for the shop jobs."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import commerce as com
from tests.conftest import rows

ORDER_SCHEMA = (
    "id long, name string, app_id long, user_id long, customer__id long, email string, created_at timestamp_ntz, "
    "cancelled_at timestamp_ntz, test boolean, financial_status string, fulfillment_status string, "
    "billing_address__country string, presentment_currency string, subtotal_price string, total_discounts string, "
    "current_total_discounts string, total_line_items_price string, total_price string, total_tax string, "
    "current_total_tax string, original_total_duties_set__shop_money__amount string"
)


def order_row(oid, created, total="120", tax="20", disc="0", test=False, country="United Kingdom", currency="GBP"):
    return (oid, f"#{oid}", 1, 10, 100, " Buyer@Example.com ", created, None, test, "paid", None, country, currency,
            "100", disc, disc, "100", total, tax, tax, None)


@pytest.fixture()
def orders(spark):
    data = [
        order_row(1, dt.datetime(2024, 3, 1, 10)),
        order_row(2, dt.datetime(2024, 3, 2, 10)),
        order_row(3, dt.datetime(2024, 3, 2, 11), test=True),
        order_row(4, dt.datetime(2024, 6, 30, 23, 30), test=None),
    ]
    return spark.createDataFrame(data, ORDER_SCHEMA)


def test_clean_orders_filters_tests_and_localises(spark, orders):
    out = com.clean_orders(orders)
    assert rows(out, "id", "order_date") == [(1, dt.date(2024, 3, 1)), (2, dt.date(2024, 3, 2))]
    assert "duties" in out.columns


def test_line_gross_golden(spark):
    lines = spark.createDataFrame(
        [(1, 10, 5, 6, "t", "60", 2), (2, 20, 5, 6, "t", "60", 2), (3, 30, 5, 6, "t", "60", 2), (4, 40, 5, 6, "t", "60", 2),
         (5, 50, 5, 6, "t", "60", 2)],
        "id long, order_id long, product_id long, variant_id long, title string, price string, quantity long",
    )
    orders = spark.createDataFrame(
        [(10, dt.date(2024, 1, 1), "United Kingdom"), (20, dt.date(2024, 1, 1), "United Kingdom"),
         (30, dt.date(2024, 1, 1), "France"), (40, dt.date(2024, 1, 1), None), (50, dt.date(2024, 1, 1), "United Kingdom")],
        "id long, order_date date, billing_address__country string",
    )
    products = spark.createDataFrame([(5, "blue-shirt", "tee", "v")], "id long, handle string, product_type string, vendor string")
    refunds = spark.createDataFrame([(5, 1, 60.0), (5, 1, 60.0)], "line_item_id long, quantity long, subtotal double")
    taxes = spark.createDataFrame(
        [(1, "GB VAT", 0.2, 12.0), (3, "GB VAT", 0.2, 12.0), (4, "GB VAT", 0.2, 12.0), (5, "GB VAT", 0.2, 12.0),
         (2, "GB VAT", 0.2, 0.0)],
        "order_line_id long, title string, rate double, price double",
    )
    lf = com.order_line_facts(lines, orders, products, refunds, taxes)
    got = {r.order_line_id: r for r in lf.collect()}
    assert got[1].gross_sales == pytest.approx(100.0)
    assert got[2].gross_sales == pytest.approx(120.0) and got[2].rate is None  # zero-priced VAT line ignored
    assert got[3].gross_sales == pytest.approx(120.0)  # abroad
    assert got[4].gross_sales == pytest.approx(100.0)  # unknown country falls into the VAT branch (G16)
    assert got[5].gross_sales == pytest.approx(200.0) and got[5].quantity == 4 and got[5].total_sales == pytest.approx(120.0)
    assert got[1].handle_first_string == "blue" and got[1].order_total == pytest.approx(60.0)


def _refund_inputs(spark, currency):
    refund_lines = spark.createDataFrame([(900, 1, 1, "48", "8")], "id long, line_item_id long, quantity long, subtotal string, total_tax string")
    adjustments = spark.createDataFrame([], "refund_id long, kind string, reason string, amount string, tax_amount string")
    refunds = spark.createDataFrame([(900, 1, 10, "2024-03-05 12:00:00")], "id long, order_id long, user_id long, created_at string")
    orders = spark.createDataFrame(
        [(1, dt.datetime(2024, 3, 1, 10), 1, "#1", currency, "United Kingdom")],
        "id long, created_at timestamp_ntz, app_id long, name string, presentment_currency string, billing_address__country string",
    )
    line_facts = spark.createDataFrame([(1, 1)], "order_line_id long, quantity long")
    return refund_lines, adjustments, refunds, orders, line_facts


@pytest.mark.parametrize("currency,amount", [("GBP", -40.0), ("EUR", -48.0), (None, None)])
def test_refund_amount_golden(spark, currency, amount):
    r = com.refund_ledger(*_refund_inputs(spark, currency)).collect()[0]
    assert r.refund_amount_actuals == amount
    assert r.refund_tax == -8.0
    assert r.refund_date == dt.date(2024, 3, 5) and r.number_of_orders == 1


def _order_days(spark, shipping_prices, created=dt.datetime(2024, 3, 1, 10)):
    orders = com.clean_orders(spark.createDataFrame([order_row(1, created)], ORDER_SCHEMA))
    ship = spark.createDataFrame([(1, p) for p in shipping_prices], "order_id long, price string")
    line_facts = spark.createDataFrame([(1, 0.2, 100.0, 1)], "order_id long, rate double, gross_sales double, quantity long")
    fpd = spark.createDataFrame([], "order_id long, discount double")
    first = spark.createDataFrame([(1,)], "order_id long")
    return com.order_day_metrics(orders, ship, line_facts, fpd, first)


def _refund_days(spark, day):
    return spark.createDataFrame(
        [(day, 1, "#1", 10, 1, "United Kingdom", 1, -8.0, None, -40.0)],
        "refund_date date, order_id long, order_name string, user_id long, app_id long, billing_order_country string, "
        "number_of_orders long, refund_tax double, refund_shipping_amount double, refund_amount_actuals double",
    )


def _vals(r):
    return tuple(round(r[c], 6) for c in ("total_sales", "tax", "shipping_cost", "returns", "gross_sales", "net_sales", "net_sales_plus_returns"))


def test_ledger_golden_rows(spark):
    od = _order_days(spark, ["6"])
    only_order = com.order_metrics_ledger(od, _refund_days(spark, dt.date(2024, 3, 9)).limit(0)).collect()
    assert [_vals(r) for r in only_order] == [(120, 20, 5, 0, 95, 95, 95)]
    assert only_order[0].order_type == "New" and only_order[0].number_of_orders == 1

    both = com.order_metrics_ledger(od, _refund_days(spark, dt.date(2024, 3, 9)))
    got = sorted(_vals(r) for r in both.collect())
    assert got == sorted([(120, 20, 5, 0, 95, 95, 95), (-40, -8, 0, -40, 8, -32, 8)])
    refund_only = both.where(F.col("orders_order_id").isNull()).collect()[0]
    assert refund_only.order_type is None and refund_only.orders_email is None and refund_only.refund_order_count == 1

    same_day = com.order_metrics_ledger(od, _refund_days(spark, dt.date(2024, 3, 1))).collect()
    assert [_vals(r) for r in same_day] == [(80, 12, 5, -40, 103, 63, 103)]


def test_ledger_shipping_fan_out(spark):
    od = _order_days(spark, ["6", "6"])
    r = com.order_metrics_ledger(od, _refund_days(spark, dt.date(2024, 3, 9)).limit(0)).collect()[0]
    assert _vals(r)[:3] == (240, 40, 10) and r.gross_sales == 190 and r.number_of_orders == 2


def test_ledger_hashes_trimmed_lowercase_email(spark):
    import hashlib

    od = _order_days(spark, ["6"])
    r = com.order_metrics_ledger(od, _refund_days(spark, dt.date(2024, 3, 9)).limit(0)).collect()[0]
    assert r.orders_email == hashlib.sha256(b"buyer@example.com").hexdigest()
    assert r.retail_year == 2024 and r.retail_week == 9


def test_free_product_discount_golden(spark):
    prop = '{"name": "_yotpo_loyalty_discount_type", "value": "product"}'
    lines = spark.createDataFrame(
        [(1, 7, "10", f"[{prop}]"), (2, 7, "5", f"[{prop}, {prop}]"), (3, 8, "3", None), (4, 8, "3", "[]"), (5, 8, "3", "bad"),
         (6, 8, "4", '[{"name": "_yotpo_loyalty_discount_type", "value": "points"}]')],
        "id long, order_id long, price string, properties string",
    )
    assert rows(com.free_product_discount(lines)) == [(7, -15.0)]


def test_explode_tax_lines(spark):
    lines = spark.createDataFrame(
        [(1, 7, '[{"title": "GB VAT", "rate": 0.2, "price": "2.00", "channel_agnostic": true, "price_set": {"a": 1}}]'), (2, 7, None)],
        "id long, order_id long, tax_lines string",
    )
    r = com.explode_tax_lines(lines).collect()
    assert len(r) == 1 and (r[0].title, r[0].rate, r[0].price, r[0].channel_agnostic) == ("GB VAT", 0.2, 2.0, True)
    assert r[0].price_set == '{"a":1}'


def test_currency_golden(spark):
    orders = spark.createDataFrame(
        [(1, "USD", 126.0), (2, "GBP", 50.0), (3, "BGN", 10.0), (4, '"USD"', 252.0)], "id long, currency string, amount double"
    )
    rates = spark.createDataFrame([("GBP", 1.0), ("USD", 1.26)], "currency string, rate double")
    ok, rejected = com.convert_currency(orders, rates)
    got = {r.id: (r.amount_gbp, r.conversion_status, r.high_value_flag) for r in ok.collect()}
    assert got[1] == (100.0, "CONVERTED_TO_GBP", False)
    assert got[2] == (50.0, "NO_CONVERSION_NEEDED", False)
    assert got[4] == (200.0, "CONVERTED_TO_GBP", False)  # exactly 200 is not high value; quoted code normalised
    assert [r.id for r in rejected.collect()] == [3]
    assert rejected.collect()[0].conversion_status == "MISSING_FX_RATE"


def test_order_type_flags(spark):
    o = spark.createDataFrame(
        [(1, "A@x", dt.datetime(2024, 1, 2)), (2, "a@x", dt.datetime(2024, 1, 1)), (3, "a@x", dt.datetime(2024, 1, 1))],
        "id long, email string, created_at timestamp_ntz",
    )
    got = dict(rows(com.order_type_flags(o, lower_key=True), "id", "order_type"))
    assert got == {1: "Returning", 2: "New", 3: "Returning"}


def test_shop_ledger_invariants(spark, sf_small):
    """Every ledger row satisfies the ledger identities, and totals equal the sum of their parts."""
    from ledgerlake.testbed.commerce import LEDGER_SINCE, shop_ledger

    led = shop_ledger(spark, sf_small)
    bad = led.where(
        (F.abs(F.col("net_sales") - (F.col("total_sales") - F.col("tax") - F.col("shipping_cost"))) > 0.011)
        | (F.abs(F.col("net_sales_plus_returns") - (F.col("net_sales") + F.abs(F.col("returns")))) > 0.011)
        | (F.abs(F.col("sales") - F.col("net_sales") - F.col("shipping_cost")) > 0.011)
        | (F.col("order_type").isNull() & F.col("orders_order_id").isNotNull())
    )
    assert bad.count() == 0
    # order rows only exist from the date floor on; refunds are kept before it (trap G21)
    early = led.where(F.col("fulldate") < F.lit(LEDGER_SINCE).cast("date"))
    assert early.where(F.col("orders_order_id").isNotNull()).count() == 0
    assert early.where(F.col("return_order_id").isNotNull()).count() > 0
    # one row per (day, order)
    assert led.groupBy("fulldate", "order_id").count().where("count > 1").count() == 0


def test_a_refund_landed_twice_counts_its_adjustments_once(spark):
    from ledgerlake.plans.commerce import refund_ledger

    refunds = spark.createDataFrame([(1, 10, 5, "2024-01-02 10:00:00")] * 2, "id int, order_id int, user_id int, created_at string")
    lines = spark.createDataFrame([(1, 100, 1, 10.0, 2.0)], "id int, line_item_id int, quantity int, subtotal double, total_tax double")
    adjustments = spark.createDataFrame([(1, "refund_discrepancy", 4.0, 0.0)], "refund_id int, kind string, amount double, tax_amount double")
    orders = spark.createDataFrame([(10, "2024-01-01 10:00:00", 1, "#10", "GBP", "UK")],
                                   "id int, created_at string, app_id int, name string, presentment_currency string, billing_address__country string")
    facts = spark.createDataFrame([(100, 1)], "order_line_id int, quantity int")
    r = refund_ledger(lines, adjustments, refunds, orders, facts).first()
    assert (r.subtotal, r.total_tax, r.refund_amount_actuals) == (20.0, 4.0, -12.0)


def test_a_currency_with_two_rates_is_an_error(spark):
    import pytest
    from pyspark.errors import PySparkException

    from ledgerlake.plans.commerce import convert_currency

    orders = spark.createDataFrame([("EUR", 10.0)], "currency string, amount double")
    rates = spark.createDataFrame([("EUR", 1.2), ("EUR", 1.3)], "currency string, rate double")
    with pytest.raises(PySparkException):
        convert_currency(orders, rates)[0].collect()
    same = convert_currency(orders, spark.createDataFrame([("EUR", 1.25)] * 2, rates.schema))[0].collect()
    assert [x.amount_gbp for x in same] == [8.0]


def test_json_arrays_keep_their_good_elements_and_number_texts(spark):
    from ledgerlake.functions.json import json_elements, json_query, json_scalar

    doc = '[{"rate":0.20,"t":"1.0 , 2"},"x",{"rate":1e2,"t":{"b": 1}},null,5,{"rate":null,"t":"q\\"7\\""}]'
    docs = [doc, "bad", None, "[]", '{"rate":1}', "[1,", ' [{"rate":1.0}] ', "[01]", "[1.]", "[1 2]"]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, j string")
    got = [tuple(r) for r in json_elements(df, "j").select("i", json_query("element", "$.rate"), json_query("element", "$.t")).collect()]
    assert [g[1:] for g in got if not g[0]] == [("0.20", "1.0 , 2"), (None, None), ("1e2", '{"b":1}'), (None, None), (None, None), (None, 'q"7"')]
    assert [g for g in got if g[0]] == [(6, "1.0", None)]
    one = spark.createDataFrame([('{"a":1.0,"b":"0.20","c":1e2,"d":{"x":1},"e":null,"f":true,"g":[1]}',)], "j string")
    assert list(one.select(*[json_scalar("j", f"$.{k}") for k in "abcdefgh"]).first()) == ["1.0", "0.20", "1e2", None, None, "true", None, None]


def test_line_facts_join_products_after_the_lines_are_summed(spark):
    import datetime as dt

    from ledgerlake.plans.commerce import order_line_facts

    day = dt.date(2024, 1, 2)
    lines = spark.createDataFrame([(1, 10, 7, 0, "a", "2.5", 2.0), (2, 10, 8, 0, "b", "1.0", 1.0), (3, 10, None, 0, "c", "4.0", 1.0)],
                                  "id long, order_id long, product_id long, variant_id long, title string, price string, quantity double")
    orders = spark.createDataFrame([(10, day, "Abroad")], "id long, order_date date, billing_address__country string")
    products = spark.createDataFrame([(7, "cup", "t", "v"), (7, "cup", "t", "v"), (7, "mug", "t", "v"), (9, "jar", "t", "v")], "id long, handle string, product_type string, vendor string")
    refunds = spark.createDataFrame([(1, 1.0, 2.5)], "line_item_id long, quantity double, subtotal double")
    taxes = spark.createDataFrame([], "order_line_id long, title string, rate double, price double")
    facts = order_line_facts(lines, orders, products, refunds, taxes)
    got = {(r.order_line_id, r.handle): (r.refund_quantity, r.total_sales, r.quantity, r.gross_sales, r.order_total) for r in facts.collect()}
    assert got == {
        (1, "cup"): (2.0, 5.0, 4.0, 10.0, 12.5), (1, "mug"): (1.0, 2.5, 2.0, 5.0, 12.5),  # a product that stands twice counts twice
        (2, None): (None, 1.0, 1.0, 1.0, 12.5), (3, None): (None, 4.0, 1.0, 4.0, 12.5),
    }
    slim = order_line_facts(lines, orders, products, refunds, taxes, with_order_total=False)
    summed = [x for x in slim._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in x and "order_line_id#" in x]
    assert summed and not any("handle#" in x for x in summed)


def test_ledger_deals_refunds_and_orders_by_order_once(spark, sf_small):
    """Refund days are summed where the join with the orders left them, and the full join finds both sides dealt by order."""
    from ledgerlake.testbed.commerce import shop_ledger

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for it
    try:
        plan = shop_ledger(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [re.search(r"hashpartitioning\((.*), \d+\)", x)[1] for x in plan.split("\n") if "hashpartitioning(" in x and "ReusedExchange" not in x]
    assert not [k for k in keys if "refund_date" in k or "order_date" in k]  # neither the refund days' group nor the full join


def test_ledger_keeps_days_that_do_not_meet(spark):
    from ledgerlake.plans.commerce import ledger_rows

    d = dt.date
    orders = spark.createDataFrame([(d(2024, 1, 1), 1, 5.0), (d(2024, 1, 2), 1, 6.0), (None, 2, 7.0), (d(2024, 1, 1), None, 8.0)], "order_date date, order_id long, total_sales double")
    refunds = spark.createDataFrame([(d(2024, 1, 1), 1, -1.0), (d(2024, 1, 3), 1, -2.0), (None, 2, -3.0), (d(2024, 1, 1), None, -4.0)], "refund_date date, order_id long, refund_amount_actuals double")
    got = [tuple(r) for r in ledger_rows(orders, refunds).select("fulldate", "order_id", "orders_order_id", "return_order_id", "total_sales").collect()]
    assert sorted(got, key=str) == sorted([
        (d(2024, 1, 1), 1, 1, 1, 4.0), (d(2024, 1, 2), 1, 1, None, 6.0), (d(2024, 1, 3), 1, None, 1, -2.0),
        (None, 2, 2, None, 7.0), (None, 2, None, 2, -3.0), (d(2024, 1, 1), None, None, None, 8.0), (d(2024, 1, 1), None, None, None, -4.0),
    ], key=str)
