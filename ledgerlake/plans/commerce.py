"""Order, line, refund and currency jobs over shop tables.

Column names default to the landed shop schema (FIXTURES.md §1); every job
takes DataFrames and returns a DataFrame, never collecting anything.
Fan-out joins (shipping lines, refund lines) are kept as the reference has
them (trap G3); the grain of each output is stated in its docstring.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import (
    json_elements,
    json_query,
    json_value,
    local_date,
    n0,
    regex_first,
    safe_num,
    strip_json_quotes,
    trim_ws,
)
from ledgerlake.operators.keyed import first_per_key
from ledgerlake.plans.calendar import calendar_columns

# Fixed values of the reference's shop rules.
HOME_COUNTRY = "United Kingdom"
HOME_VAT_TITLE = "GB VAT"
BASE_CURRENCY = "GBP"
FREE_PRODUCT_PROPERTY = ("_yotpo_loyalty_discount_type", "product")
DEFAULT_VAT_DIVISOR = 1.2
LEDGER_CALENDAR_COLUMNS = [
    "retail_year", "retail_week", "retail_month", "retail_quarter", "retail_week_label", "retail_month_name",
    "retail_year_week_id", "retail_year_month_id", "retail_week_start_date", "retail_week_end_date",
    "day_of_week", "day_name",
]


# --- C2 -------------------------------------------------------------------------------------
def clean_orders(
    orders: DataFrame,
    zone: str = "Europe/London",
    created_at: str = "created_at",
    test: str = "test",
    duties: str = "original_total_duties_set__shop_money__amount",
) -> DataFrame:
    """Non-test orders (``test IS FALSE``: NULL is dropped too) with local ``order_date`` and numeric ``duties``."""
    out = orders.where(F.col(test) == F.lit(False))
    cols = [local_date(created_at, zone).alias("order_date"), *[F.col(f"`{c}`") for c in orders.columns if c != "order_date"]]
    if duties in orders.columns:
        cols.append(safe_num(duties).alias("duties"))
    return out.select(*cols)


# --- C3 -------------------------------------------------------------------------------------
def explode_tax_lines(line_items: DataFrame, line_id: str = "id", order_id: str = "order_id", tax_lines: str = "tax_lines") -> DataFrame:
    """One row per tax line held in a JSON array column; lines with none (or bad JSON) disappear.

    The array is parsed once per line and exploded as a VARIANT (``json_elements``); numeric
    fields are then safe-cast from their text, as ``SAFE_CAST(JSON_VALUE(..))``.
    """
    e = json_elements(
        line_items.select(F.col(line_id).alias("order_line_id"), F.col(order_id).alias("order_id"), F.col(tax_lines).alias("tax_lines")), "tax_lines", "tax"
    )
    v = {f: json_value("tax", f"$.{f}") for f in ("channel_agnostic", "title", "rate", "rate_percentage", "price")}
    return e.select(
        "order_line_id",
        "order_id",
        safe_num(v["channel_agnostic"], "boolean").alias("channel_agnostic"),
        v["title"].alias("title"),
        safe_num(v["rate"]).alias("rate"),
        safe_num(v["rate_percentage"]).alias("rate_percentage"),
        safe_num(v["price"]).alias("price"),
        json_query("tax", "$.price_set").alias("price_set"),
    )


# --- C4 -------------------------------------------------------------------------------------
def free_product_discount(
    line_items: DataFrame,
    prop: tuple[str, str] = FREE_PRODUCT_PROPERTY,
    line_id: str = "id",
    order_id: str = "order_id",
    price: str = "price",
    properties: str = "properties",
) -> DataFrame:
    """Per order: minus the price of distinct lines whose JSON ``properties`` hold ``{name, value}`` = ``prop``.

    The array is parsed once per line; only entries that match leave the scan, so a property
    listed twice still counts the line once, without its other properties being shuffled.
    """
    name, value = prop
    entries = json_elements(
        line_items.select(F.col(line_id).alias("_lid"), F.col(order_id).alias("order_id"), F.col(price).alias("_price"), F.col(properties).alias("_props")),
        "_props", "_prop",
    )
    hit = entries.where((json_value("_prop", "$.name") == F.lit(name)) & (json_value("_prop", "$.value") == F.lit(value)))
    lines = hit.select("_lid", "order_id", (-safe_num("_price")).alias("discount")).distinct()
    return lines.groupBy("order_id").agg(F.sum("discount").alias("discount"))


# --- C5 -------------------------------------------------------------------------------------
def gross_ex_vat(price_x_qty: Column, country: Column, rate: Column, home: str = HOME_COUNTRY) -> Column:
    """Gross of one line: as is abroad; net of VAT at home when a VAT line applies.

    ``NULL NOT IN (..)`` is unknown, so an unknown country falls through to the
    VAT branch (trap G16).
    """
    return (
        F.when(~country.isin(home), price_x_qty)
        .when(rate.isNotNull(), price_x_qty / (F.lit(1) + rate))
        .otherwise(price_x_qty)
    )


def order_line_facts(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    refund_lines: DataFrame,
    tax_lines: DataFrame,
    home: str = HOME_COUNTRY,
    vat_title: str = HOME_VAT_TITLE,
    country: str = "billing_address__country",
    with_order_total: bool = True,
) -> DataFrame:
    """Grain: order line x refund line x VAT rate. Product attributes, refunded qty/amount,
    unit-price sum, quantity, gross net of VAT, and the order's total beside each row.

    ``orders`` is the cleaned order frame (``order_date``); ``tax_lines`` the
    exploded tax lines. The VAT predicate sits in the join condition so a line
    without a qualifying tax line keeps its row. The order total is a window over
    the order's own lines (an order's lines are bounded), so the joins run once;
    ``with_order_total=False`` leaves it out.

    Lines are summed before the product is joined, so that its texts, the widest columns, take no part
    in the shuffles before. Products with the same attributes are one row with their number, by
    which the sums of a line are multiplied, as they would be summed once for each.
    """
    li = lines.select(
        F.col("id").alias("order_line_id"), "order_id", "product_id", "variant_id", "title",
        safe_num("price").alias("_price"), F.col("quantity").alias("_qty"),
    )
    o = orders.select(F.col("id").alias("_oid"), "order_date", F.col(country).alias("billing_order_country"))
    p = products.groupBy(F.col("id").alias("_pid"), "handle", "product_type", "vendor").agg(F.count(F.lit(1)).alias("_same"))
    r = refund_lines.select(
        F.col("line_item_id").alias("refund_order_line_id"), F.col("quantity").alias("_rq"), F.col("subtotal").alias("_rs")
    )
    t = tax_lines.where((F.col("title") == vat_title) & (F.col("price") != 0)).select(
        F.col("order_line_id").alias("_tlid"), "rate"
    )
    j = (
        li.join(o, li.order_id == o._oid, "inner")
        .join(r, li.order_line_id == r.refund_order_line_id, "left")
        .join(t, li.order_line_id == t._tlid, "left")
    )
    keys = [
        "order_date", "billing_order_country", "order_line_id", "order_id", "product_id", "variant_id", "title",
        "rate", "refund_order_line_id",
    ]
    pq = F.col("_price") * F.col("_qty")
    if with_order_total:
        j = j.repartition("order_id")  # one exchange serves the group-by and the window
    sums = j.groupBy(*keys).agg(
        F.sum("_rq").alias("refund_quantity"),
        F.sum("_rs").alias("refund_subtotal"),
        F.sum("_price").alias("total_sales"),
        F.sum("_qty").alias("quantity"),
        F.sum(gross_ex_vat(pq, F.col("billing_order_country"), F.col("rate"), home)).alias("gross_sales"),
    )
    times = F.coalesce("_same", F.lit(1))
    measures = ["refund_quantity", "refund_subtotal", "total_sales", "quantity", "gross_sales"]
    g = sums.join(p, sums.product_id == p._pid, "left").select(
        *keys[:7], "handle", "product_type", "vendor", *keys[7:], *[(F.col(c) * times).cast(sums.schema[c].dataType).alias(c) for c in measures],
        regex_first("handle", "[a-z]+").alias("handle_first_string"),
    )
    if not with_order_total:
        return g
    return g.withColumn("order_total", F.sum("total_sales").over(Window.partitionBy("order_id")))


# --- C6 -------------------------------------------------------------------------------------
def refund_ledger(
    refund_lines: DataFrame,
    adjustments: DataFrame,
    refunds: DataFrame,
    orders: DataFrame,
    line_facts: DataFrame,
    zone: str = "Europe/London",
    base_currency: str = BASE_CURRENCY,
    num: str = "double",
) -> DataFrame:
    """Grain: refund date x order (x order attributes). Quantities, subtotal, tax, adjustment
    amounts by kind and the net refund amount (negative), base-currency rule included."""
    lf = line_facts.select(F.col("order_line_id").alias("_olid"), F.col("quantity").alias("_lq"))
    per_refund_line = (
        refund_lines.join(lf, refund_lines.line_item_id == lf._olid, "left")
        .groupBy(F.col("id").alias("_rl_id"))
        .agg(
            F.sum("_lq").alias("_rl_quantity"),
            F.sum(safe_num("subtotal", num)).alias("_rl_subtotal"),
            F.sum(safe_num("total_tax", num)).alias("_rl_tax"),
        )
    )
    amt, tax = safe_num("amount", num), safe_num("tax_amount", num)
    kind = F.col("kind")
    adj = adjustments.groupBy(F.col("refund_id").alias("_adj_id")).agg(
        F.sum(F.when(kind == "shipping_refund", n0(amt))).alias("order_adjustment_shipping_amount"),
        F.sum(F.when(kind == "shipping_refund", n0(tax))).alias("order_adjustment_shipping_tax"),
        F.sum(F.when(kind == "refund_discrepancy", n0(amt))).alias("order_adjustment_refund_discrepancy_amount"),
        F.sum(F.when(kind == "refund_discrepancy", n0(tax))).alias("order_adjustment_refund_discrepancy_tax"),
    )
    o = orders.select(
        F.col("id").alias("_o_id"),
        F.col("created_at").alias("_o_created"),
        "app_id",
        F.col("name").alias("order_name"),
        "presentment_currency",
        F.col("billing_address__country").alias("billing_order_country"),
    )
    rf = refunds.select(
        F.col("id").alias("refund_id"), "order_id", "user_id", F.col("created_at").alias("_r_created")
    )
    # A refund landed twice counts its lines twice but its adjustments once, so refunds are
    # summed to one row each before the adjustments are joined.
    landed = rf.join(per_refund_line, rf.refund_id == per_refund_line._rl_id, "left")
    rf = landed.groupBy("refund_id", "order_id", "user_id", "_r_created").agg(
        *[F.sum(c).alias(c) for c in ("_rl_subtotal", "_rl_tax", "_rl_quantity")]
    )
    # Refunds and adjustments lie by refund already; from the orders on, all goes by order.
    base = (
        rf.join(adj, rf.refund_id == adj._adj_id, "left")
        .join(o, rf.order_id == o._o_id, "left")
        .select(
            local_date(F.col("_r_created").try_cast("timestamp"), zone).alias("refund_date"),
            local_date(F.col("_o_created").try_cast("timestamp"), zone).alias("order_date"),
            "order_id", "order_name", "user_id", "app_id", "billing_order_country", "presentment_currency",
            n0("_rl_subtotal").alias("_subtotal"), n0("_rl_tax").alias("_tax"), n0("_rl_quantity").alias("_quantity"),
            "order_adjustment_shipping_amount", "order_adjustment_shipping_tax",
            "order_adjustment_refund_discrepancy_amount", "order_adjustment_refund_discrepancy_tax",
        )
    )
    keys = ["refund_date", "order_date", "order_id", "order_name", "user_id", "app_id", "billing_order_country", "presentment_currency"]
    g = base.groupBy(*keys).agg(
        F.sum("_quantity").alias("quantity"),
        F.sum("_subtotal").alias("subtotal"),
        F.sum("_tax").alias("total_tax"),
        F.sum("order_adjustment_shipping_amount").alias("order_adjustment_shipping_amount"),
        F.sum("order_adjustment_shipping_tax").alias("order_adjustment_shipping_tax"),
        F.sum("order_adjustment_refund_discrepancy_amount").alias("order_adjustment_refund_discrepancy_amount"),
        F.sum("order_adjustment_refund_discrepancy_tax").alias("order_adjustment_refund_discrepancy_tax"),
    )
    return g.withColumns(refund_amounts(base_currency))


def refund_amounts(base_currency: str = BASE_CURRENCY) -> dict[str, Column]:
    """Refund tax, shipping and net amount of one (refund date, order) group.

    Amount: ``round(-subtotal + tax + discrepancy, 2)`` in the base currency,
    ``round(-subtotal + discrepancy + discrepancy_tax, 2)`` in others, NULL
    when the currency is unknown.
    """
    sub, tax = F.col("subtotal"), F.col("total_tax")
    disc_amt, disc_tax = F.col("order_adjustment_refund_discrepancy_amount"), F.col("order_adjustment_refund_discrepancy_tax")
    ship_tax = F.col("order_adjustment_shipping_tax")
    cur = F.col("presentment_currency")
    amount = (
        F.when(cur.isin(base_currency), F.round(n0(-sub) + n0(tax) + n0(disc_amt), 2))
        .when(~cur.isin(base_currency), F.round(n0(-sub) + n0(disc_amt) + n0(disc_tax), 2))
    )
    return {
        "refund_tax": n0(-tax) + n0(disc_tax) + n0(ship_tax),
        "refund_shipping_amount": F.col("order_adjustment_shipping_amount"),
        "refund_amount_actuals": amount,
        # COUNT(DISTINCT order_id) within a group keyed by order_id: 1, or 0 for a NULL id
        "number_of_orders": F.when(F.col("order_id").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
    }


# --- C7 helper ------------------------------------------------------------------------------
def order_type_flags(
    orders: DataFrame,
    customer: str = "email",
    order_id: str = "id",
    created_at: str = "created_at",
    lower_key: bool = False,
) -> DataFrame:
    """Each order with ``order_type`` New (the customer's first order) or Returning.

    The first orders come from ``first_per_key`` (partial-aggregated ``min_by``)
    and are matched back with a left join on the order id.
    """
    key = F.lower(F.col(customer)) if lower_key else F.col(customer)
    keyed = orders.select(key.alias("_ck"), F.col(order_id).alias("_fo_id"), F.col(created_at).alias("_fo_ts"))
    first = first_per_key(keyed, ["_ck"], [F.col("_fo_ts"), F.col("_fo_id")]).select("_fo_id")
    joined = orders.join(first, F.col(order_id) == F.col("_fo_id"), "left")
    return joined.withColumn(
        "order_type", F.when(F.col("_fo_id").isNotNull(), F.lit("New")).otherwise(F.lit("Returning"))
    ).drop("_fo_id")


# --- C8 -------------------------------------------------------------------------------------
def order_day_metrics(
    orders: DataFrame,
    shipping_lines: DataFrame,
    line_facts: DataFrame,
    free_discounts: DataFrame,
    first_orders: DataFrame,
    since: str | None = None,
    vat_divisor: float = DEFAULT_VAT_DIVISOR,
) -> DataFrame:
    """Order part of the ledger (grain: order, after the shipping-line fan-out)."""
    line_agg = line_facts.groupBy(F.col("order_id").alias("_la_oid")).agg(
        F.max("rate").alias("tax_rate"), F.sum("gross_sales").alias("_la_gross"), F.sum("quantity").alias("_la_qty")
    )
    ship = shipping_lines.select(F.col("order_id").alias("_s_oid"), safe_num("price").alias("_ship"))
    fpd = free_discounts.select(F.col("order_id").alias("_f_oid"), F.col("discount").alias("_fpd"))
    fo = first_orders.select(F.col("order_id").alias("_fo_oid"))
    o = orders if since is None else orders.where(F.col("order_date") >= F.lit(since).cast("date"))
    j = (
        o.join(ship, o.id == ship._s_oid, "left")
        .join(line_agg, o.id == line_agg._la_oid, "left")
        .join(fpd, o.id == fpd._f_oid, "left")
        .join(fo, o.id == fo._fo_oid, "left")
    )
    rate1 = F.lit(1) + n0("tax_rate")
    total_price, total_tax = safe_num("total_price"), safe_num("total_tax")
    total_disc, subtotal = safe_num("total_discounts"), safe_num("subtotal_price")
    keys = [
        F.col("order_date"), F.col("id").alias("order_id"), F.col("name").alias("order_name"), F.col("app_id"),
        F.col("user_id"), F.col("customer__id").alias("customer_id"), F.col("email"), F.col("cancelled_at"),
        F.col("fulfillment_status"), F.col("billing_address__country").alias("billing_order_country"),
        F.when(F.col("_fo_oid").isNotNull(), F.lit("New")).otherwise(F.lit("Returning")).alias("order_type"),
    ]
    return j.groupBy(*keys).agg(
        F.count("id").alias("number_of_orders"),
        F.sum(subtotal).alias("subtotal_price"),
        F.sum(total_disc / rate1).alias("total_discounts"),
        F.sum(safe_num("current_total_discounts")).alias("current_total_discounts"),
        F.sum(safe_num("total_line_items_price")).alias("total_line_items_price"),
        F.sum("_la_gross").alias("gross_sales"),
        F.sum("_la_qty").alias("quantity"),
        F.sum((-n0(total_disc) - n0("_fpd")) / rate1).alias("discount"),
        F.sum("_fpd").alias("free_product_discount"),
        F.sum(total_price).alias("total_sales"),
        F.sum(total_tax).alias("total_tax"),
        F.sum(safe_num("current_total_tax")).alias("current_total_tax"),
        F.sum(F.when(total_tax == 0, subtotal - subtotal / F.lit(vat_divisor)).otherwise(total_tax)).alias("tax_v2"),
        F.sum(F.col("_ship") / rate1).alias("shipping_cost"),
        F.sum("duties").alias("duties"),
        F.sum(n0(total_price) - n0(total_tax - F.col("_ship"))).alias("net_sales"),
    )


def ledger_rows(order_days: DataFrame, refund_days: DataFrame, hashed_email: bool = True) -> DataFrame:
    """Full outer join of order-day and refund-day rows on (date, order id) with the ledger arithmetic.

    ``order_days`` needs ``order_date, order_id`` plus any of the order
    measures; ``refund_days`` needs ``refund_date, order_id`` plus the refund
    measures. Keys are coalesced; the sign conventions follow trap G17.
    """
    od = order_days.alias("o")
    rd = refund_days.alias("r")
    # Both sides lie by order already. As a pair of bounds the date is no key of the join, which would have both dealt anew.
    same_day = (F.col("o.order_date") >= F.col("r.refund_date")) & (F.col("o.order_date") <= F.col("r.refund_date"))
    j = od.join(rd, (F.col("o.order_id") == F.col("r.order_id")) & same_day, "full")

    def oc(name, default=None):
        return F.col(f"o.{name}") if name in order_days.columns else F.lit(default)

    def rc(name, default=None):
        return F.col(f"r.{name}") if name in refund_days.columns else F.lit(default)

    returns = n0(rc("refund_amount_actuals"))
    total_tax = oc("total_tax")
    tax = n0(F.coalesce(F.nullif(total_tax, F.lit(0)), F.nullif(oc("current_total_tax"), F.lit(0)))) + n0(rc("refund_tax"))
    shipping = n0(oc("shipping_cost")) + n0(rc("refund_shipping_amount"))
    discount = n0(oc("discount")) + n0(oc("free_product_discount"))
    total_sales = n0(oc("total_sales")) + n0(rc("refund_amount_actuals"))
    email = oc("email")
    cols = {
        "fulldate": F.coalesce(F.col("o.order_date"), F.col("r.refund_date")),
        "order_id": F.coalesce(F.col("o.order_id"), F.col("r.order_id")),
        "order_name": F.coalesce(oc("order_name"), rc("order_name")),
        "orders_order_id": F.col("o.order_id"),
        "app_id": F.coalesce(oc("app_id"), rc("app_id")),
        "return_order_id": F.col("r.order_id"),
        "refund_date": F.col("r.refund_date"),
        "user_id": F.coalesce(oc("user_id").cast("string"), rc("user_id").cast("string")),
        "orders_email": F.sha2(trim_ws(F.lower(email)).cast("string"), 256) if hashed_email else email,
        "customer_id": oc("customer_id"),
        "order_type": oc("order_type"),
        "billing_order_country": F.coalesce(oc("billing_order_country"), rc("billing_order_country")),
        "number_of_orders": oc("number_of_orders"),
        "quantity": oc("quantity"),
        "refund_order_count": rc("number_of_orders"),
        "tax": tax,
        "shipping_cost": shipping,
        "duties": n0(oc("duties")),
        "discount": discount,
        "returns": returns,
        "total_sales": total_sales,
        "order_line_agg_gross_sales": oc("gross_sales"),
    }
    rows = j.select(*[v.alias(k) for k, v in cols.items()])
    ts, t, s, r, d = (F.col(c) for c in ("total_sales", "tax", "shipping_cost", "returns", "discount"))
    return rows.withColumns(
        {
            "total_sales_plus_returns": ts + F.abs(r),
            "gross_sales": ts + n0(F.abs(r)) + n0(F.abs(d)) - t - s,
            "net_sales": ts - t - s,
            "net_sales_plus_returns": ts - t - s + F.abs(r),
            "sales": ts - t - s + s,
        }
    )


def order_metrics_ledger(
    order_days: DataFrame,
    refund_days: DataFrame,
    calendar: Mapping | None = None,
) -> DataFrame:
    """C8 flagship: ledger rows plus the retail calendar of ``fulldate`` (computed, no join)."""
    rows = ledger_rows(order_days, refund_days)
    cal = calendar_columns("fulldate", **(calendar or {}))
    return rows.withColumns({k: cal[k] for k in LEDGER_CALENDAR_COLUMNS})


# --- C10 ------------------------------------------------------------------------------------
# Value-band and status labels of the import conversion model.
HIGH_VALUE_THRESHOLD = 200
CONVERTED = "CONVERTED_TO_GBP"
NOT_CONVERTED = "NO_CONVERSION_NEEDED"
MISSING = "MISSING_FX_RATE"


def convert_currency(
    orders: DataFrame,
    rates: DataFrame,
    currency: str = "currency",
    amount_cols: Sequence[str] = ("amount",),
    base_currency: str = BASE_CURRENCY,
    threshold: float = HIGH_VALUE_THRESHOLD,
) -> tuple[DataFrame, DataFrame]:
    """Convert amounts to the base currency: ``round(amount / rate, 2)``.

    ``rates`` has ``currency, rate`` (units of currency per base unit, the base
    currency listed with 1.0). Codes are compared after stripping optional JSON
    quotes (trap G13). Returns ``(converted, rejected)``: rows without a rate
    are excluded from the first frame, as the reference's filter does, and
    returned in the second with status ``MISSING_FX_RATE`` (trap G19). A currency
    listed with two different rates is an error: it would multiply orders.
    """
    keyed = orders.withColumn("_cur", strip_json_quotes(F.col(currency)))
    one = F.when(F.min("rate") < F.max("rate"), F.raise_error(F.concat(F.lit("more than one rate for "), F.col("currency"))).cast("double"))
    r = rates.groupBy("currency").agg(F.coalesce(one, F.max("rate").cast("double")).alias("fx_rate_used")).withColumnRenamed("currency", "_rc")
    joined = keyed.join(r, keyed._cur == r._rc, "left").drop("_rc")
    fx = F.col("fx_rate_used")
    first = F.col(amount_cols[0])
    conv = {f"{c}_gbp": F.round(F.col(c) / F.coalesce(fx, F.lit(1.0)), 2) for c in amount_cols}
    out = joined.withColumns(conv).withColumns(
        {
            "missing_fx_rate": fx.isNull(),
            "high_value_flag": F.coalesce(first / F.coalesce(fx, F.lit(1.0)) > F.lit(threshold), F.lit(False)),
            "conversion_status": F.when(F.col("_cur") == base_currency, F.lit(NOT_CONVERTED))
            .when(fx.isNull(), F.lit(MISSING))
            .otherwise(F.lit(CONVERTED)),
        }
    )
    return out.where(fx.isNotNull()).drop("_cur"), out.where(fx.isNull()).drop("_cur")
