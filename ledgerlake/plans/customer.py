"""Customer-level jobs.

``customer_360`` computes ~50 per-customer measures in two aggregations:

1. per (customer, order): sums / counts / maxima and one boolean per
   distinct-count predicate (channel, trailing window);
2. per customer: ``count_if`` over those booleans, which equals
   ``COUNT(DISTINCT CASE WHEN pred THEN order_id END)`` exactly.

This replaces eleven ``COUNT(DISTINCT ...)`` (which Spark would plan as an
Expand multiplying every row eleven times) with two partial-aggregated
shuffles, and the first-order attributes are taken with ``min_by`` inside the
same aggregation instead of a row-number window joined back three times.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import ratio, regex_first, safe_num, utc_date
from ledgerlake.functions.json import json_scalar, strip_json_quotes
from ledgerlake.operators.keyed import first_per_key, latest_per_key
from ledgerlake.operators.skew import heavy_hitters, salted_join
from ledgerlake.operators.setops import union_all
from ledgerlake.plans.commerce import BASE_CURRENCY, CONVERTED, convert_currency
from ledgerlake.plans import segments as seg


@dataclass(frozen=True)
class ChannelRules:
    """How channel codes map to the customer model's channel groups.

    ``groups``: group name -> channel codes. The four ``behaviour`` groups feed
    ``channel_behavior`` / ``unique_channels_used`` / dominant channel.
    ``acquisition``: ordered (codes, label) pairs for the first order's channel;
    ``place_by_date``: exact first-order dates of in-store events -> place name.
    """

    groups: Mapping[str, Sequence]
    behaviour: Sequence[tuple[str, str, str]] = (
        # (group, "<x> Only" label, dominant-channel label) -- fixed values of the reference
        ("web", "Online Only", "Web"),
        ("pos", "In-Store Only", "POS"),
        ("tiktok", "TikTok Only", "TikTok"),
        ("marketplace", "Marketplace Only", "Marketplace"),
    )
    import_group: str | None = "magento"
    acquisition: Sequence[tuple[Sequence, str]] = ()
    acquisition_default: str = "Unknown"
    # ordered (codes, part of the lower-cased source name or None, label)
    acquisition_detail: Sequence[tuple[Sequence, str | None, str]] = ()
    acquisition_detail_default: str = "Other"
    place_group: str = "pos"
    place_by_date: Mapping[str, str] = field(default_factory=dict)
    place_default: str = "Glasgow Pop-up"
    place_labels: Sequence[tuple[Sequence, str]] = ()
    place_other: str = "Other"


def _in(c: Column, values: Sequence) -> Column:
    """Whether ``c`` is one of ``values``; FALSE for NULL, so flags over NULL channels are FALSE."""
    return F.coalesce(c.isin(list(values)), F.lit(False)) if values else F.lit(False)


def _place_by_date(d: Column, rules: ChannelRules) -> Column:
    expr = None
    for day, label in rules.place_by_date.items():
        cond = d == F.lit(day).cast("date")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rules.place_default)) if expr is not None else F.lit(rules.place_default)


def customer_360(
    orders: DataFrame,
    rules: ChannelRules,
    as_of: dt.date,
    customer: str = "email",
    order_id: str = "order_id",
    order_date: str = "order_date",
    gross: str = "gross_sales",
    net: str = "net_sales",
    channel: str = "app_id",
    source: str | None = "source_name",
    customer_id: str | None = "customer_id",
    windows: Sequence[int] = (90, 180, 365),
    postcode: str | None = None,
    maxima: Mapping[str, str] = {},
    primary_source: bool = False,
) -> DataFrame:
    """Per-customer channel, recency, revenue, refund, value and segment measures.

    ``orders`` holds the customer_orders rows (any extra columns are ignored).
    ``as_of`` replaces CURRENT_DATE so results are reproducible. ``maxima`` maps
    output names to columns whose greatest value per customer is wanted (addresses,
    consent; see ``CUSTOMER_MAXIMA``). ``primary_source`` adds the customer's most
    frequent ``source`` (one more aggregation and join).
    """
    asof = F.lit(as_of).cast("date")
    ch, d = F.col(channel), F.col(order_date).cast("date")
    groups = dict(rules.groups)
    beh_groups = [g for g, _, _ in rules.behaviour]

    # Step 1: one row per (customer, order) with exact per-order flags. Each measure is
    # declared once as (name, row value, kind); kind gives its aggregate over the order's rows.
    first_row = F.struct(ch.alias("ch"), (F.col(source) if source else F.lit(None)).alias("src"), d.alias("d"))
    measures: list[tuple[str, Column, str]] = [
        ("_d_min", d, "min"),
        ("_d_max", d, "max"),
        ("_g_sum", F.col(gross), "sum"),
        ("_g_n", F.col(gross), "count"),
        ("_g_max", F.col(gross), "max"),
        ("_n_sum", F.col(net), "sum"),
        ("_n_n", F.col(net), "count"),
        ("_n_max", F.col(net), "max"),
        ("_refund", F.col(gross) - F.col(net), "sum"),
        ("_first", first_row, "first"),
    ]
    if customer_id:
        measures.append(("_cid", F.col(customer_id), "max"))
    for g, codes in groups.items():
        measures.append((f"_in_{g}", _in(ch, codes), "any"))
        measures.append((f"_rev_{g}", F.when(_in(ch, codes), F.col(net)).otherwise(F.lit(0)), "sum"))
    if rules.import_group:
        measures.append(("_in_not_import", ~_in(ch, groups.get(rules.import_group, ())) & ch.isNotNull(), "any"))
    for n in windows:
        measures.append((f"_w{n}", d >= F.date_sub(asof, n), "any"))
    measures.append(("_place_d", F.when(_in(ch, groups.get(rules.place_group, ())), d), "min"))
    if postcode:
        measures.append(("_zip", F.col(postcode), "max"))
    measures += [(f"_max_{out}", F.col(c), "max") for out, c in maxima.items()]

    aggregate = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count, "any": F.bool_or}
    order_key = F.struct(d, F.col(order_id))

    def order_agg(expr: Column, kind: str) -> Column:
        return F.min_by(expr, order_key) if kind == "first" else aggregate[kind](expr)

    orders_level = orders.groupBy(customer, order_id).agg(*[order_agg(e, k).alias(a) for a, e, k in measures])

    # Step 2: one row per customer.
    cnt = lambda cond: F.count_if(cond & F.col(order_id).isNotNull())
    aggs = [
        cnt(F.lit(True)).alias("total_orders"),
        F.min("_d_min").alias("first_order_date"),
        F.max("_d_max").alias("last_order_date"),
        F.sum("_g_sum").alias("gross_revenue"),
        F.sum("_g_n").alias("_g_n"),
        F.max("_g_max").alias("max_gross_order_value"),
        F.sum("_n_sum").alias("net_revenue"),
        F.sum("_n_n").alias("_n_n"),
        F.max("_n_max").alias("max_net_order_value"),
        F.sum("_refund").alias("total_refunded"),
        F.min_by("_first", F.struct(F.col("_first.d"), F.col(order_id))).alias("_first"),
        F.min("_place_d").alias("first_pos_order_date"),
    ]
    if customer_id:
        aggs.append(F.max("_cid").alias("customer_id"))
    for g in groups:
        aggs.append(F.bool_or(F.col(f"_in_{g}")).alias(f"has_{g}_orders"))
        aggs.append(cnt(F.col(f"_in_{g}")).alias(f"{g}_orders"))
        aggs.append(F.sum(f"_rev_{g}").alias(f"{g}_revenue"))
    if rules.import_group:
        aggs.append(cnt(F.col("_in_not_import")).alias("shopify_orders"))
    for n in windows:
        aggs.append(cnt(F.col(f"_w{n}")).alias(f"orders_last_{n}_days"))
    if postcode:
        aggs.append(F.max("_zip").alias("shipping_postcode"))
    aggs += [F.max(f"_max_{out}").alias(out) for out in maxima]
    m = orders_level.groupBy(customer).agg(*aggs)

    # Step 3: row-level derivations (no further shuffle).
    days_since = F.datediff(asof, F.col("last_order_date"))
    age = F.datediff(asof, F.col("first_order_date"))
    flags = [F.when(F.col(f"has_{g}_orders"), 1).otherwise(0) for g in beh_groups]
    n_channels = flags[0]
    for f in flags[1:]:
        n_channels = n_channels + f
    behaviour = F.when(n_channels >= 2, F.lit("Omnichannel"))
    for g, only_label, _ in rules.behaviour:
        others = [F.col(f"has_{o}_orders") for o in beh_groups if o != g]
        any_other = others[0]
        for o in others[1:]:
            any_other = any_other | o
        behaviour = behaviour.when(F.col(f"has_{g}_orders") & ~any_other, F.lit(only_label))
    behaviour = behaviour.otherwise(F.lit("Other"))

    revs = {g: F.col(f"{g}_revenue") for g in beh_groups}
    dominant = None
    for g, _, label in rules.behaviour[:-1]:
        rest = F.greatest(*[revs[o] for o in beh_groups if o != g])
        cond = revs[g] >= rest
        dominant = F.when(cond, F.lit(label)) if dominant is None else dominant.when(cond, F.lit(label))
    last_g, _, last_label = rules.behaviour[-1]
    dominant = dominant.when(revs[last_g] > 0, F.lit(last_label)).otherwise(F.lit("Other"))

    first_ch = F.col("_first.ch")
    acq = None
    for codes, label in rules.acquisition:
        cond = _in(first_ch, codes)
        acq = F.when(cond, F.lit(label)) if acq is None else acq.when(cond, F.lit(label))
    acq = acq.otherwise(F.lit(rules.acquisition_default)) if acq is not None else F.lit(rules.acquisition_default)

    detail = None
    for codes, part, label in rules.acquisition_detail:
        cond = _in(first_ch, codes)
        if part is not None:
            cond = cond & F.coalesce(F.lower(F.col("_first.src")).contains(part), F.lit(False))
        detail = F.when(cond, F.lit(label)) if detail is None else detail.when(cond, F.lit(label))

    place = F.when(_in(first_ch, groups.get(rules.place_group, ())), _place_by_date(F.col("_first.d"), rules))
    for codes, label in rules.place_labels:
        place = place.when(_in(first_ch, codes), F.lit(label))
    place = place.otherwise(F.lit(rules.place_other))

    net_rev = F.col("net_revenue")
    derived = {
        "avg_gross_order_value": F.try_divide(F.col("gross_revenue").cast("double"), F.col("_g_n").cast("double")),
        "avg_net_order_value": F.try_divide(net_rev.cast("double"), F.col("_n_n").cast("double")),
        "days_since_last_order": days_since,
        "customer_age_days": age,
        "refund_rate_pct": F.round(ratio(F.col("total_refunded").cast("double") * F.lit(100.0), F.col("gross_revenue").cast("double")), 2),
        "channel_behavior": behaviour,
        "unique_channels_used": n_channels,
        "dominant_channel_by_revenue": dominant,
        "acquisition_channel": acq,
        "customer_acquisition_location": place,
        "pos_acquisition_city": F.when(F.col("first_pos_order_date").isNotNull(), _place_by_date(F.col("first_pos_order_date"), rules)),
        "customer_lifetime_value": F.round(net_rev.cast("double"), 2),
        "average_order_value": F.round(ratio(net_rev.cast("double"), F.col("total_orders")), 2),
        "annualized_value": F.round(ratio(net_rev.cast("double"), age, scale=365.0), 2),
        "avg_monthly_value": F.round(ratio(net_rev.cast("double"), age, scale=30.0), 2),
        "customer_type": seg.customer_type("total_orders"),
        "rfm_segment": seg.rfm_segment(days_since, F.col("total_orders")),
        "recency_category": seg.recency_category(days_since),
        "frequency_category": seg.frequency_category("total_orders"),
        "monetary_tier": seg.monetary_tier(net_rev),
        "ltv_tier": seg.ltv_tier(net_rev),
    }
    if 365 in windows:
        derived["gm_segment"] = seg.cohort_segment("first_order_date", "orders_last_365_days", days_since, asof)
    if detail is not None:
        derived["acquisition_channel_detail"] = detail.otherwise(F.lit(rules.acquisition_detail_default))
    if source:
        derived["first_order_source"] = F.col("_first.src")
    if postcode:
        derived["shipping_postal_area"] = regex_first("shipping_postcode", POSTAL_AREA)
    out = m.withColumns(derived).drop("_g_n", "_n_n", "_first")
    if primary_source:
        top = primary_value(orders, customer, source, out="primary_order_source").select(
            F.col(customer).alias("_top_customer"), "primary_order_source"
        )
        out = out.join(top, F.col(customer).eqNullSafe(F.col("_top_customer")), "left").drop("_top_customer")
    return out


# Output name -> customer_orders column of the per-customer maxima.
CUSTOMER_MAXIMA = {
    "billing_order_country": "billing_address_country",
    "billing_city": "billing_address_city",
    "billing_province": "billing_address_province",
    "billing_postcode": "billing_address_zip",
    "shipping_order_country": "shipping_address_country",
    "shipping_city": "shipping_address_city",
    "shipping_province": "shipping_address_province",
    "accepts_marketing": "buyer_accepts_marketing",
}

# The financial states of an order that count, and the columns of customer_orders.
PAID_STATES = ("paid", "partially_paid", "authorized", "pending")
CUSTOMER_ORDER_COLUMNS = (
    "email", "order_date", "gross_sales", "net_sales", "order_id", "customer_id", "app_id", "source_name",
    *(f"{kind}_address_{part}" for kind in ("billing", "shipping") for part in ("country", "city", "province", "zip")),
    "buyer_accepts_marketing", "is_magento_order", "is_currency_converted",
)


def _landed_order(orders: DataFrame, gross: str) -> DataFrame:
    """The landed order fields both halves of ``customer_orders`` need, under its names."""
    address = [
        F.col(f"{kind}_address__{part}").alias(f"{kind}_address_{part}")
        for kind in ("billing", "shipping")
        for part in ("country", "city", "province", "zip")
    ]
    return orders.where(~F.col("test") & F.col("email").isNotNull() & F.col("financial_status").isin(*PAID_STATES)).select(
        F.col("id").alias("order_id"), "name", "email", F.col("customer__id").alias("customer_id"), "app_id", "source_name",
        "financial_status", "processed_at", "buyer_accepts_marketing", *address,
        *(["order_date"] if "order_date" in orders.columns else []),
        F.col("total_price_set__shop_money__currency_code").alias("currency"),
        safe_num(gross).alias("gross"), safe_num("current_total_price_set__shop_money__amount").alias("net"),
    )


def import_orders(orders: DataFrame, rates: DataFrame, import_apps: Sequence[int], base_currency: str = BASE_CURRENCY) -> tuple[DataFrame, DataFrame]:
    """Imported orders in the base currency: (converted, rejected for want of a rate).

    Landed orders of the import apps that are no tests, have an e-mail and a counted
    financial state; dated by UTC ``processed_at``. Gross is the discounts total, as the
    imports carry it; the original amounts stay beside the converted ones.
    """
    rows = _landed_order(orders.where(F.col("app_id").isin(*import_apps)).drop("order_date"), "total_discounts_set__shop_money__amount")
    rows = rows.withColumn("order_date", utc_date("processed_at")).withColumnsRenamed(
        {"name": "order_name", "currency": "original_currency", "gross": "gross_sales", "net": "net_sales"}
    )
    out = convert_currency(rows, rates, "original_currency", ("gross_sales", "net_sales"), base_currency)
    kept = {"gross_sales": "original_gross_sales", "net_sales": "original_net_sales"}
    return tuple(part.withColumnsRenamed(kept) for part in out)


def customer_orders(
    orders: DataFrame, imported: DataFrame, import_apps: Sequence[int], skipped_apps: Sequence[int] = (),
    skipped_customers: Sequence[int] = (), base_currency: str = BASE_CURRENCY,
) -> DataFrame:
    """The order history of all customers: shop orders and converted imports, one row each.

    ``orders`` is the cleaned order frame, ``imported`` the first result of
    ``import_orders``. Shop rows must be in the base currency (its code may be landed as a
    JSON string); imports, skipped apps and placeholder customers are left out, as are rows
    whose app or customer id is NULL. E-mails are lower-cased in both halves.
    """
    shop = _landed_order(orders, "total_line_items_price_set__shop_money__amount").where(
        F.coalesce(json_scalar("currency"), strip_json_quotes("currency")) == base_currency
    )
    if skipped_customers:
        shop = shop.where(~F.col("customer_id").isin(*skipped_customers))
    shop = shop.where(~F.col("app_id").isin(*import_apps, *skipped_apps)).withColumns(
        {"email": F.lower("email"), "is_magento_order": F.lit(False), "is_currency_converted": F.lit(False)}
    ).withColumnsRenamed({"gross": "gross_sales", "net": "net_sales"})
    imports = imported.withColumns(
        {"email": F.lower("email"), "is_magento_order": F.lit(True), "is_currency_converted": F.col("conversion_status") == CONVERTED}
    ).withColumnsRenamed({"gross_sales_gbp": "gross_sales", "net_sales_gbp": "net_sales"})
    return union_all([half.select(*CUSTOMER_ORDER_COLUMNS) for half in (shop, imports)])


# Fixed value: UK postal area pattern of the reference (outward code prefix).
POSTAL_AREA = "^([A-Z]{1,2}[0-9]{1,2}[A-Z]?)"


def primary_value(df: DataFrame, key: str, value: str, out: str = "primary_value", approx: bool = False) -> DataFrame:
    """Most frequent ``value`` per ``key``; NULL counts as a value (trap G8).

    Exact by default (ties -> smallest value): two partial-aggregated group-bys,
    never collecting a key's values. ``approx=True`` uses the ``approx_top_k``
    sketch (the warehouse's approximate top count): one aggregation whose
    per-key state is a bounded sketch; ties and near-ties may resolve
    differently from the exact mode.
    """
    if approx:
        top = F.expr(f"approx_top_k(`{value}`, 1)")
        return df.groupBy(key).agg(top.alias("_top")).select(
            key, F.col("_top")[0]["item"].alias(out), F.col("_top")[0]["count"].alias(f"{out}_count")
        )
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(pick.alias(out), F.max("_n").alias(f"{out}_count"))


def first_orders(
    orders: DataFrame, email: str = "email", created_at: str = "created_at", order_id: str = "id", columns: Sequence[str] | None = None
) -> DataFrame:
    """First order of each lower-cased e-mail (NULL e-mails form one group, trap G20).

    ``columns``: what is wanted of it; by default all columns, which are then all read."""
    keyed = orders.withColumn("_email_key", F.lower(F.col(email)))
    first = first_per_key(keyed, ["_email_key"], [F.col(created_at), F.col(order_id)], columns=columns)
    return first.drop(email).withColumnRenamed("_email_key", email)


def customer_summary(
    ledger: DataFrame,
    order_emails: DataFrame,
    addresses: DataFrame,
    order_id: str = "order_id",
    customer_id: str = "customer_id",
    email: str = "email",
    country: str = "billing_address_country",
    order_date: str = "order_date",
    counted: str = "orders_order_id",
) -> DataFrame:
    """E-mail x last billing country -> distinct orders and new/returning.

    ``ledger`` rows are matched by ``order_id``, but orders are counted by
    ``counted``, which is NULL on rows that only hold a refund. The last address is
    the latest order with a known country per e-mail, joined back on the customer
    id as the reference does (so the e-mail grain can fan out, trap G4). Both sides
    are reduced first: orders to one row per (customer, e-mail, order), countries to one
    row per (customer, country). A placeholder customer that holds many of the orders is
    salted in that join: its side is an aggregate, which adaptive execution can't split.
    """
    last = latest_per_key(
        addresses.where(F.col(country).isNotNull()).select(email, customer_id, country, order_date, order_id),
        [email],
        [F.col(order_date), F.col(order_id)],
    ).select(F.col(customer_id).alias("_la_cid"), F.col(country).alias("billing_order_country"))
    et = order_emails.select(F.col(order_id).alias("_et_oid"), F.col(customer_id).alias("_et_cid"), F.col(email))
    rows = ledger.select(order_id, F.col(counted).alias("_counted")).distinct()
    placed = rows.join(et, F.col(order_id) == F.col("_et_oid"), "left").select("_et_cid", email, "_counted").distinct()
    out = salted_join(placed, last.distinct().withColumnRenamed("_la_cid", "_et_cid"), ["_et_cid"], "left", hot=heavy_hitters(et, ["_et_cid"])).groupBy(email, "billing_order_country").agg(
        F.count_distinct("_counted").alias("orders")
    )
    return out.withColumn("customer_type", seg.customer_type("orders"))


def customer_recency(
    orders: DataFrame,
    as_of: dt.date,
    customer: str = "email",
    order_id: str = "order_id",
    order_date: str = "order_date",
    amount: str = "net_sales",
) -> DataFrame:
    """Per-customer recency / frequency / monetary inputs and their segments in one aggregation."""
    asof = F.lit(as_of).cast("date")
    d = F.col(order_date).cast("date")
    m = orders.groupBy(customer).agg(
        F.count_distinct(order_id).alias("total_orders"),
        F.min(d).alias("first_order_date"),
        F.max(d).alias("last_order_date"),
        F.sum(amount).alias("net_revenue"),
    )
    days = F.datediff(asof, F.col("last_order_date"))
    return m.withColumns(
        {
            "days_since_last_order": days,
            "rfm_segment": seg.rfm_segment(days, F.col("total_orders")),
            "recency_category": seg.recency_category(days),
            "frequency_category": seg.frequency_category("total_orders"),
            "monetary_tier": seg.monetary_tier("net_revenue"),
            "ltv_tier": seg.ltv_tier("net_revenue"),
        }
    )
