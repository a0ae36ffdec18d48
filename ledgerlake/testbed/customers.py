"""Customer jobs on the order tables: customer = ``o_custkey``, channel = ``o_orderpriority``,
source = ``o_orderstatus``, gross = ``o_totalprice``, net = gross minus returned line value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import money
from ledgerlake.plans import customer as cust
from ledgerlake.plans.commerce import clean_orders
from ledgerlake.plans.customer import ChannelRules
from ledgerlake.testbed.base import AS_OF, registry, table
from ledgerlake.testbed.commerce import shop_ledger, shop_ledger_rows_sql

QUERIES, ORACLE, q = registry()

RULES = ChannelRules(
    groups={
        "web": ["1-URGENT"],
        "pos": ["2-HIGH"],
        "tiktok": ["3-MEDIUM"],
        "marketplace": ["4-NOT SPECIFIED"],
        "other": ["5-LOW"],
    },
    import_group=None,
    acquisition=[
        (["1-URGENT"], "Web"),
        (["2-HIGH"], "POS"),
        (["3-MEDIUM"], "TikTok"),
        (["4-NOT SPECIFIED"], "Marketplace"),
    ],
    place_by_date={
        "1995-03-05": "London Roadshow",
        "1996-06-14": "Birmingham Roadshow",
        "1997-09-01": "Liverpool Roadshow",
        "1998-11-20": "Manchester Roadshow",
    },
    place_labels=[(["1-URGENT"], "Web"), (["3-MEDIUM"], "TikTok"), (["4-NOT SPECIFIED"], "Marketplace")],
)


def customer_orders(spark, sf):
    """One row per order with gross, refunded-adjusted net, channel and source."""
    refunds = (
        table(spark, sf, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.sum(money("l_extendedprice")).alias("refunded"))
    )
    o = table(spark, sf, "orders")
    return o.join(refunds, o.o_orderkey == refunds.l_orderkey, "left").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        money("o_totalprice").alias("gross_sales"),
        (money("o_totalprice") - F.coalesce(F.col("refunded"), F.lit(0))).alias("net_sales"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("source"),
    )


ORACLE_CUSTOMER_ORDERS = """
refunds AS (
  SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS refunded
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
),
co AS (
  SELECT o.o_custkey AS customer, o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS gross,
         CAST(o.o_totalprice AS DECIMAL(18,2)) - COALESCE(r.refunded, 0) AS net,
         o.o_orderpriority AS ch, o.o_orderstatus AS src
  FROM orders o LEFT JOIN refunds r ON r.l_orderkey = o.o_orderkey
)"""


def _c360(spark, sf):
    return cust.customer_360(
        customer_orders(spark, sf),
        RULES,
        AS_OF,
        customer="customer",
        channel="channel",
        source="source",
        customer_id=None,
    )


M2 = "decimal(38,2)"

# --- rule tables of the oracles: labels and bounds are fixed values --------------------------
# channel code -> group, rank among the behaviour groups (NULL: none), labels
CHANNEL_SQL = """channel(code, grp, rank, only_label, label, place) AS (VALUES
  ('1-URGENT', 'web', 1, 'Online Only', 'Web', 'Web'), ('2-HIGH', 'pos', 2, 'In-Store Only', 'POS', NULL),
  ('3-MEDIUM', 'tiktok', 3, 'TikTok Only', 'TikTok', 'TikTok'),
  ('4-NOT SPECIFIED', 'marketplace', 4, 'Marketplace Only', 'Marketplace', 'Marketplace'), ('5-LOW', 'other', NULL, NULL, 'Unknown', 'Other'))"""
PLACE_SQL = """roadshow(day, place) AS (VALUES (DATE '1995-03-05', 'London Roadshow'), (DATE '1996-06-14', 'Birmingham Roadshow'),
  (DATE '1997-09-01', 'Liverpool Roadshow'), (DATE '1998-11-20', 'Manchester Roadshow'))"""
# value from -> label
LTV_SQL = """ltv(from_value, label) AS (VALUES (-1e300, 'No purchases'), (1e-9, 'Low Value (<£100)'), (100, 'Standard (£100-199)'),
  (200, 'Medium Value (£200-499)'), (500, 'High Value (£500-999)'), (1000, 'VIP (£1000+)'))"""
MONEY_SQL = """money(from_value, label) AS (VALUES (-1e300, 'No purchases'), (1e-9, 'Tier 5 (<£50)'), (50, 'Tier 4 (£50-99)'),
  (100, 'Tier 3 (£100-199)'), (200, 'Tier 2 (£200-499)'), (500, 'Tier 1 (£500+)'))"""
RECENCY_SQL = """recency(from_days, label) AS (VALUES (-1000000, 'Recent (0-3 months)'), (90, 'Active (3-9 months)'),
  (270, 'Lapsing (9-12 months)'), (365, 'Lapsed (12+ months)'))"""
FREQUENCY_SQL = """frequency(from_orders, label) AS (VALUES (-1, 'No orders'), (1, 'One-time'), (2, 'Repeat (2 orders)'),
  (3, 'Repeat (3 orders)'), (4, 'High Value (4+ orders)'))"""
# days since the last order and number of orders, each from .. to -> segment
RFM_SQL = """rfm(d0, d1, n0, n1, label) AS (VALUES
  (-1000000, 89, 4, 1000000, 'High Value Recent Customers'), (-1000000, 89, 1, 3, 'Recent Customers'),
  (90, 269, 4, 1000000, 'High Value Customer'), (90, 269, 2, 3, 'Potential High Value'), (90, 269, 1, 1, 'First Time Customers'),
  (270, 364, 4, 1000000, 'High Value Lapsing'), (270, 364, 1, 3, 'Lapsing'),
  (365, 1000000, 4, 1000000, 'High Value Lapsed'), (365, 1000000, 2, 3, 'Lapsed'), (365, 1000000, 1, 1, 'Lapsed One Time'))"""
# the first rule that holds for the years since the first order's year, orders in the last year, and days since the last
COHORT_SQL = """cohort(rank, y0, y1, r0, d0, d1, label) AS (VALUES
  (1, 0, 0, 0, -1000000, 1000000, 'NEW'), (2, 1, 1, 0, -1000000, 1000000, 'PYNEW'), (3, 2, 1000, 1, -1000000, 1000000, 'PYNON'),
  (4, -1000, 1000, 0, 365, 729, 'PY1INACT'), (5, -1000, 1000, 0, 730, 1094, 'PY2INACT'), (6, -1000, 1000, 0, 1095, 1000000, 'PY3INACT'))"""


def sround2(expr: str) -> str:
    """DuckDB text for Spark's ROUND(.., 2) on a double (half-up on the shortest decimal form)."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


@q(
    "customer_360",
    f"""
WITH {ORACLE_CUSTOMER_ORDERS}, {CHANNEL_SQL}, {PLACE_SQL}, {LTV_SQL}, {COHORT_SQL},
tagged AS (
  SELECT co.*, grp, rank, only_label, label, channel.place, DATE '{AS_OF}' - order_date AS age,
         coalesce(roadshow.place, 'Glasgow Pop-up') AS fair
  FROM co LEFT JOIN channel ON channel.code = co.ch LEFT JOIN roadshow ON roadshow.day = co.order_date
),
by_group AS (
  SELECT customer, grp, any_value(rank) AS rank, any_value(only_label) AS only_label, any_value(label) AS label,
         count(DISTINCT order_id) AS orders, sum(net) AS revenue
  FROM tagged GROUP BY customer, grp
),
groups AS (
  SELECT customer, list(grp) FILTER (rank IS NOT NULL) AS used, min(only_label) AS only_label,
         map_from_entries(list((grp, orders))) AS orders_of, map_from_entries(list((grp, revenue))) AS revenue_of
  FROM by_group GROUP BY customer
),
shares AS (  -- a group without orders has revenue 0; the first of equals wins
  SELECT customer, label, rank, coalesce(revenue_of[grp], 0) AS revenue
  FROM groups, channel WHERE rank IS NOT NULL
),
top AS (
  SELECT customer, CASE WHEN label = 'Marketplace' AND revenue <= 0 THEN 'Other' ELSE label END AS dominant
  FROM shares QUALIFY row_number() OVER (PARTITION BY customer ORDER BY revenue DESC, rank) = 1
),
whole AS (
  SELECT customer, count(DISTINCT order_id) AS total_orders, min(order_date) AS first_day, max(order_date) AS last_day,
         sum(gross) AS gross, sum(gross)::DOUBLE / count(gross) AS mean_gross, max(gross) AS max_gross, sum(net) AS net, max(net) AS max_net,
         sum(gross - net) AS refunded, count(DISTINCT order_id) FILTER (age <= 90) AS last90,
         count(DISTINCT order_id) FILTER (age <= 180) AS last180, count(DISTINCT order_id) FILTER (age <= 365) AS last365,
         arg_min(fair, order_date) FILTER (grp = 'pos') AS pos_city,
         arg_min({{'label': label, 'place': coalesce(place, fair)}}, (order_date, order_id)) AS start
  FROM tagged GROUP BY customer
),
facts AS (
  SELECT *, DATE '{AS_OF}' - last_day AS idle, DATE '{AS_OF}' - first_day AS age, year(DATE '{AS_OF}') - year(first_day) AS years FROM whole
)
SELECT f.customer, total_orders, coalesce(orders_of['web'], 0) AS web_orders, coalesce(orders_of['pos'], 0) AS pos_orders,
  coalesce(orders_of['tiktok'], 0) AS tiktok_orders, coalesce(orders_of['marketplace'], 0) AS marketplace_orders,
  coalesce(orders_of['other'], 0) AS other_orders,
  list_contains(coalesce(used, []), 'web') AS has_web_orders, list_contains(coalesce(used, []), 'pos') AS has_pos_orders,
  list_contains(coalesce(used, []), 'tiktok') AS has_tiktok_orders, list_contains(coalesce(used, []), 'marketplace') AS has_marketplace_orders,
  last90 AS orders_last_90_days, last180 AS orders_last_180_days, last365 AS orders_last_365_days,
  first_day AS first_order_date, last_day AS last_order_date, idle AS days_since_last_order, age AS customer_age_days,
  gross::DECIMAL(38,2) AS gross_revenue, mean_gross AS avg_gross_order_value, max_gross::DECIMAL(38,2) AS max_gross_order_value,
  net::DECIMAL(38,2) AS net_revenue, max_net::DECIMAL(38,2) AS max_net_order_value, refunded::DECIMAL(38,2) AS total_refunded,
  {sround2("refunded::DOUBLE * 100.0 / nullif(gross::DOUBLE, 0)")} AS refund_rate_pct,
  coalesce(revenue_of['web'], 0)::DECIMAL(38,2) AS web_revenue, coalesce(revenue_of['pos'], 0)::DECIMAL(38,2) AS pos_revenue,
  CASE coalesce(len(used), 0) WHEN 0 THEN 'Other' WHEN 1 THEN only_label ELSE 'Omnichannel' END AS channel_behavior,
  coalesce(len(used), 0)::INTEGER AS unique_channels_used, dominant AS dominant_channel_by_revenue,
  start.label AS acquisition_channel, start.place AS customer_acquisition_location, pos_city AS pos_acquisition_city,
  {sround2("net::DOUBLE")} AS customer_lifetime_value, {sround2("net::DOUBLE / nullif(total_orders, 0)")} AS average_order_value,
  {sround2("net::DOUBLE / nullif(age, 0) * 365.0")} AS annualized_value,
  if(total_orders > 1, 'Returning customer', 'New customer') AS customer_type,
  (SELECT arg_max(label, from_value) FROM ltv WHERE net >= from_value) AS ltv_tier,
  coalesce((SELECT arg_min(label, rank) FROM cohort WHERE years BETWEEN y0 AND y1 AND last365 >= r0 AND idle BETWEEN d0 AND d1), 'Uncategorised') AS gm_segment
FROM facts f JOIN groups USING (customer) JOIN top USING (customer)
""",
)
def q_customer_360(spark, sf):
    c = _c360(spark, sf)
    return c.select(
        "customer", "total_orders", "web_orders", "pos_orders", "tiktok_orders", "marketplace_orders", "other_orders",
        "has_web_orders", "has_pos_orders", "has_tiktok_orders", "has_marketplace_orders",
        "orders_last_90_days", "orders_last_180_days", "orders_last_365_days",
        "first_order_date", "last_order_date", "days_since_last_order", "customer_age_days",
        F.col("gross_revenue").cast(M2).alias("gross_revenue"), "avg_gross_order_value",
        F.col("max_gross_order_value").cast(M2).alias("max_gross_order_value"),
        F.col("net_revenue").cast(M2).alias("net_revenue"),
        F.col("max_net_order_value").cast(M2).alias("max_net_order_value"),
        F.col("total_refunded").cast(M2).alias("total_refunded"), "refund_rate_pct",
        F.col("web_revenue").cast(M2).alias("web_revenue"), F.col("pos_revenue").cast(M2).alias("pos_revenue"),
        "channel_behavior", "unique_channels_used", "dominant_channel_by_revenue",
        "acquisition_channel", "customer_acquisition_location", "pos_acquisition_city",
        "customer_lifetime_value", "average_order_value", "annualized_value",
        "customer_type", "ltv_tier", "gm_segment",
    )


def rfm_segments(spark, sf):
    """Flagship: customer recency/frequency/monetary -> segment -> customers and revenue per segment."""
    o = table(spark, sf, "orders")
    per_customer = cust.customer_recency(
        o.select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("amount")),
        AS_OF,
        customer="o_custkey",
        order_id="o_orderkey",
        order_date="o_orderdate",
        amount="amount",
    )
    return per_customer.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_orders").alias("orders"),
        F.sum("net_revenue").cast(M2).alias("revenue"),
    )


PER_CUSTOMER_SQL = f"""c AS (
  SELECT o_custkey, count(DISTINCT o_orderkey) AS n, DATE '{AS_OF}' - max(o_orderdate::DATE) AS d, sum(o_totalprice::DECIMAL(18,2)) AS revenue
  FROM orders GROUP BY o_custkey
)"""

q(
    "rfm_segments",
    f"""
WITH {RFM_SQL}, {PER_CUSTOMER_SQL}
SELECT coalesce(label, 'Uncategorised') AS rfm_segment, count(*) AS customers, sum(n) AS orders, sum(revenue)::DECIMAL(38,2) AS revenue
FROM c LEFT JOIN rfm ON d BETWEEN d0 AND d1 AND n BETWEEN n0 AND n1 GROUP BY ALL
""",
)(rfm_segments)


@q(
    "cohort_segments",
    f"""
WITH {ORACLE_CUSTOMER_ORDERS}, {COHORT_SQL},
c AS (
  SELECT customer, year(DATE '{AS_OF}') - year(min(order_date)) AS years, DATE '{AS_OF}' - max(order_date) AS idle,
         count(DISTINCT order_id) FILTER (DATE '{AS_OF}' - order_date <= 365) AS recent
  FROM co GROUP BY customer
)
SELECT customer, coalesce(arg_min(label, rank), 'Uncategorised') AS gm_segment
FROM c LEFT JOIN cohort ON years BETWEEN y0 AND y1 AND recent >= r0 AND idle BETWEEN d0 AND d1 GROUP BY customer
""",
)
def q_cohort_segments(spark, sf):
    return _c360(spark, sf).select("customer", "gm_segment")


@q(
    "value_tiers",
    f"""
WITH {RECENCY_SQL}, {FREQUENCY_SQL}, {MONEY_SQL}, {LTV_SQL}, {PER_CUSTOMER_SQL}
SELECT o_custkey,
  (SELECT arg_max(label, from_days) FROM recency WHERE d >= from_days) AS recency_category,
  (SELECT arg_max(label, from_orders) FROM frequency WHERE n >= from_orders) AS frequency_category,
  (SELECT arg_max(label, from_value) FROM money WHERE revenue / 1000 >= from_value) AS monetary_tier,
  (SELECT arg_max(label, from_value) FROM ltv WHERE revenue / 1000 >= from_value) AS ltv_tier
FROM c
""",
)
def q_value_tiers(spark, sf):
    """Tiers on revenue in thousands (the stand-in prices are ~1000x the reference's order values)."""
    o = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", (money("o_totalprice") / F.lit(1000)).alias("amount_k")
    )
    c = cust.customer_recency(o, AS_OF, "o_custkey", "o_orderkey", "o_orderdate", "amount_k")
    return c.select("o_custkey", "recency_category", "frequency_category", "monetary_tier", "ltv_tier")


@q(
    "conditional_distinct_counts",
    """
SELECT o_custkey,
  COUNT(DISTINCT o_orderkey) AS total_orders,
  COUNT(DISTINCT CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-08-02' - INTERVAL 90 DAY THEN o_orderkey END) AS orders_last_90_days,
  COUNT(DISTINCT CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-08-02' - INTERVAL 180 DAY THEN o_orderkey END) AS orders_last_180_days,
  COUNT(DISTINCT CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-08-02' - INTERVAL 365 DAY THEN o_orderkey END) AS orders_last_365_days,
  COUNT(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS web_orders,
  COUNT(DISTINCT CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey END) AS pos_orders,
  COUNT(DISTINCT CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderkey END) AS tiktok_orders,
  COUNT(DISTINCT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderkey END) AS marketplace_orders,
  COUNT(DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END) AS other_orders
FROM orders GROUP BY o_custkey
""",
)
def q_conditional_distinct_counts(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("gross_sales"),
        F.col("o_totalprice").alias("net_sales"),
        F.col("o_orderpriority").alias("channel"),
    )
    c = cust.customer_360(o, RULES, AS_OF, customer="customer", channel="channel", source=None, customer_id=None)
    return c.select(
        F.col("customer").alias("o_custkey"), "total_orders", "orders_last_90_days", "orders_last_180_days",
        "orders_last_365_days", "web_orders", "pos_orders", "tiktok_orders", "marketplace_orders", "other_orders",
    )


@q(
    "primary_value",
    """
WITH c AS (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, o_orderpriority AS primary_priority, n AS primary_priority_count
FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority ASC) = 1
""",
)
def q_primary_value(spark, sf):
    o = table(spark, sf, "orders")
    return cust.primary_value(o, "o_custkey", "o_orderpriority", out="primary_priority")


@q(
    "acquisition_place",
    f"""
WITH {CHANNEL_SQL}, {PLACE_SQL},
start AS (SELECT o_custkey AS customer, arg_min({{'ch': o_orderpriority, 'day': o_orderdate::DATE}}, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY ALL)
SELECT customer, coalesce(channel.place, roadshow.place, 'Glasgow Pop-up') AS customer_acquisition_location
FROM start JOIN channel ON channel.code = s.ch LEFT JOIN roadshow ON roadshow.day = s.day
""",
)
def q_acquisition_place(spark, sf):
    return _c360(spark, sf).select("customer", "customer_acquisition_location")


@q(
    "latest_order_per_customer",
    """
SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""",
)
def q_latest_order_per_customer(spark, sf):
    from ledgerlake.operators import latest_per_key

    o = table(spark, sf, "orders")
    latest = latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select(
        "o_custkey", "o_orderkey", "o_orderstatus", money("o_totalprice").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority",
    )


@q(
    "first_order_flag",
    """
WITH f AS (
  SELECT o_orderkey FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
)
SELECT o.o_orderkey, o.o_custkey, CASE WHEN f.o_orderkey IS NOT NULL THEN 'New' ELSE 'Returning' END AS order_type
FROM orders o LEFT JOIN f ON f.o_orderkey = o.o_orderkey
""",
)
def q_first_order_flag(spark, sf):
    from ledgerlake.plans.commerce import order_type_flags

    o = table(spark, sf, "orders")
    return order_type_flags(o, customer="o_custkey", order_id="o_orderkey", created_at="o_orderdate").select(
        "o_orderkey", "o_custkey", "order_type"
    )


@q(
    "customer_summary",
    f"""
WITH {shop_ledger_rows_sql()},
placed AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, lower(c_name) AS email, o_orderdate::DATE AS day, n_name AS country
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
),
home AS (SELECT DISTINCT unnest(h.s) FROM (
  SELECT email, arg_max({{'cid': customer_id, 'country': country}}, (day, order_id)) AS s FROM placed WHERE country IS NOT NULL GROUP BY email) h)
SELECT email, home.country AS billing_order_country, count(DISTINCT l.orders_order_id) AS orders,
       if(count(DISTINCT l.orders_order_id) > 1, 'Returning customer', 'New customer') AS customer_type
FROM ledger_ids l LEFT JOIN placed USING (order_id) LEFT JOIN home ON home.cid = placed.customer_id
GROUP BY ALL
""",
)
def q_customer_summary(spark, sf):
    """E-mail summaries over the shop ledger, whose refund rows of orders before its start have no order of their own."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    et = (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.lower("c_name").alias("email"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("n_name").alias("billing_address_country"),
        )
    )
    out = cust.customer_summary(shop_ledger(spark, sf).select("order_id", "orders_order_id"), et, et)
    return out.select("email", "billing_order_country", "orders", "customer_type")


# --- Customer orders from landed shop and import orders ---------------------------------------
IMPORT_APP, SKIPPED_APP, PLACEHOLDER = 9, 5, 7
APPS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": IMPORT_APP}  # 5-LOW: none, or the skipped one
IMPORT_RATES = [("GBP", 1.0), ("EUR", 1.25)]
LANDED_RULES = ChannelRules(
    groups={"web": [1], "pos": [2], "tiktok": [3], "marketplace": [4], "magento": [IMPORT_APP]},
    acquisition=[([1], "Web"), ([2], "POS"), ([IMPORT_APP], "Import")],
    acquisition_detail=[([1], "f", "Web F"), ([1], None, "Web other"), ([IMPORT_APP], "o", "Import O")],
)


def _landed_orders(spark, sf):
    """orders in the landed shop schema: NULL apps, tests, missing e-mails, several financial states and currencies."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    o = table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    key, cust_key, state = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    app = F.coalesce(*[F.when(F.col("o_orderpriority") == p, F.lit(a)) for p, a in APPS.items()], F.when(key % 2 == 0, F.lit(SKIPPED_APP)))
    code = F.when(cust_key % 11 == 0, "USD").when(key % 3 == 0, "EUR").otherwise("GBP")
    price = F.col("o_totalprice").cast("string")
    address = {f"{kind}_address__{part}": F.concat(F.lit(kind[0] + part[0]), F.col("n_name"))
               for kind in ("billing", "shipping") for part in ("country", "city", "province", "zip")}
    return o.select(
        key.alias("id"), F.concat(F.lit("#"), key.cast("string")).alias("name"), app.alias("app_id"), state.alias("source_name"),
        F.when(cust_key % 13 != 0, F.concat(F.lit("C"), F.lower("c_name"))).alias("email"), (cust_key % 50).alias("customer__id"),
        F.when(state == "F", "paid").when(state == "O", "pending").otherwise("voided").alias("financial_status"),
        (key % 17 == 0).alias("test"), F.col("o_orderdate").alias("processed_at"), F.col("o_orderdate").alias("created_at"),
        F.when(cust_key % 3 != 0, key % 2 == 0).alias("buyer_accepts_marketing"),
        F.when(app == IMPORT_APP, code).otherwise(F.concat(F.lit('"'), code, F.lit('"'))).alias("total_price_set__shop_money__currency_code"),
        price.alias("total_line_items_price_set__shop_money__amount"), price.alias("total_discounts_set__shop_money__amount"),
        price.alias("current_total_price_set__shop_money__amount"), *[e.alias(n) for n, e in address.items()],
    )


def landed_customer_orders(spark, sf):
    landed = _landed_orders(spark, sf)
    rates = spark.createDataFrame(IMPORT_RATES, "currency string, rate double")
    imported, _ = cust.import_orders(landed, rates, [IMPORT_APP])
    return cust.customer_orders(clean_orders(landed, zone="UTC"), imported, [IMPORT_APP], [SKIPPED_APP], [PLACEHOLDER])


LANDED_SQL = f"""
rate(code, r) AS (VALUES ('GBP', 1.0::DOUBLE), ('EUR', 1.25::DOUBLE)),
app(priority, nr) AS (VALUES {", ".join(f"('{p}', {a})" for p, a in APPS.items())}),
raw AS (
  SELECT o_orderkey AS order_id, o_orderdate::DATE AS order_date, o_totalprice AS price, o_custkey % 50 AS customer_id, o_orderstatus AS source_name,
         coalesce(nr, if(o_orderkey % 2 = 0, {SKIPPED_APP}, NULL)) AS app_id, lower('C' || c_name) AS email, n_name,
         if(o_custkey % 3 <> 0, o_orderkey % 2 = 0, NULL) AS buyer_accepts_marketing,
         if(o_custkey % 11 = 0, 'USD', if(o_orderkey % 3 = 0, 'EUR', 'GBP')) AS code
  FROM orders LEFT JOIN app ON priority = o_orderpriority LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderkey % 17 <> 0 AND o_custkey % 13 <> 0 AND o_orderstatus IN ('F', 'O')
),
customer_orders AS (
  SELECT raw.*, app_id = {IMPORT_APP} AS is_magento_order, app_id = {IMPORT_APP} AND code <> 'GBP' AS is_currency_converted,
         if(app_id = {IMPORT_APP}, {sround2("price / r")}, price) AS sales
  FROM raw LEFT JOIN rate USING (code)
  WHERE if(app_id = {IMPORT_APP}, r IS NOT NULL, app_id <> {SKIPPED_APP} AND customer_id <> {PLACEHOLDER} AND code = 'GBP')
)"""


@q(
    "customer_orders",
    f"""
WITH {LANDED_SQL}
SELECT email, order_date, sales AS gross_sales, sales AS net_sales, order_id, customer_id, app_id, source_name,
       {", ".join(f"'{k[0]}{part[0]}' || n_name AS {k}_address_{part}" for k in ("billing", "shipping") for part in ("country", "city", "province", "zip"))},
       buyer_accepts_marketing, is_magento_order, is_currency_converted
FROM customer_orders
""",
)
def q_customer_orders(spark, sf):
    """Shop orders and converted imports as one order history, from the landed schema."""
    return landed_customer_orders(spark, sf)


@q(
    "customer_360_landed",
    f"""
WITH {LANDED_SQL},
used AS (SELECT email, source_name, count(*) AS n FROM customer_orders GROUP BY ALL),
who AS (
  SELECT email, count(DISTINCT order_id) AS total_orders, max(customer_id) AS customer_id, bool_or(app_id = 1) AS has_web_orders,
         bool_or(app_id = {IMPORT_APP}) AS has_magento_orders, count(DISTINCT order_id) FILTER (app_id <> {IMPORT_APP}) AS shopify_orders,
         max(n_name) AS home, bool_or(buyer_accepts_marketing) AS accepts_marketing,
         arg_min({{'app': app_id, 'src': lower(source_name)}}, (order_date, order_id)) AS start, sum(sales) AS revenue
  FROM customer_orders GROUP BY email
)
SELECT who.email, total_orders, customer_id, has_web_orders, has_magento_orders, shopify_orders, accepts_marketing, 'bc' || home AS billing_order_country,
       'bc' || home AS billing_city, 'bp' || home AS billing_province, 'bz' || home AS billing_postcode, 'sc' || home AS shipping_order_country,
       'sc' || home AS shipping_city, 'sp' || home AS shipping_province,
       if(start.app = 1, 'Web', if(start.app = 2, 'POS', if(start.app = {IMPORT_APP}, 'Import', 'Unknown'))) AS acquisition_channel,
       if(start.app = 1, if(start.src = 'f', 'Web F', 'Web other'), if(start.app = {IMPORT_APP} AND start.src = 'o', 'Import O', 'Other')) AS acquisition_channel_detail,
       (SELECT arg_min(source_name, (-n, source_name)) FROM used WHERE used.email = who.email) AS primary_order_source,
       {sround2("revenue")} AS customer_lifetime_value
FROM who
""",
)
def q_customer_360_landed(spark, sf):
    """The customer model over the landed order history, with its address, consent and source columns."""
    c = cust.customer_360(
        landed_customer_orders(spark, sf), LANDED_RULES, AS_OF, maxima=cust.CUSTOMER_MAXIMA, primary_source=True
    )
    return c.select(
        "email", "total_orders", "customer_id", "has_web_orders", "has_magento_orders", "shopify_orders", "accepts_marketing",
        "billing_order_country", "billing_city", "billing_province", "billing_postcode", "shipping_order_country", "shipping_city",
        "shipping_province", "acquisition_channel", "acquisition_channel_detail", "primary_order_source", "customer_lifetime_value",
    )


@q(
    "london_orders",
    """
SELECT event_id AS id, timezone('Europe/London', timezone('UTC', ts))::DATE AS order_date, if(user_id % 4 = 0, NULL, value) AS duties
FROM events WHERE event_type NOT IN ('error', 'signup')
""",
)
def q_london_orders(spark, sf):
    """Cleaned orders dated in London, from events as orders (errors are tests, sign-ups of unknown kind)."""
    e = table(spark, sf, "events")
    o = e.select(
        F.col("event_id").alias("id"), F.col("ts").alias("created_at"),
        F.when(F.col("event_type") != "signup", F.col("event_type") == "error").alias("test"),
        F.when(F.col("user_id") % 4 != 0, F.col("value").cast("string")).otherwise(F.lit("n/a")).alias("duties_text"),
    )
    return clean_orders(o, duties="duties_text").select("id", "order_date", "duties")
