"""Shop jobs on the TPC-style tables.

Mapping: order = ``orders`` row; line = ``lineitem`` row with line id
``l_orderkey * 100 + l_linenumber`` (not unique in the data, so joins on it fan
out as the reference's do); product = ``part``; refund line = returned line
(``l_returnflag = 'R'``), refund = (order, ship date); country = customer
nation with ``NATION_23`` as home country; currency = ``o_orderpriority``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.functions import local_date, money, title_case, trim_ws, utc_date
from ledgerlake.functions.json import json_scalar
from ledgerlake.operators import neighbour_value
from ledgerlake.plans import commerce as com
from ledgerlake.plans.incremental import LedgerRules, refresh_ledger
from ledgerlake.session import default_parallelism
from ledgerlake.sources.sinks import incremental_slice, staged, staged_by_key
from ledgerlake.sources.tables import drop_path
from ledgerlake.testbed.base import CAL_START, CAL_YEARS, registry, scratch, table

QUERIES, ORACLE, q = registry()

HOME = "NATION_23"
def line_id():
    return F.col("l_orderkey") * 100 + F.col("l_linenumber")

SQL_LINE_ID = "(l_orderkey * 100 + l_linenumber)"


def sround(expr: str, k: int = 2) -> str:
    """DuckDB text for Spark's ROUND on a double (half-up on the shortest decimal form)."""
    return f"CAST(ROUND(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


def _orders_with_country(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")


def _line_frames(spark, sf):
    li = table(spark, sf, "lineitem")
    return _line_frames_of(li, li.where(F.col("l_returnflag") == "R"))


def _line_frames_of(li, returned):
    lines = li.select(
        line_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("variant_id"),
        F.col("l_linestatus").alias("title"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("price"),
        F.col("l_quantity").alias("quantity"),
    )
    refund_lines = returned.select(
        line_id().alias("line_item_id"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("subtotal")
    )
    tax_lines = li.select(
        line_id().alias("order_line_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("GB VAT")).otherwise(F.lit("EU VAT")).alias("title"),
        F.col("l_tax").alias("rate"),
        F.col("l_tax").alias("price"),
    )
    return lines, refund_lines, tax_lines


# Lines with their order's day and country, product, refunded part and VAT rate. A line id may stand on
# several rows, and so may its refunds and taxes: they multiply. VAT comes off at home and where the country is unknown.
LINES_SQL = f"""
place AS (
  SELECT o_orderkey AS order_id, o_orderdate::DATE AS order_date, n_name AS billing_order_country
  FROM orders LEFT JOIN (customer LEFT JOIN nation ON n_nationkey = c_nationkey) ON c_custkey = o_custkey
),
line AS (
  SELECT {SQL_LINE_ID} AS order_line_id, l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS variant_id, l_linestatus AS title,
         l_quantity AS n, {sround('l_extendedprice / l_quantity')} AS unit, l_returnflag = 'R' AS is_back,
         l_linestatus = 'F' AND l_tax <> 0 AS has_vat, l_extendedprice AS value, l_tax
  FROM lineitem
),
line_facts AS (
  SELECT order_date, billing_order_country, line.order_line_id, line.order_id, line.product_id, line.variant_id, line.title,
         p_name AS handle, p_type AS product_type, p_brand AS vendor, vat.l_tax AS rate, back.order_line_id AS refund_order_line_id,
         sum(back.n) AS refund_quantity, sum(back.value) AS refund_subtotal, sum(line.unit) AS total_sales, sum(line.n) AS quantity,
         sum(line.unit * line.n / (1 + if(coalesce(billing_order_country, '{HOME}') = '{HOME}', coalesce(vat.l_tax, 0), 0))) AS gross_sales
  FROM line JOIN place USING (order_id) LEFT JOIN part ON p_partkey = line.product_id
  LEFT JOIN line back ON back.is_back AND back.order_line_id = line.order_line_id
  LEFT JOIN line vat ON vat.has_vat AND vat.order_line_id = line.order_line_id
  GROUP BY ALL
)"""


@q(
    "line_facts",
    f"""
WITH {LINES_SQL},
total AS (SELECT order_id, sum(total_sales) AS order_total FROM line_facts GROUP BY order_id)
SELECT line_facts.* REPLACE ({sround('refund_subtotal')} AS refund_subtotal, {sround('total_sales')} AS total_sales, {sround('gross_sales')} AS gross_sales),
       nullif(regexp_extract(handle, '[a-z]+'), '') AS handle_first_string, {sround('order_total')} AS order_total
FROM line_facts JOIN total USING (order_id)
""",
)
def q_line_facts(spark, sf):
    lines, refund_lines, tax_lines = _line_frames(spark, sf)
    orders = _orders_with_country(spark, sf).select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("order_date"), F.col("n_name").alias("country")
    )
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("handle"), F.col("p_type").alias("product_type"),
        F.col("p_brand").alias("vendor"),
    )
    lf = com.order_line_facts(lines, orders, products, refund_lines, tax_lines, home=HOME, vat_title="GB VAT", country="country")
    return lf.select(
        "order_date", "billing_order_country", "order_line_id", "order_id", "product_id", "variant_id", "title",
        "handle", "product_type", "vendor", "handle_first_string", "rate", "refund_order_line_id", "refund_quantity",
        F.round("refund_subtotal", 2).alias("refund_subtotal"), F.round("total_sales", 2).alias("total_sales"),
        "quantity", F.round("gross_sales", 2).alias("gross_sales"), F.round("order_total", 2).alias("order_total"),
    )


def refund_id():
    return F.col("l_orderkey") * 100000 + F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))

SQL_REFUND_ID = "(l_orderkey * 100000 + date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)))"
D4 = "decimal(18,4)"


def _refund_inputs(spark, sf):
    li = table(spark, sf, "lineitem")
    line_facts = li.select(line_id().alias("order_line_id"), F.col("l_quantity").alias("quantity"))
    return (*_refund_inputs_of(li.where(F.col("l_returnflag") == "R"), table(spark, sf, "orders")), line_facts)


def _refund_inputs_of(r, placed):
    price = money("l_extendedprice")
    refund_lines = r.select(
        refund_id().alias("id"), line_id().alias("line_item_id"), F.col("l_quantity").alias("quantity"),
        price.alias("subtotal"), (price * F.col("l_tax").cast("decimal(4,2)")).alias("total_tax"),
    )
    refunds = (
        r.select(refund_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("created_at"))
        .distinct()
        .join(placed.select("o_orderkey", "o_custkey"), F.col("order_id") == F.col("o_orderkey"), "left")
        .select("id", "order_id", F.col("o_custkey").alias("user_id"), "created_at")
    )
    disc = price * F.col("l_discount").cast("decimal(4,2)")
    adjustments = r.select(
        refund_id().alias("refund_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("shipping_refund")).otherwise(F.lit("refund_discrepancy")).alias("kind"),
        F.lit("stand-in").alias("reason"),
        (-disc).alias("amount"),
        (-disc * F.col("l_tax").cast("decimal(4,2)")).alias("tax_amount"),
    )
    orders = placed.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_custkey") % 7).alias("app_id"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("EUR"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.lit("GBP"))
        .alias("presentment_currency"),
        F.col("o_orderstatus").alias("billing_address__country"),
    )
    return refund_lines, adjustments, refunds, orders


# A refund is what comes back of one order on one day. Its lines count once per line that shares their id;
# its adjustments (the discount given back: shipping for finished lines, else a discrepancy) count once.
SAME_ID_SQL = f"same_id AS (SELECT {SQL_LINE_ID} AS id, count(*) AS times, sum(l_quantity) AS pieces FROM lineitem GROUP BY 1)"
REFUND_SQL = f"""
back AS (
  SELECT l_orderkey AS order_id, l_shipdate::DATE AS refund_date, coalesce(times, 1) AS times, coalesce(pieces, 0) AS pieces, l_linestatus = 'F' AS finished,
         l_extendedprice::DECIMAL(18,2) AS price, l_tax::DECIMAL(4,2) AS tax,
         -(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2)) AS given
  FROM lineitem LEFT JOIN same_id ON same_id.id = {SQL_LINE_ID} WHERE l_returnflag = 'R'
),
refund AS (
  SELECT order_id, refund_date, sum(pieces) AS quantity, sum((price * times)::DECIMAL(24,4)) AS subtotal,
         sum((price * tax * times)::DECIMAL(24,4)) AS total_tax,
         sum(given::DECIMAL(18,4)) FILTER (finished) AS ship_amt, sum((given * tax)::DECIMAL(18,4)) FILTER (finished) AS ship_tax,
         sum(given::DECIMAL(18,4)) FILTER (NOT finished) AS disc_amt, sum((given * tax)::DECIMAL(18,4)) FILTER (NOT finished) AS disc_tax
  FROM back GROUP BY order_id, refund_date
),
currency_of(priority, code) AS (VALUES ('1-URGENT', 'EUR'), ('2-HIGH', 'GBP'), ('3-MEDIUM', 'GBP'), ('4-NOT SPECIFIED', 'GBP')),
refund_days AS (
  SELECT refund.*, o_orderdate::DATE AS order_date, '#' || o_orderkey AS order_name, o_custkey AS user_id, o_custkey % 7 AS app_id,
         o_orderstatus AS billing_order_country, code AS presentment_currency, 1::BIGINT AS number_of_orders,
         coalesce(disc_tax, 0) + coalesce(ship_tax, 0) - total_tax AS refund_tax,
         if(code IS NULL, NULL, round(coalesce(disc_amt, 0) - subtotal + if(code = 'GBP', total_tax, coalesce(disc_tax, 0)), 2)) AS refund_amount_actuals
  FROM refund LEFT JOIN orders ON o_orderkey = refund.order_id LEFT JOIN currency_of ON priority = o_orderpriority
)"""


def _refund_days(spark, sf):
    return com.refund_ledger(*_refund_inputs(spark, sf), zone="UTC", num=D4)


D38 = "decimal(38,4)"


@q(
    "refund_by_day",
    f"""
WITH {SAME_ID_SQL}, {REFUND_SQL}
SELECT refund_date, order_date, order_id, order_name, user_id, app_id, billing_order_country, presentment_currency,
  quantity, number_of_orders, CAST(subtotal AS DECIMAL(38,4)) AS subtotal, CAST(total_tax AS DECIMAL(38,4)) AS total_tax,
  CAST(refund_tax AS DECIMAL(38,4)) AS refund_tax, CAST(ship_amt AS DECIMAL(38,4)) AS refund_shipping_amount,
  CAST(disc_amt AS DECIMAL(38,4)) AS order_adjustment_refund_discrepancy_amount,
  CAST(refund_amount_actuals AS DECIMAL(38,4)) AS refund_amount_actuals
FROM refund_days
""",
)
def q_refund_by_day(spark, sf):
    r = _refund_days(spark, sf)
    return r.select(
        "refund_date", "order_date", "order_id", "order_name", "user_id", "app_id", "billing_order_country",
        "presentment_currency", "quantity", "number_of_orders",
        *[F.col(c).cast(D38).alias(c) for c in ("subtotal", "total_tax", "refund_tax", "refund_shipping_amount",
                                                "order_adjustment_refund_discrepancy_amount", "refund_amount_actuals")],
    )


def _order_days(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    price = money("l_extendedprice")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.sum(price * F.col("l_tax").cast("decimal(4,2)")).alias("total_tax"),
        F.sum(-(price * F.col("l_discount").cast("decimal(4,2)"))).alias("discount"),
        F.sum(price).alias("gross_sales"),
    )
    flagged = com.order_type_flags(o, customer="o_custkey", order_id="o_orderkey", created_at="o_orderdate")
    return flagged.join(per_order, flagged.o_orderkey == per_order.l_orderkey, "left").select(
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("order_name"),
        (F.col("o_custkey") % 7).alias("app_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("billing_order_country"),
        "order_type",
        F.lit(1).cast("bigint").alias("number_of_orders"),
        "quantity",
        money("o_totalprice").alias("total_sales"),
        "total_tax",
        "discount",
        "gross_sales",
    )


LEDGER_OUT = [
    "fulldate", "order_id", "order_name", "orders_order_id", "app_id", "return_order_id", "refund_date", "user_id",
    "order_type", "billing_order_country", "number_of_orders", "quantity", "refund_order_count",
]
LEDGER_MONEY = [
    "tax", "shipping_cost", "duties", "discount", "returns", "total_sales", "total_sales_plus_returns", "gross_sales",
    "net_sales", "net_sales_plus_returns", "sales",
]


# The ledger from ``order_day`` and ``refund_days``: an order meets what came back of it on its own day; other
# refunds stand alone. Amounts that are missing count as nothing.
LEDGER_SQL = """
met AS (
  SELECT d.order_date AS fulldate, d.order_id, d.order_name, d.order_id AS orders_order_id, d.app_id, r.order_id AS return_order_id, r.refund_date,
         d.user_id::VARCHAR AS user_id, d.email, d.customer_id, d.order_type, d.billing_order_country, d.number_of_orders, d.quantity,
         r.number_of_orders AS refund_order_count, d.total_tax, d.discount, d.shipping, d.total_price, d.line_gross,
         r.refund_tax, r.ship_amt, r.refund_amount_actuals AS refunded
  FROM order_day d LEFT JOIN refund_days r ON r.order_id = d.order_id AND r.refund_date = d.order_date
  UNION ALL
  SELECT refund_date, order_id, order_name, NULL, app_id, order_id, refund_date, user_id::VARCHAR, NULL, NULL, NULL, billing_order_country,
         NULL, NULL, number_of_orders, NULL, NULL, NULL, NULL, NULL, refund_tax, ship_amt, refund_amount_actuals
  FROM refund_days r WHERE NOT EXISTS (FROM order_day d WHERE d.order_id = r.order_id AND d.order_date = r.refund_date)
),
flow AS (
  SELECT *, coalesce(total_tax, 0) + coalesce(refund_tax, 0) AS tax, coalesce(shipping, 0) + coalesce(ship_amt, 0) AS shipping_cost, 0 AS duties,
         coalesce(discount, 0) AS off, coalesce(refunded, 0) AS returns, coalesce(total_price, 0) + coalesce(refunded, 0) AS total_sales,
         (date_diff('day', DATE '1995-01-01', fulldate) // 7)::INTEGER AS week
  FROM met
),
ledger AS (
  SELECT * EXCLUDE (discount), off AS discount, total_sales - tax - shipping_cost AS net_sales, total_sales + abs(returns) AS total_sales_plus_returns,
         total_sales + abs(returns) + abs(off) - tax - shipping_cost AS gross_sales, total_sales - tax - shipping_cost + abs(returns) AS net_sales_plus_returns,
         total_sales - tax - shipping_cost + shipping_cost AS sales, line_gross AS order_line_agg_gross_sales,
         (1995 + week // 52)::INTEGER AS retail_year, (1 + week % 52)::INTEGER AS retail_week
  FROM flow
)"""


@q(
    "order_refund_ledger",
    f"""
WITH {SAME_ID_SQL}, {REFUND_SQL},
sold AS (
  SELECT l_orderkey AS id, sum(l_quantity) AS pieces, sum(l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(4,2)) AS tax,
         sum(-(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))) AS off
  FROM lineitem GROUP BY 1
),
order_day AS (
  SELECT o_orderdate::DATE AS order_date, o_orderkey AS order_id, '#' || o_orderkey AS order_name, o_custkey % 7 AS app_id, o_custkey AS user_id,
         NULL AS email, o_custkey AS customer_id,
         if(o_orderkey = arg_min(o_orderkey, (o_orderdate, o_orderkey)) OVER (PARTITION BY o_custkey), 'New', 'Returning') AS order_type,
         o_orderstatus AS billing_order_country, 1::BIGINT AS number_of_orders, pieces AS quantity, tax AS total_tax, off AS discount,
         NULL::DECIMAL(18,4) AS shipping, o_totalprice::DECIMAL(18,2) AS total_price, NULL::DOUBLE AS line_gross
  FROM orders LEFT JOIN sold ON sold.id = o_orderkey
),
{LEDGER_SQL}
SELECT {", ".join(LEDGER_OUT)}, {", ".join(f"{c}::DECIMAL(38,4) AS {c}" for c in LEDGER_MONEY)}, retail_year, retail_week FROM ledger
""",
)
def q_order_refund_ledger(spark, sf):
    ledger = com.order_metrics_ledger(
        _order_days(spark, sf), _refund_days(spark, sf), calendar={"start": CAL_START, "years": CAL_YEARS}
    )
    return ledger.select(
        *LEDGER_OUT, *[F.col(c).cast(D38).alias(c) for c in LEDGER_MONEY], "retail_year", "retail_week"
    )


@q(
    "hashed_customer_names",
    """
SELECT c_custkey, sha256(regexp_replace(lower(c_name), '^\\s+|\\s+$', '', 'g')) AS name_hash FROM customer
""",
)
def q_hashed_customer_names(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.sha2(trim_ws(F.lower("c_name")), 256).alias("name_hash"))


# Stand-in FX table: one rate per priority code, the base code at 1.0, '5-LOW' deliberately missing.
FX_ROWS = [("3-MEDIUM", 1.0), ("1-URGENT", 1.26), ("2-HIGH", 1.25), ("4-NOT SPECIFIED", 0.85)]
FX_SQL = "(VALUES ('3-MEDIUM', 1.0::DOUBLE), ('1-URGENT', 1.26::DOUBLE), ('2-HIGH', 1.25::DOUBLE), ('4-NOT SPECIFIED', 0.85::DOUBLE)) fx(currency, rate)"


def _convert(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("currency"),
                                           F.col("o_totalprice").alias("amount"))
    rates = spark.createDataFrame(FX_ROWS, "currency string, rate double")
    return com.convert_currency(o, rates, base_currency="3-MEDIUM", threshold=200000.0)


@q(
    "convert_currency",
    f"""
SELECT o_orderkey, o_custkey, o_orderpriority AS currency, fx.rate AS fx_rate_used,
       {sround('o_totalprice / fx.rate')} AS amount_gbp, o_totalprice / fx.rate > 200000 AS high_value_flag,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'NO_CONVERSION_NEEDED' ELSE 'CONVERTED_TO_GBP' END AS conversion_status
FROM orders JOIN {FX_SQL} ON orders.o_orderpriority = fx.currency
""",
)
def q_convert_currency(spark, sf):
    ok, _ = _convert(spark, sf)
    return ok.select("o_orderkey", "o_custkey", "currency", "fx_rate_used", "amount_gbp", "high_value_flag", "conversion_status")


@q(
    "rejected_currency",
    f"""
SELECT o_orderkey, o_orderpriority AS currency, 'MISSING_FX_RATE' AS conversion_status
FROM orders LEFT JOIN {FX_SQL} ON orders.o_orderpriority = fx.currency WHERE fx.rate IS NULL
""",
)
def q_rejected_currency(spark, sf):
    _, rejected = _convert(spark, sf)
    return rejected.select("o_orderkey", "currency", "conversion_status")


LINES_PER_TASK = 500_000


@q(
    "order_share_of_total",
    f"""
WITH g AS (
  SELECT l_orderkey, l_linenumber, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS line_total FROM lineitem GROUP BY ALL
)
SELECT l_orderkey, l_linenumber, CAST(line_total AS DECIMAL(38,2)) AS line_total,
       CAST(SUM(line_total) OVER (PARTITION BY l_orderkey) AS DECIMAL(38,2)) AS order_total,
       {sround('CAST(line_total AS DOUBLE) / CAST(SUM(line_total) OVER (PARTITION BY l_orderkey) AS DOUBLE)', 4)} AS share
FROM g
""",
)
def q_order_share_of_total(spark, sf):
    li = table(spark, sf, "lineitem")
    # an order's lines are bounded: one exchange by order serves the group-by and the window. Its tasks grow in number
    # with the rows (counted in the files' footers), as all rows of a task are held for both
    tasks = max(default_parallelism(spark), -(-li.count() // LINES_PER_TASK))
    g = li.repartition(tasks, "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.sum(money("l_extendedprice")).alias("line_total"))
    t = g.withColumn("order_total", F.sum("line_total").over(Window.partitionBy("l_orderkey")))
    return t.select(
        "l_orderkey", "l_linenumber", F.col("line_total").cast("decimal(38,2)").alias("line_total"),
        F.col("order_total").cast("decimal(38,2)").alias("order_total"),
        F.round(F.col("line_total").cast("double") / F.col("order_total").cast("double"), 4).alias("share"),
    )


@q(
    "next_order_date",
    """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
       CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) AS next_order_date
FROM orders
""",
)
def q_next_order_date(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    n = neighbour_value(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "next_ts")
    return n.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"),
                    F.to_date("next_ts").alias("next_order_date"))


def _json_lines(spark, sf):
    """Per line: a tax-line JSON array and a properties JSON array built from the line's own columns."""
    return _json_lines_of(table(spark, sf, "lineitem"))


def _json_lines_of(li):
    def entry(title: str, rate: str, agnostic: str):
        price = F.round(F.col("l_extendedprice") * F.col(rate), 4)
        return F.format_string(
            f'{{"title": "{title}", "rate": %s, "rate_percentage": 12.50, "price": "%s", "channel_agnostic": {agnostic}, '
            '"price_set": {"amount":%d,"kind":["a",1.5]}}',
            F.col(rate).cast("string"), price.cast("string"), F.col("l_linenumber"),
        )

    vat, off = entry("GB VAT", "l_tax", "true"), entry("DISCOUNT", "l_discount", "false")
    tax_lines = (
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("["), vat))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit("["), vat, F.lit(', "no object", '), off, F.lit("]")))
        .otherwise(F.concat(F.lit("["), vat, F.lit("]")))
    )
    prop = F.struct(
        F.lit(com.FREE_PRODUCT_PROPERTY[0]).alias("name"),
        F.when(F.col("l_returnflag") == "R", F.lit("product")).otherwise(F.lit("points")).alias("value"),
    )
    props = F.when(F.col("l_returnflag") == "N", F.lit("[]")).otherwise(F.to_json(F.array(prop)))
    return li.select(
        line_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").cast("string").alias("price"),
        tax_lines.alias("tax_lines"), props.alias("properties"),
    )


@q(
    "json_array_explode",
    f"""
WITH e AS (
  SELECT {SQL_LINE_ID} AS order_line_id, l_orderkey AS order_id, l_extendedprice AS amount, l_linenumber,
         unnest(CASE WHEN l_linenumber = 7 THEN [] WHEN l_linestatus = 'O' THEN ['GB VAT', NULL, 'DISCOUNT'] ELSE ['GB VAT'] END) AS title,
         l_tax, l_discount, {sround('l_extendedprice * l_tax', 4)} AS tax, {sround('l_extendedprice * l_discount', 4)} AS off
  FROM lineitem
)
SELECT order_line_id, order_id, title, if(title = 'GB VAT', l_tax, if(title = 'DISCOUNT', l_discount, NULL)) AS rate,
       if(title = 'GB VAT', tax, if(title = 'DISCOUNT', off, NULL)) AS price, if(title IS NULL, NULL, title = 'GB VAT') AS channel_agnostic,
       if(title IS NULL, NULL, 12.5::DOUBLE) AS rate_percentage, if(title IS NULL, NULL, '{{"amount":' || l_linenumber || ',"kind":["a",1.5]}}') AS price_set
FROM e
""",
)
def q_json_array_explode(spark, sf):
    """Every tax line of the lines' JSON arrays; one element of the open lines' arrays is no object, the
    arrays of seventh lines are cut off."""
    return com.explode_tax_lines(_json_lines(spark, sf))


@q(
    "free_product_discount",
    """
WITH d AS (
  SELECT DISTINCT (l_orderkey * 100 + l_linenumber) AS id, l_orderkey AS order_id, -l_extendedprice AS discount
  FROM lineitem WHERE l_returnflag = 'R'
)
SELECT order_id, CAST(SUM(CAST(discount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS discount FROM d GROUP BY order_id
""",
)
def q_free_product_discount(spark, sf):
    d = com.free_product_discount(_json_lines(spark, sf))
    # price travels as JSON-free text here; sum exactly in decimal
    return d.select("order_id", F.col("discount").cast("decimal(38,2)").alias("discount"))


@q(
    "json_scalars",
    """
SELECT event_id, json_extract_string(props, '$.k') AS k_text, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num
FROM events
""",
)
def q_json_scalars(spark, sf):
    e = table(spark, sf, "events")
    k = json_scalar("props", "$.k")
    return e.select("event_id", k.alias("k_text"), k.try_cast("double").alias("k_num"))


@q(
    "local_dates",
    """
SELECT event_id, CAST(timezone('Europe/London', timezone('UTC', ts)) AS DATE) AS local_date, CAST(ts AS DATE) AS utc_date
FROM events
""",
)
def q_local_dates(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", local_date("ts", "Europe/London").alias("local_date"), utc_date("ts").alias("utc_date"))


def title_case_sql(col: str = "p_name") -> str:
    from ledgerlake.functions.text import INITCAP_DELIMITERS

    parts = []
    for ch in INITCAP_DELIMITERS:
        if ord(ch) < 32:  # control characters via chr() to keep them out of the SQL text
            parts.append(f"chr({ord(ch)})")
        elif ch == "'":
            parts.append("chr(39)")
        else:
            parts.append(f"'{ch}'")
    delim_sql = " || ".join(parts)
    s = f"string_split(lower({col}), '')"
    return (
        f"array_to_string(list_transform({s}, lambda x, i: CASE WHEN i = 1 OR strpos({delim_sql}, {s}[i - 1]) > 0 "
        f"THEN upper(x) ELSE x END), '')"
    )


@q("title_case", f"SELECT p_partkey, p_name, {title_case_sql()} AS title FROM part")
def q_title_case(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", "p_name", title_case("p_name").alias("title"))


# --- Full shop ledger (C2 -> C4/C5/C6/C7 -> C8) -------------------------------------------------
LEDGER_SINCE = "1996-01-01"
M2 = "decimal(18,2)"


def _shop_orders(spark, sf):
    """Shop-shaped orders: money as 2-decimal values, test orders = pending low-priority orders."""
    return _shop_orders_of(_orders_with_country(spark, sf), table(spark, sf, "lineitem"))


def _shop_orders_of(o, li):
    price = money("l_extendedprice")
    per = li.groupBy("l_orderkey").agg(
        F.sum(price * F.col("l_tax").cast("decimal(4,2)")).cast(M2).alias("_tax"),
        F.sum(price * F.col("l_discount").cast("decimal(4,2)")).cast(M2).alias("_disc"),
        F.sum(price).cast(M2).alias("_items"),
    )
    j = o.join(per, o.o_orderkey == per.l_orderkey, "left")
    total = money("o_totalprice")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        (F.col("o_custkey") % 7).alias("app_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_custkey").alias("customer__id"),
        F.col("c_name").alias("email"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("cancelled_at"),
        ((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")).alias("test"),
        F.col("o_orderstatus").alias("fulfillment_status"),
        F.col("n_name").alias("billing_address__country"),
        (total - F.coalesce(F.col("_tax"), F.lit(0))).alias("subtotal_price"),
        F.col("_disc").alias("total_discounts"),
        F.col("_disc").alias("current_total_discounts"),
        F.col("_items").alias("total_line_items_price"),
        total.alias("total_price"),
        F.col("_tax").alias("total_tax"),
        F.col("_tax").alias("current_total_tax"),
        F.lit(None).cast("string").alias("original_total_duties_set__shop_money__amount"),
    )


def shop_ledger(spark, sf):
    """The chain C2 -> C5 -> (C6, C8): cleaned orders and line facts are stages of their own, written once
    and read by the refund ledger, the first orders and the order metrics."""
    from ledgerlake.plans.customer import first_orders

    li = table(spark, sf, "lineitem")
    orders = staged(com.clean_orders(_shop_orders(spark, sf), zone="UTC"), scratch(spark, "orders"))
    first = first_orders(orders, columns=["id"]).select(F.col("id").alias("order_id"))
    return _ledger_of(spark, sf, orders, table(spark, sf, "orders"), li, li.where(F.col("l_returnflag") == "R"), first, scratch(spark, "line_facts"))


def _ledger_of(spark, sf, orders, placed, li, returned, first, stage):
    """Ledger rows of cleaned ``orders``, ``placed`` as they landed, their lines and refunded lines."""
    lines, refund_lines, tax_lines = _line_frames_of(li, returned)
    products = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("handle"), F.col("p_type").alias("product_type"),
        F.col("p_brand").alias("vendor"),
    )
    facts = com.order_line_facts(lines, orders, products, refund_lines, tax_lines, home=HOME, with_order_total=False)
    # Only what the order and refund measures read of the line facts is written.
    line_facts = staged(facts.select("order_id", "order_line_id", "rate", "gross_sales", "quantity"), stage)
    shipping = li.where(F.col("l_returnflag") == "A").select(
        F.col("l_orderkey").alias("order_id"),
        (money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast(M2).alias("price"),
    )
    fpd = com.free_product_discount(_json_lines_of(li))
    order_days = com.order_day_metrics(orders, shipping, line_facts, fpd, first, since=LEDGER_SINCE)
    back = com.refund_ledger(*_refund_inputs_of(returned, placed), line_facts, zone="UTC", num=D4)
    ledger = com.order_metrics_ledger(order_days, back, calendar={"start": CAL_START, "years": CAL_YEARS})
    money_cols = [
        "tax", "shipping_cost", "duties", "discount", "returns", "total_sales", "total_sales_plus_returns",
        "gross_sales", "order_line_agg_gross_sales", "net_sales", "net_sales_plus_returns", "sales",
    ]
    return ledger.select(
        "fulldate", "order_id", "order_name", "orders_order_id", "app_id", "return_order_id", "refund_date", "user_id",
        "orders_email", "customer_id", "order_type", "billing_order_country", "number_of_orders", "quantity",
        "refund_order_count", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in money_cols],  # 4 places: amounts fall between cents
        "retail_year", "retail_week", "retail_month", "retail_week_label",
    )


def _shop_ledger_sql() -> str:
    money_out = [
        "tax", "shipping_cost", "duties", "discount", "returns", "total_sales", "total_sales_plus_returns",
        "gross_sales", "order_line_agg_gross_sales", "net_sales", "net_sales_plus_returns", "sales",
    ]
    months = ", ".join(f"({i + 1}, {w})" for i, w in enumerate((0, 4, 8, 13, 17, 21, 26, 30, 34, 39, 43, 47)))  # 4-4-5 quarters, first week of each month
    return f"""
WITH {LINES_SQL},
shop AS (
  SELECT o_orderkey AS id, o_orderdate::DATE AS day, o_orderdate AS placed, o_custkey AS cid, c_name AS email, o_totalprice::DECIMAL(18,2)::DOUBLE AS price
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
),
same_id AS (SELECT order_line_id AS id, count(*) AS times, sum(quantity) AS pieces FROM line_facts JOIN shop ON shop.id = order_id GROUP BY 1),
{REFUND_SQL}, month(nr, from_week) AS (VALUES {months}),
first_of AS (SELECT arg_min(id, (placed, id)) AS id FROM shop GROUP BY lower(email)),
sums AS (
  SELECT l_orderkey AS id, sum(l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(4,2))::DECIMAL(18,2)::DOUBLE AS tax,
         sum(l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DECIMAL(18,2)::DOUBLE AS off,
         list((l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2))::DECIMAL(18,2)::DOUBLE) FILTER (l_returnflag = 'A') AS shipping
  FROM lineitem GROUP BY 1
),
gifts AS (SELECT order_id AS id, -sum(value) AS value FROM (SELECT DISTINCT order_id, order_line_id, value FROM line WHERE is_back) GROUP BY 1),
facts AS (SELECT order_id AS id, coalesce(max(rate), 0) AS rate, sum(gross_sales) AS gross, sum(quantity) AS pieces FROM line_facts JOIN shop ON shop.id = order_id GROUP BY 1),
parcel AS (  -- an order stands once per shipping line, or once without any
  SELECT id, unnest(coalesce(shipping, [NULL])) AS ship FROM shop LEFT JOIN sums USING (id) WHERE day >= DATE '{LEDGER_SINCE}'
),
order_day AS (
  SELECT day AS order_date, id AS order_id, '#' || id AS order_name, cid % 7 AS app_id, cid AS user_id, email, cid AS customer_id,
         if(first_of.id IS NULL, 'Returning', 'New') AS order_type, place.billing_order_country, count(*) AS number_of_orders,
         sum(pieces) AS quantity, sum(tax) AS total_tax,
         sum((-coalesce(off, 0) - coalesce(gifts.value, 0)) / (1 + coalesce(rate, 0))) + coalesce(sum(gifts.value), 0) AS discount,
         sum(ship / (1 + coalesce(rate, 0))) AS shipping, sum(price) AS total_price, sum(gross) AS line_gross
  FROM parcel JOIN shop USING (id) LEFT JOIN sums USING (id) LEFT JOIN facts USING (id) LEFT JOIN gifts USING (id)
  LEFT JOIN place ON place.order_id = id LEFT JOIN first_of USING (id)
  GROUP BY ALL
),
{LEDGER_SQL}
SELECT fulldate, order_id, order_name, orders_order_id, app_id, return_order_id, refund_date, user_id,
       sha256(regexp_replace(lower(email), '^\\s+|\\s+$', '', 'g')) AS orders_email, customer_id, order_type, billing_order_country,
       number_of_orders, quantity, refund_order_count, {", ".join(f"{sround(c, 4)} AS {c}" for c in money_out)}, retail_year, retail_week,
       (SELECT max(nr) FROM month WHERE from_week < retail_week)::INTEGER AS retail_month,
       printf('%04d-Wk%02d', retail_year, retail_week) AS retail_week_label
FROM ledger
"""


q("shop_ledger", _shop_ledger_sql())(shop_ledger)


def ledger_rules(spark, sf, **more):
    """The ledger chain on landed orders, lines and refunded lines (``LedgerRules``)."""

    def cleaned(t):
        return com.clean_orders(_shop_orders_of(t["orders"], t["lines"]), zone="UTC")

    stages = []

    def chain(t, first):
        stages.append(scratch(spark, "line_facts"))
        return _ledger_of(spark, sf, cleaned(t), t["orders"], t["lines"], t["refunds"], first, stages[-1])

    def chain_done():
        while stages:
            drop_path(spark, stages.pop())

    keys = {"orders": "o_orderkey", "lines": "l_orderkey", "refunds": "l_orderkey"}
    return LedgerRules(keys, lambda t: cleaned(t).select("id", "email", "created_at"), chain, chain_done=chain_done, **more)


LEDGER_CUT = "1997-07-01"


def landings(spark, sf):
    """Landed rows with the number of the run that brings them: a base load, then new orders, then late
    refunds, then corrections (a moved order day, a changed e-mail, a test order that is none)."""
    o = _orders_with_country(spark, sf).select(*table(spark, sf, "orders").columns, "c_name", "n_name")
    li = table(spark, sf, "lineitem")
    key = F.col("o_orderkey")
    old = F.col("o_orderdate") < F.lit(LEDGER_CUT).cast("timestamp_ntz")
    wrong_day, wrong_name, wrong_test = old & (key % 11 == 0), old & (key % 13 == 0), old & (key % 17 == 0)
    first = o.withColumns(
        {
            "o_orderdate": F.when(wrong_day, F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("o_orderdate")),
            "c_name": F.when(wrong_name, F.concat("c_name", F.lit("?"))).otherwise(F.col("c_name")),
            "o_orderpriority": F.when(wrong_test, F.lit("5-LOW")).otherwise(F.col("o_orderpriority")),
            "o_orderstatus": F.when(wrong_test, F.lit("P")).otherwise(F.col("o_orderstatus")),
            "landed": F.when(old, F.lit(0)).otherwise(F.lit(1)),
        }
    )
    orders = first.unionByName(o.where(wrong_day | wrong_name | wrong_test).withColumn("landed", F.lit(3)))
    when = o.select(key.alias("_key"), old.alias("_old"))
    lines = li.join(when, li.l_orderkey == when._key, "left").withColumn("_run", F.when(F.col("_old"), 0).otherwise(1)).drop("_key", "_old")
    late = F.when((F.col("_run") == 0) & (F.col("l_orderkey") % 7 == 0), F.lit(2)).otherwise(F.col("_run"))
    return {
        "orders": orders,
        "lines": lines.withColumnRenamed("_run", "landed"),
        "refunds": lines.where(F.col("l_returnflag") == "R").withColumn("landed", late).drop("_run"),
    }


@q("shop_ledger_incremental", _shop_ledger_sql())
def q_shop_ledger_incremental(spark, sf):
    """The shop ledger after a base load and three slices, each recomputing the orders it touches only."""
    root, rules, landed, seen = scratch(spark, "ledger"), ledger_rules(spark, sf, orders_per_part=1 << 14, email_buckets=8), landings(spark, sf), None
    landed = {name: staged(rows, f"{root}/source/{name}") for name, rows in landed.items()}
    for run in range(4):
        new = {name: incremental_slice(rows, "landed", seen).where(F.col("landed") <= run).drop("landed") for name, rows in landed.items()}
        if run:  # only tables something landed for
            new = {name: rows for name, rows in new.items() if not rows.isEmpty()}
        ledger = refresh_ledger(spark, root, f"{root}/runs/{run}", new, rules)
        seen = run + 1
    drop_path(spark, f"{root}/source")
    return ledger.drop("ledger_month")


def shop_ledger_rows_sql() -> str:
    """CTE ``ledger_ids``: order_id and orders_order_id of the ledger's rows. An order day has its
    order; a refund day of the same order on another day, or of an order that is a test or older
    than the ledger, stands alone."""
    return f"""
placed_in_ledger AS (
  SELECT o_orderkey AS id, o_orderdate::DATE AS day FROM orders
  WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') AND o_orderdate >= DATE '{LEDGER_SINCE}'
),
refunded AS (SELECT DISTINCT l_orderkey AS id, l_shipdate::DATE AS day FROM lineitem WHERE l_returnflag = 'R'),
ledger_ids AS (
  SELECT id AS order_id, id AS orders_order_id FROM placed_in_ledger
  UNION ALL SELECT id, NULL FROM refunded ANTI JOIN placed_in_ledger USING (id, day)
)"""


@q(
    "bucketed_stages",
    f"""
WITH line AS (SELECT l_orderkey AS order_id, count(*) AS n_lines, sum(l_quantity) AS pieces, sum(l_extendedprice::DECIMAL(18,2)) AS value FROM lineitem GROUP BY 1),
back AS (SELECT l_orderkey AS order_id, sum(l_extendedprice::DECIMAL(18,2)) AS refunded FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_orderkey AS order_id, o_orderdate::DATE AS order_date, n_lines, pieces, value::DECIMAL(28,2) AS value, refunded::DECIMAL(28,2) AS refunded
FROM orders LEFT JOIN line ON line.order_id = o_orderkey LEFT JOIN back ON back.order_id = o_orderkey
""",
)
def q_bucketed_stages(spark, sf):
    """Orders, lines and refunds as stage tables bucketed by order id: summed by order and joined without a shuffle."""
    return _by_order(spark, _bucketed(spark, sf))


def _bucketed(spark, sf, buckets=8):
    run = scratch(spark, "bucketed")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_quantity", money("l_extendedprice").alias("value"), "l_returnflag")
    frames = {
        "orders": table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date")),
        "lines": li.drop("l_returnflag"),
        "refunds": li.where("l_returnflag = 'R'").select("order_id", "value"),
    }
    tag = run.rsplit("-", 1)[1]
    return {name: staged_by_key(df, f"stage_{name}_{tag}", f"{run}/{name}", "order_id", buckets) for name, df in frames.items()}


def _by_order(spark, stages):
    lines = stages["lines"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("pieces"), F.sum("value").cast("decimal(28,2)").alias("value"))
    back = stages["refunds"].groupBy("order_id").agg(F.sum("value").cast("decimal(28,2)").alias("refunded"))
    return stages["orders"].join(lines.hint("merge"), "order_id", "left").join(back.hint("merge"), "order_id", "left")
