"""Advertising jobs on the TPC-style tables.

Hierarchy: ad = supplier, ad set = nation, campaign = region. Multi-grain
report: campaign rows = orders (account ``o_custkey % 10``, campaign
``o_custkey``, device ``o_orderpriority``), ad-group rows = non-'N' line items of
the order, keyword rows = returned ('R') line items. Status recode: event types.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.plans import ads
from ledgerlake.session import default_parallelism
from ledgerlake.testbed.base import CAL_START, CAL_YEARS, registry, table

QUERIES, ORACLE, q = registry()


def sround(expr: str, k: int = 2) -> str:
    return f"CAST(ROUND(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


@q(
    "dimension_hierarchy",
    """
SELECT s.s_suppkey AS ad_id, s.s_name AS ad_name, 'ACTIVE' AS ad_status, n.n_regionkey AS campaign_id,
       s.s_nationkey AS ad_set_id, n2.n_name AS ad_set_name, 'LIVE' AS ad_set_status,
       r.r_name AS campaign_name, 'REACH' AS campaign_objective, 'ENABLED' AS campaign_status
FROM supplier s
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN nation n2 ON n2.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""",
)
def q_dimension_hierarchy(spark, sf):
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    ad_rows = s.join(n.select("n_nationkey", "n_regionkey"), s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("ACTIVE").alias("status"),
        F.col("n_regionkey").alias("campaign_id"), F.col("s_nationkey").alias("adset_id"),
        F.col("s_acctbal").alias("updated_time"),
    )
    adsets = n.select(
        F.col("n_nationkey").alias("id"), F.lit(0).alias("account_id"), F.col("n_name").alias("name"),
        F.lit("LIVE").alias("status"), F.col("n_regionkey").alias("campaign_id"), F.lit(1).alias("updated_time"),
    )
    campaigns = r.select(
        F.col("r_regionkey").alias("id"), F.lit(0).alias("account_id"), F.col("r_name").alias("name"),
        F.lit("REACH").alias("objective"), F.lit("ENABLED").alias("status"), F.lit(1).alias("updated_time"),
    )
    return ads.ad_hierarchy(ad_rows, adsets, campaigns)


@q(
    "union_history",
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier
""",
)
def q_union_history(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
        F.lit("customer").alias("source"),
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("source"),
    )
    return ads.union_history([c, s], ["id", "name", "acctbal", "source"])


STATUS_STANDIN = {"ENABLED": "ACTIVE", "PAUSED": "PAUSED", "CLICK": "ENGAGED", "VIEW": "ENGAGED"}


@q(
    "status_remap_reagg",
    f"""
WITH first AS (
  SELECT CAST(ts AS DATE) AS day, user_id, event_type, SUM(value) AS value, COUNT(*) AS events
  FROM events GROUP BY ALL
)
SELECT day, CASE WHEN upper(event_type) = 'ENABLED' THEN 'ACTIVE' WHEN upper(event_type) = 'PAUSED' THEN 'PAUSED'
                 WHEN upper(event_type) = 'CLICK' THEN 'ENGAGED' WHEN upper(event_type) = 'VIEW' THEN 'ENGAGED'
                 ELSE event_type END AS event_type,
       {sround('SUM(value)')} AS value, SUM(events) AS events
FROM first GROUP BY ALL
""",
)
def q_status_remap_reagg(spark, sf):
    e = table(spark, sf, "events")
    first = e.groupBy(F.to_date("ts").alias("day"), "user_id", "event_type").agg(
        F.sum("value").alias("value"), F.count(F.lit(1)).alias("events")
    )
    out = ads.remap_and_reaggregate(first, ["day"], "event_type", ["value", "events"], STATUS_STANDIN)
    return out.select("day", "event_type", F.round("value", 2).alias("value"), "events")


def _grain_frames(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    campaign_stats = o.select(
        F.to_date("o_orderdate").alias("segments__date"), (F.col("o_custkey") % 10).alias("customer__id"),
        F.col("o_custkey").alias("campaign__id"), F.col("o_orderpriority").alias("segments__device"),
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 10000).alias("metrics__cost_micros"),
        F.lit(1).cast("bigint").alias("metrics__impressions"), (F.col("o_orderkey") % 3).alias("metrics__clicks"),
        F.lit(1.0).alias("metrics__conversions"), F.col("o_totalprice").alias("metrics__conversions_value"),
    )
    lo = li.join(o.select("o_orderkey", "o_orderdate", "o_custkey"), li.l_orderkey == o.o_orderkey, "inner")
    line_stats = lo.select(
        F.to_date("o_orderdate").alias("segments__date"), (F.col("o_custkey") % 10).alias("customer__id"),
        F.col("o_custkey").alias("campaign__id"), F.col("l_suppkey").alias("ad_group__id"),
        F.col("l_partkey").alias("ad_group_criterion__criterion_id"), F.col("l_returnflag").alias("_flag"),
        (F.round(F.col("l_extendedprice") * 100).cast("bigint") * 10000).alias("metrics__cost_micros"),
        F.col("l_quantity").cast("bigint").alias("metrics__impressions"),
        F.col("l_linenumber").cast("bigint").alias("metrics__clicks"),
        F.col("l_quantity").alias("metrics__conversions"), F.col("l_extendedprice").alias("metrics__conversions_value"),
    )
    ad_group_stats = line_stats.where(F.col("_flag") != "N")
    keyword_stats = line_stats.where(F.col("_flag") == "R")
    history = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 10).alias("customer__id"), F.col("c_custkey").alias("campaign__id"),
        F.col("c_name").alias("campaign__name"), F.col("c_mktsegment").alias("campaign__status"),
        F.lit("SEARCH").alias("campaign__advertising_channel_type"),
        F.col("c_acctbal").alias("_sdc_extracted_at"),
    )
    return campaign_stats, history, ad_group_stats, keyword_stats


@q(
    "finest_grain_fallback",
    f"""
WITH spent AS (  -- lines by campaign day at both finer grains: returned lines are keywords, all but open ones ad groups
  SELECT o_orderdate::DATE AS day, o_custkey AS camp, unnest(if(l_returnflag = 'R', ['keyword', 'ad_group'], ['ad_group'])) AS level,
         l_suppkey AS ad_group, l_suppkey || '-' || l_partkey AS keyword, l_quantity AS n, l_linenumber AS clicks, l_extendedprice AS value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'N'
),
grain AS (
  SELECT day, camp, level, {{'impressions': sum(n::BIGINT), 'clicks': sum(clicks::BIGINT), 'conversions': sum(n), 'value': sum(value),
         'n': if(level = 'keyword', count(DISTINCT keyword), count(DISTINCT ad_group))}} AS m
  FROM spent GROUP BY day, camp, level
),
grains AS (SELECT day, camp, any_value(m) FILTER (level = 'keyword') AS kw, any_value(m) FILTER (level = 'ad_group') AS ag FROM grain GROUP BY day, camp),
own AS (
  SELECT o_orderdate::DATE AS fulldate, o_custkey AS campaign_id, o_orderpriority AS device, round(o_totalprice * 100) / 100 AS cost,
         {{'impressions': 1::BIGINT, 'clicks': o_orderkey % 3, 'conversions': 1.0::DOUBLE, 'value': o_totalprice, 'n': 0::BIGINT}} AS m
  FROM orders
)
SELECT fulldate, campaign_id % 10 AS account_id, campaign_id, c_name AS campaign_name, c_mktsegment AS latest_status,
       if(c_custkey IS NULL, NULL, 'SEARCH') AS advertising_channel_type, device, {sround('cost')} AS cost,
       best.impressions, best.clicks, best.conversions, {sround('best.value')} AS conversions_value,
       if(kw IS NOT NULL, 'keyword', if(ag IS NOT NULL, 'ad_group', 'campaign')) AS metrics_level,
       coalesce(ag.n, 0) AS ad_group_count, coalesce(kw.n, 0) AS keyword_count,
       (1995 + date_diff('day', DATE '1995-01-01', fulldate) // 7 // 52)::INTEGER AS retail_year,
       (1 + date_diff('day', DATE '1995-01-01', fulldate) // 7 % 52)::INTEGER AS retail_week
FROM (SELECT own.*, kw, ag, coalesce(kw, ag, own.m) AS best FROM own LEFT JOIN grains ON day = fulldate AND camp = campaign_id)
LEFT JOIN customer ON c_custkey = campaign_id
""",
)
def q_finest_grain_fallback(spark, sf):
    rep = ads.campaign_report(*_grain_frames(spark, sf), calendar={"start": CAL_START, "years": CAL_YEARS})
    return rep.select(
        "fulldate", "account_id", "campaign_id", "campaign_name", "latest_status", "advertising_channel_type", "device",
        F.round("cost", 2).alias("cost"), "impressions", "clicks", "conversions",
        F.round("conversions_value", 2).alias("conversions_value"), "metrics_level", "ad_group_count", "keyword_count",
        "retail_year", "retail_week",
    )


def _report_frames(spark, sf):
    """Ad-group / keyword stats from line items; histories from customer, supplier, part, nation."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_orderpriority")
    li = table(spark, sf, "lineitem")
    lo = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    stats = lo.select(
        F.to_date("o_orderdate").alias("segments__date"), (F.col("o_custkey") % 10).alias("customer__id"),
        F.col("o_custkey").alias("campaign__id"), F.col("l_suppkey").alias("ad_group__id"),
        F.col("l_partkey").alias("ad_group_criterion__criterion_id"), F.col("o_orderpriority").alias("segments__device"),
        F.col("l_returnflag").alias("_flag"),
        (F.round(F.col("l_extendedprice") * 100).cast("bigint") * 10000).alias("metrics__cost_micros"),
        F.col("l_quantity").cast("bigint").alias("metrics__impressions"),
        F.col("l_linenumber").cast("bigint").alias("metrics__clicks"),
        F.col("l_quantity").alias("metrics__conversions"), F.col("l_extendedprice").alias("metrics__conversions_value"),
    )
    seg = F.col("c_mktsegment")
    campaigns = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("campaign__id"), F.col("c_name").alias("campaign__name"),
        F.when(seg == "BUILDING", F.lit("enabled")).when(seg == "MACHINERY", F.lit("Paused")).otherwise(seg).alias("campaign__status"),
        F.lit("SEARCH").alias("campaign__advertising_channel_type"), F.col("c_acctbal").alias("_sdc_extracted_at"),
    )
    adgroups = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("ad_group__id"), F.col("s_name").alias("ad_group__name"), F.col("s_acctbal").alias("_sdc_extracted_at")
    )
    accounts = table(spark, sf, "nation").select(
        (F.col("n_nationkey") % 10).alias("customer__id"), F.col("n_name").alias("customer__descriptive_name"),
        F.lit("GBP").alias("customer__currency_code"), F.col("n_nationkey").alias("_sdc_extracted_at"),
    )
    criteria = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ad_group_criterion__criterion_id"), F.col("p_name").alias("ad_group_criterion__keyword__text"),
        F.col("p_brand").alias("ad_group_criterion__keyword__match_type"), F.col("p_type").alias("ad_group_criterion__age_range__type"),
        F.col("p_size").cast("string").alias("ad_group_criterion__gender__type"),
        F.lit(None).cast("string").alias("ad_group_criterion__income_range__type"), F.col("p_retailprice").alias("_sdc_extracted_at"),
    )
    return stats, campaigns, adgroups, accounts, criteria


SINCE = "1998-01-01"
# Lines with their campaign, ad group and account; statuses are recoded per row (the second aggregation of
# the job gives the same sums). An account number stands for several nations: the one with the greatest key names it.
RECODE_SQL = "recode(segment, label) AS (VALUES ('BUILDING', 'ACTIVE'), ('MACHINERY', 'PAUSED'))"
SPENT_SQL = f"""{RECODE_SQL},
account AS (SELECT n_nationkey % 10 AS nr, arg_max(n_name, n_nationkey) AS title FROM nation GROUP BY 1),
spent AS (
  SELECT o_orderdate::DATE AS fulldate, account.nr AS account_id, account.title AS descriptive_name, l_suppkey AS adgroup_id, s_name AS adgroup_name,
         c_custkey AS campaign_id, c_name AS campaign_name, coalesce(label, c_mktsegment) AS latest_status, o_orderpriority AS device,
         if(c_custkey IS NULL, NULL, 'SEARCH') AS advertising_channel_type, l_partkey, l_returnflag,
         l_quantity, l_linenumber, round(l_extendedprice * 100) / 100 AS price, l_extendedprice AS value
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN (customer LEFT JOIN recode ON segment = c_mktsegment) ON c_custkey = o_custkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN account ON account.nr = o_custkey % 10
  WHERE o_orderdate >= DATE '{SINCE}'
)"""
MEASURES_SQL = f"""sum(l_quantity::BIGINT) AS impressions, sum(l_linenumber::BIGINT) AS clicks, {sround('sum(price)')} AS cost,
       sum(l_quantity) AS conversions, {sround('sum(value)')} AS conversions_value"""


@q(
    "adgroup_report",
    f"""
WITH {SPENT_SQL}
SELECT fulldate, account_id, descriptive_name, adgroup_id, adgroup_name, campaign_id, campaign_name, latest_status, device,
       advertising_channel_type, {MEASURES_SQL}
FROM spent GROUP BY ALL
""",
)
def q_adgroup_report(spark, sf):
    stats, campaigns, adgroups, accounts, _ = _report_frames(spark, sf)
    rep = ads.adgroup_report(stats, campaigns, adgroups, accounts, since=SINCE)
    return rep.withColumns({"cost": F.round("cost", 2), "conversions_value": F.round("conversions_value", 2)})


def _keyword_sql() -> str:
    from ledgerlake.testbed.commerce import title_case_sql

    return f"""
WITH {SPENT_SQL}
SELECT fulldate, account_id, descriptive_name, l_partkey AS criterion_id, {title_case_sql('p_name')} AS keyword_text, p_brand AS keyword_match_type,
       p_type AS age_range_type, p_size::VARCHAR AS gender_type, NULL::VARCHAR AS income_range_type, campaign_id, campaign_name, latest_status,
       adgroup_id, {title_case_sql('adgroup_name')} AS adgroup_name, device, advertising_channel_type, {MEASURES_SQL}
FROM spent LEFT JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY ALL
"""


LINES_PER_TASK = 500_000


@q("keyword_report", _keyword_sql())
def q_keyword_report(spark, sf):
    stats, campaigns, adgroups, accounts, criteria = _report_frames(spark, sf)
    tasks = max(default_parallelism(spark), -(-table(spark, sf, "lineitem").count() // LINES_PER_TASK))  # counted in the files' footers
    rep = ads.keyword_report(stats.where(F.col("_flag") == "R"), campaigns, criteria, adgroups, accounts, since=SINCE, tasks=tasks)
    return rep.withColumns({"cost": F.round("cost", 2), "conversions_value": F.round("conversions_value", 2)})
