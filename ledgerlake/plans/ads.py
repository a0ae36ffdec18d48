"""Advertising hierarchies and multi-grain reports.

History tables are reduced to their latest row per id with ``latest_per_key``
(partial-aggregated ``max_by``) before any join, so each dimension side is one
row per id; the fact side is joined to them with ordinary equi-joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import title_case
from ledgerlake.functions._util import as_col
from ledgerlake.operators.keyed import latest_per_key
from ledgerlake.operators.setops import union_all
from ledgerlake.plans.calendar import calendar_columns

# Status recoding of the reference's ad reports (upper-cased match).
STATUS_MAP = {"ENABLED": "ACTIVE", "PAUSED": "PAUSED"}
MICROS = 1_000_000.0
METRICS = {
    "impressions": "metrics__impressions",
    "clicks": "metrics__clicks",
    "cost_micros": "metrics__cost_micros",
    "conversions": "metrics__conversions",
    "conversions_value": "metrics__conversions_value",
}


CAMPAIGN_COLUMNS = ("campaign__name", "campaign__status", "campaign__advertising_channel_type")
CRITERION_COLUMNS = tuple(
    f"ad_group_criterion__{c}" for c in ("keyword__text", "keyword__match_type", "age_range__type", "gender__type", "income_range__type")
)


def remap_status(c: Column | str, mapping: Mapping[str, str] = STATUS_MAP) -> Column:
    """Upper-cased value found in ``mapping`` -> its label; anything else passes through raw."""
    x = as_col(c)
    expr = None
    for src, dst in mapping.items():
        cond = F.upper(x) == F.lit(src)
        expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
    return expr.otherwise(x) if expr is not None else x


def latest_history(df: DataFrame, keys: Sequence[str], columns: Sequence[str], extracted_at: str = "_sdc_extracted_at") -> DataFrame:
    """Current row of a change-log table: newest ``extracted_at`` per key, with ``columns`` only.

    Histories that were extracted together share their stamp, so ties go to the
    greatest ``columns``; the pick does not depend on the order of the input.
    """
    return latest_per_key(df, keys, [extracted_at, *columns], columns=columns)


def remap_and_reaggregate(
    df: DataFrame,
    keys: Sequence[str],
    status: str,
    measures: Sequence[str],
    mapping: Mapping[str, str] = STATUS_MAP,
) -> DataFrame:
    """Second aggregation level: recode ``status`` and sum ``measures`` again, merging groups
    whose statuses map to the same label."""
    recoded = df.withColumn(status, remap_status(status, mapping))
    return recoded.groupBy(*keys, status).agg(*[F.sum(m).alias(m) for m in measures])


# --- C16 ------------------------------------------------------------------------------------
def ad_hierarchy(ads: DataFrame, adsets: DataFrame, campaigns: DataFrame, updated: str = "updated_time") -> DataFrame:
    """Latest ad joined to its latest ad set and campaign (grain: ad)."""
    c = latest_history(campaigns, ["id"], ["name", "objective", "status"], updated)
    s = latest_history(adsets, ["id"], ["name", "status"], updated)
    a = latest_history(ads.withColumnRenamed("adset_id", "ad_set_id"), ["id"], ["name", "status", "campaign_id", "ad_set_id"], updated)
    s = s.select(F.col("id").alias("_s_id"), F.col("name").alias("ad_set_name"), F.col("status").alias("ad_set_status"))
    c = c.select(
        F.col("id").alias("_c_id"), F.col("name").alias("campaign_name"),
        F.col("objective").alias("campaign_objective"), F.col("status").alias("campaign_status"),
    )
    return (
        a.join(s, a.ad_set_id == s._s_id, "left")
        .join(c, a.campaign_id == c._c_id, "left")
        .select(
            F.col("id").alias("ad_id"), F.col("name").alias("ad_name"), F.col("status").alias("ad_status"),
            "campaign_id", "ad_set_id", "ad_set_name", "ad_set_status", "campaign_name", "campaign_objective", "campaign_status",
        )
    )


# --- C17 ------------------------------------------------------------------------------------
def union_history(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Segmented and unsegmented history as one table (``UNION ALL`` on the listed columns)."""
    return union_all([f.select(*columns) for f in frames])


# --- C18 / C19 ------------------------------------------------------------------------------
def _stats_measures() -> list[Column]:
    return [
        F.sum(METRICS["impressions"]).alias("impressions"),
        F.sum(METRICS["clicks"]).alias("clicks"),
        F.sum(F.col(METRICS["cost_micros"]) / F.lit(MICROS)).alias("cost"),
        F.sum(METRICS["conversions"]).alias("conversions"),
        F.sum(METRICS["conversions_value"]).alias("conversions_value"),
    ]


MEASURES = ["impressions", "clicks", "cost", "conversions", "conversions_value"]


def adgroup_report(
    stats: DataFrame,
    campaign_history: DataFrame,
    adgroup_history: DataFrame,
    accounts: DataFrame,
    since: str | None = "2022-01-01",
) -> DataFrame:
    """Date x account x ad group x campaign x status x device x channel metrics."""
    camp = latest_history(campaign_history, ["campaign__id"], CAMPAIGN_COLUMNS).select(
        F.col("campaign__id").alias("_c_id"), F.col("campaign__name").alias("campaign_name"),
        F.col("campaign__status").alias("latest_status"),
        F.col("campaign__advertising_channel_type").alias("advertising_channel_type"),
    )
    adg = latest_history(adgroup_history, ["ad_group__id"], ["ad_group__name"]).select(
        F.col("ad_group__id").alias("_g_id"), F.col("ad_group__name").alias("adgroup_name")
    )
    acct = latest_history(accounts, ["customer__id"], ["customer__descriptive_name", "customer__currency_code"]).select(
        F.col("customer__id").alias("account_id"), F.col("customer__descriptive_name").alias("descriptive_name"),
        F.col("customer__currency_code").alias("currency_code"),
    )
    s = stats if since is None else stats.where(F.col("segments__date") >= F.lit(since).cast("date"))
    j = (
        s.join(camp, s.campaign__id == camp._c_id, "left")
        .join(adg, s.ad_group__id == adg._g_id, "left")
        .join(acct, s.customer__id == acct.account_id, "left")
    )
    keys = [
        F.col("segments__date").alias("fulldate"), "account_id", "descriptive_name", "currency_code",
        F.col("ad_group__id").alias("adgroup_id"), "adgroup_name", F.col("_c_id").alias("campaign_id"),
        "campaign_name", "latest_status", F.col("segments__device").alias("device"), "advertising_channel_type",
    ]
    first = j.groupBy(*keys).agg(*_stats_measures())
    return remap_and_reaggregate(
        first,
        ["fulldate", "account_id", "descriptive_name", "adgroup_id", "adgroup_name", "campaign_id", "campaign_name",
         "device", "advertising_channel_type"],
        "latest_status",
        MEASURES,
    )


def keyword_report(
    stats: DataFrame,
    campaign_history: DataFrame,
    criteria_history: DataFrame,
    adgroup_history: DataFrame,
    accounts: DataFrame,
    since: str | None = "2022-01-01",
    tasks: int | None = None,
) -> DataFrame:
    """Date x keyword x ad group x campaign x status x device metrics, names title-cased.

    The keywords are joined last: their texts are the widest columns, and with the rows dealt by
    criterion both aggregations follow without another shuffle. ``tasks`` is how many the rows are dealt
    over (default: the planner's choice); a task holds its groups for each of the aggregations, so
    with many rows it should grow with them.
    """
    crit_id = "ad_group_criterion__criterion_id"
    kw = latest_history(criteria_history, [crit_id], CRITERION_COLUMNS).select(
        F.col(crit_id).alias("_k_id"),
        F.col("ad_group_criterion__keyword__text").alias("keyword_text"),
        F.col("ad_group_criterion__keyword__match_type").alias("keyword_match_type"),
        F.col("ad_group_criterion__age_range__type").alias("age_range_type"),
        F.col("ad_group_criterion__gender__type").alias("gender_type"),
        F.col("ad_group_criterion__income_range__type").alias("income_range_type"),
    )
    camp = latest_history(campaign_history, ["campaign__id"], CAMPAIGN_COLUMNS).select(
        F.col("campaign__id").alias("_c_id"), F.col("campaign__name").alias("campaign_name"),
        F.col("campaign__status").alias("latest_status"),
        F.col("campaign__advertising_channel_type").alias("advertising_channel_type"),
    )
    adg = latest_history(adgroup_history, ["ad_group__id"], ["ad_group__name"]).select(
        F.col("ad_group__id").alias("_g_id"), F.col("ad_group__name").alias("adgroup_name")
    )
    acct = latest_history(accounts, ["customer__id"], ["customer__descriptive_name"]).select(
        F.col("customer__id").alias("account_id"), F.col("customer__descriptive_name").alias("descriptive_name"),
    )
    s = stats if since is None else stats.where(F.col("segments__date") >= F.lit(since).cast("date"))
    j = (
        s.join(camp, s.campaign__id == camp._c_id, "left")
        .join(adg, s.ad_group__id == adg._g_id, "left")
        .join(acct, s.customer__id == acct.account_id, "left")
    )
    j = (j.repartition(tasks, crit_id) if tasks else j).join(kw, F.col(crit_id) == kw._k_id, "left")
    keys = [
        F.col("segments__date").alias("fulldate"), "account_id", "descriptive_name", F.col(crit_id).alias("criterion_id"),
        "keyword_text", "keyword_match_type", "age_range_type", "gender_type", "income_range_type",
        F.col("_c_id").alias("campaign_id"), "campaign_name", "latest_status",
        F.col("ad_group__id").alias("adgroup_id"), "adgroup_name", F.col("segments__device").alias("device"),
        "advertising_channel_type",
    ]
    first = j.groupBy(*keys).agg(*_stats_measures())
    first = first.withColumns({"keyword_text": title_case("keyword_text"), "adgroup_name": title_case("adgroup_name")})
    dims = [
        "fulldate", "account_id", "descriptive_name", "criterion_id", "keyword_text", "keyword_match_type",
        "age_range_type", "gender_type", "income_range_type", "campaign_id", "campaign_name", "adgroup_id",
        "adgroup_name", "device", "advertising_channel_type",
    ]
    return remap_and_reaggregate(first, dims, "latest_status", MEASURES)


# --- C20 / C21 ------------------------------------------------------------------------------
def campaign_report(
    campaign_stats: DataFrame,
    campaign_history: DataFrame,
    ad_group_stats: DataFrame,
    keyword_stats: DataFrame,
    calendar: Mapping | None = None,
) -> DataFrame:
    """Campaign x device rows with metrics from the finest grain available (C20).

    Keyword totals, else ad-group totals, else the campaign row's own metrics,
    with a ``metrics_level`` tag. Finer grains are aggregated to (date, account,
    campaign) before the join, so the join sides are pre-reduced. Like the
    reference, the per-campaign totals repeat on every device row (trap G3).
    With ``calendar`` the retail calendar columns are added (C21).
    """
    key = ["segments__date", "customer__id", "campaign__id"]
    m = METRICS

    def summary(df: DataFrame, prefix: str, count_expr: Column) -> DataFrame:
        return df.groupBy(*[F.col(k).alias(f"_{prefix}_{k}") for k in key]).agg(
            F.sum(F.col(m["cost_micros"]) / F.lit(MICROS)).alias(f"{prefix}_cost"),
            F.sum(m["impressions"]).alias(f"{prefix}_impressions"),
            F.sum(m["clicks"]).alias(f"{prefix}_clicks"),
            F.sum(m["conversions"]).alias(f"{prefix}_conversions"),
            F.sum(m["conversions_value"]).alias(f"{prefix}_conversions_value"),
            F.count_distinct(count_expr).alias(f"{prefix}_count"),
        )

    ags = summary(ad_group_stats, "ad_group", F.col("ad_group__id"))
    kws = summary(
        keyword_stats, "keyword",
        F.concat(F.col("ad_group__id").cast("string"), F.lit("-"), F.col("ad_group_criterion__criterion_id").cast("string")),
    )
    info = latest_history(campaign_history, ["customer__id", "campaign__id"], CAMPAIGN_COLUMNS).select(
        F.col("customer__id").alias("_i_acct"), F.col("campaign__id").alias("_i_camp"),
        F.col("campaign__name").alias("campaign_name"), F.col("campaign__status").alias("latest_status"),
        F.col("campaign__advertising_channel_type").alias("advertising_channel_type"),
    )
    cb = campaign_stats.select(
        F.col("segments__date").alias("fulldate"), F.col("customer__id").alias("account_id"),
        F.col("campaign__id").alias("campaign_id"), F.col("segments__device").alias("device"),
        (F.col(m["cost_micros"]) / F.lit(MICROS)).alias("cost"), F.col(m["impressions"]).alias("_impressions"),
        F.col(m["clicks"]).alias("_clicks"), F.col(m["conversions"]).alias("_conversions"),
        F.col(m["conversions_value"]).alias("_conversions_value"),
    )

    def on(prefix):
        return (
            (F.col("fulldate") == F.col(f"_{prefix}_segments__date"))
            & (F.col("account_id") == F.col(f"_{prefix}_customer__id"))
            & (F.col("campaign_id") == F.col(f"_{prefix}_campaign__id"))
        )

    j = (
        cb.join(info, (cb.account_id == info._i_acct) & (cb.campaign_id == info._i_camp), "left")
        .join(ags, on("ad_group"), "left")
        .join(kws, on("keyword"), "left")
    )
    out = j.select(
        "fulldate", "account_id", "campaign_id", "campaign_name", "latest_status", "advertising_channel_type", "device", "cost",
        *[
            F.coalesce(F.col(f"keyword_{x}"), F.col(f"ad_group_{x}"), F.col(f"_{x}")).alias(x)
            for x in ("impressions", "clicks", "conversions", "conversions_value")
        ],
        F.when(F.col("keyword_cost").isNotNull(), F.lit("keyword"))
        .when(F.col("ad_group_cost").isNotNull(), F.lit("ad_group"))
        .otherwise(F.lit("campaign"))
        .alias("metrics_level"),
        F.coalesce(F.col("ad_group_count"), F.lit(0)).alias("ad_group_count"),
        F.coalesce(F.col("keyword_count"), F.lit(0)).alias("keyword_count"),
    )
    if calendar is not None:
        out = out.withColumns(calendar_columns("fulldate", **calendar))
    return out
