"""Data-quality jobs on the generated tables.

Test results stand-in (from ``events``): invocation = event day, test id =
``user_id``, test name = ``test_<user_id % 40>``, status from the event type
(error -> fail; signup -> error above value 40, else warn; others pass),
short name / type from the event type, table = ``table_<user_id % 12>``,
model id = ``model.<user_id % 15>`` (NULL when ``user_id % 17 = 0``).
Today (``as_of``) is the last event day, 2024-01-30.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import label_columns, zero_fill_daily
from ledgerlake.plans import quality as dq
from ledgerlake.plans.monitor_state import absorb_all, fold, monitors
from ledgerlake.plans.sketches import distinct_error, distinct_over, read_states, top_over, write_distinct_states, write_top_states
from ledgerlake.testbed.base import registry, scratch, table

QUERIES, ORACLE, q = registry()

TODAY = dt.date(2024, 1, 30)
SHORT_NAMES = {
    "click": "volume_anomalies",
    "view": "freshness_anomalies",
    "purchase": "column_anomalies",
    "signup": "schema_changes",
    "error": "not_null",
}
TYPES = {"signup": "schema_change", "error": "dbt_test", "purchase": "anomaly_detection"}


def sround(expr: str, k: int = 4) -> str:
    return f"CAST(ROUND(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


def results(spark, sf):
    e = table(spark, sf, "events")
    et = F.col("event_type")
    short = F.create_map(*[x for kv in SHORT_NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    ttype = F.coalesce(F.create_map(*[x for kv in TYPES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[et], F.lit("anomaly"))
    name_prefix = F.when(et == "click", F.lit("elementary_volume_anomalies_")).when(
        et == "purchase", F.lit("elementary_column_anomalies_")
    ).otherwise(F.lit("test_"))
    return e.select(
        F.col("user_id").alias("test_unique_id"),
        F.concat(name_prefix, (F.col("user_id") % 40).cast("string")).alias("test_name"),
        short[et].alias("test_short_name"),
        ttype.alias("test_type"),
        et.alias("test_sub_type"),
        F.concat(F.lit("table_"), (F.col("user_id") % 12).cast("string")).alias("table_name"),
        F.concat(F.lit("col_"), (F.col("event_id") % 5).cast("string")).alias("column_name"),
        F.when(F.col("user_id") % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("model."), (F.col("user_id") % 15).cast("string")))
        .alias("model_unique_id"),
        F.when(et == "error", F.lit("fail"))
        .when((et == "signup") & (F.col("value") > 40), F.lit("error"))
        .when(et == "signup", F.lit("warn"))
        .otherwise(F.lit("pass"))
        .alias("status"),
        F.to_date("ts").cast("string").alias("invocation_id"),
        F.col("ts").alias("created_at"),
    )


TR = """tr AS (
  SELECT user_id AS test_unique_id,
    CASE WHEN event_type = 'click' THEN 'elementary_volume_anomalies_' WHEN event_type = 'purchase' THEN 'elementary_column_anomalies_'
         ELSE 'test_' END || CAST(user_id % 40 AS VARCHAR) AS test_name,
    CASE event_type WHEN 'click' THEN 'volume_anomalies' WHEN 'view' THEN 'freshness_anomalies'
         WHEN 'purchase' THEN 'column_anomalies' WHEN 'signup' THEN 'schema_changes' WHEN 'error' THEN 'not_null' END AS test_short_name,
    CASE event_type WHEN 'signup' THEN 'schema_change' WHEN 'error' THEN 'dbt_test' WHEN 'purchase' THEN 'anomaly_detection'
         ELSE 'anomaly' END AS test_type,
    event_type AS test_sub_type,
    'table_' || CAST(user_id % 12 AS VARCHAR) AS table_name,
    'col_' || CAST(event_id % 5 AS VARCHAR) AS column_name,
    CASE WHEN user_id % 17 = 0 THEN NULL ELSE 'model.' || CAST(user_id % 15 AS VARCHAR) END AS model_unique_id,
    CASE WHEN event_type = 'error' THEN 'fail' WHEN event_type = 'signup' AND value > 40 THEN 'error'
         WHEN event_type = 'signup' THEN 'warn' ELSE 'pass' END AS status,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS invocation_id,
    ts AS created_at
  FROM events
),
run AS (  -- runs by age: 1 is the latest
  SELECT invocation_id, row_number() OVER (ORDER BY max(created_at) DESC, invocation_id DESC) AS nth FROM tr GROUP BY invocation_id
),
aged AS (SELECT tr.*, nth, status IN ('fail', 'error') AS failing FROM tr JOIN run USING (invocation_id))"""


@q(
    "daily_failures",
    f"""
WITH {TR}
SELECT CAST(created_at AS DATE) AS created_at_date, COUNT(DISTINCT test_name) AS unique_tests
FROM tr WHERE CAST(created_at AS DATE) >= DATE '2024-01-30' - INTERVAL 6 DAY AND status IN ('fail', 'error')
GROUP BY 1
""",
)
def q_daily_failures(spark, sf):
    return dq.daily_distinct(results(spark, sf), TODAY)


@q(
    "daily_executions",
    f"""
WITH {TR}
SELECT CAST(created_at AS DATE) AS created_at_date, COUNT(DISTINCT test_name) AS unique_tests
FROM tr WHERE CAST(created_at AS DATE) >= DATE '2024-01-30' - INTERVAL 6 DAY GROUP BY 1
""",
)
def q_daily_executions(spark, sf):
    return dq.daily_distinct(results(spark, sf), TODAY, statuses=None)


@q(
    "daily_failed_entities",
    f"""
WITH {TR}
SELECT CAST(created_at AS DATE) AS created_at_date, COUNT(DISTINCT table_name) AS unique_tables
FROM tr WHERE CAST(created_at AS DATE) >= DATE '2024-01-30' - INTERVAL 6 DAY AND (status = 'fail' OR status = 'error')
GROUP BY 1
""",
)
def q_daily_failed_entities(spark, sf):
    return dq.daily_distinct(results(spark, sf), TODAY, what="table_name", out="unique_tables")


def metric_topics():
    """The five headline predicates (A.6, headline column)."""
    return {
        "anomalies": F.col("test_name").like("elementary_column_anomalies%"),
        "dbt_tests": F.col("test_type") == "dbt_test",
        "freshness": F.col("test_short_name").isin("freshness_anomalies", "event_freshness_anomalies"),
        "schema": F.col("test_type").like("%schema%"),
        "volume": F.col("test_name").like("elementary_volume_anomalies%")
        | F.col("test_name").like("elementary_source_volume_anomalies%"),
    }


def listing_topics():
    """The five detail-list predicates (A.6, detail column)."""
    return {
        "anomalies": F.col("test_short_name").like("%column%"),
        "dbt_tests": F.col("test_type").like("%dbt%"),
        "freshness": F.col("test_short_name").like("%freshness%"),
        "schema": F.col("test_short_name").like("%schema%"),
        "volume": F.col("test_short_name").like("%volume%"),
    }


def _tagged_sql(predicates: dict[str, str]) -> str:
    """CTE ``tagged``: the latest run's rows, once per topic whose predicate holds."""
    tags = ", ".join(f"if({p}, '{t}', NULL)" for t, p in predicates.items())
    return f"tagged AS (SELECT *, unnest(list_filter([{tags}], lambda t: t IS NOT NULL)) AS topic FROM aged WHERE nth = 1)"


METRIC_PREDICATES_SQL = {
    "anomalies": "test_name LIKE 'elementary_column_anomalies%'",
    "dbt_tests": "test_type = 'dbt_test'",
    "freshness": "test_short_name = 'freshness_anomalies' OR test_short_name = 'event_freshness_anomalies'",
    "schema": "test_type LIKE '%schema%'",
    "volume": "test_name LIKE 'elementary_volume_anomalies%' OR test_name LIKE 'elementary_source_volume_anomalies%'",
}
LISTING_PREDICATES_SQL = {
    "anomalies": "test_short_name LIKE '%column%'",
    "dbt_tests": "test_type LIKE '%dbt%'",
    "freshness": "test_short_name LIKE '%freshness%'",
    "schema": "test_short_name LIKE '%schema%'",
    "volume": "test_short_name LIKE '%volume%'",
}


@q(
    "latest_run_metric",
    f"""
WITH {TR}, {_tagged_sql(METRIC_PREDICATES_SQL)}
SELECT t.topic, count(tagged.topic) AS total, sum((status = 'pass')::INT)::BIGINT AS pass, sum(failing::INT)::BIGINT AS fail
FROM (SELECT unnest({list(METRIC_PREDICATES_SQL)}) AS topic) t LEFT JOIN tagged USING (topic) GROUP BY ALL
""",
)
def q_latest_run_metric(spark, sf):
    out = dq.latest_run_metric(results(spark, sf), metric_topics())
    return out.select("topic", "total", F.col("pass").cast("bigint").alias("pass"), F.col("fail").cast("bigint").alias("fail"))


# Display labels of the detail list. The reference's labels carry a "table." prefix
# (dotted names, F29); that form is covered by tests/test_operators.py, while the
# registered query uses the bare labels so any consumer can select the columns by name.
LISTING_LABELS = {
    "topic": "topic",
    "table_name": "TABLE_NAME",
    "column_name": "COLUMN_NAME",
    "test_short_name": "TEST_SHORT_NAME",
    "test_sub_type": "TEST_SUB_TYPE",
    "created_at": "CREATED_AT",
    "status": "STATUS",
}


@q(
    "latest_run_listing",
    f"""
WITH {TR}, {_tagged_sql(LISTING_PREDICATES_SQL)}
SELECT topic, table_name AS TABLE_NAME, column_name AS COLUMN_NAME, test_short_name AS TEST_SHORT_NAME, test_sub_type AS TEST_SUB_TYPE,
       created_at AS CREATED_AT, status AS STATUS FROM tagged
""",
)
def q_latest_run_listing(spark, sf):
    cols = ["table_name", "column_name", "test_short_name", "test_sub_type", "created_at", "status"]
    rows = dq.latest_run_listing(results(spark, sf), listing_topics(), cols)
    return label_columns(rows.orderBy("topic", "status", "table_name"), LISTING_LABELS)


@q(
    "results_breakdown",
    f"""
WITH {TR}
SELECT count(DISTINCT test_unique_id) FILTER (status = 'pass') AS pass, count(DISTINCT (test_unique_id, status)) FILTER (failing) AS fail
FROM aged WHERE nth = 1
""",
)
def q_results_breakdown(spark, sf):
    out = dq.results_breakdown(results(spark, sf))
    return out.select(F.col("pass").cast("bigint").alias("pass"), F.col("fail").cast("bigint").alias("fail"))


@q(
    "entity_health",
    f"""
WITH {TR}, entity AS (SELECT bool_and(coalesce(status = 'pass', false)) AS healthy FROM aged WHERE nth = 1 AND model_unique_id IS NOT NULL GROUP BY model_unique_id)
SELECT count(*) FILTER (healthy) AS pass, count(*) FILTER (NOT healthy) AS fail FROM entity
""",
)
def q_entity_health(spark, sf):
    return dq.tables_health(results(spark, sf))


@q(
    "monitoring_coverage",
    f"""
WITH {TR},
declared AS (SELECT DISTINCT 'model.' || unnest([user_id % 30, event_id % 10]) AS id FROM events),
seen AS (SELECT id, id IN (SELECT model_unique_id FROM aged WHERE nth = 1 AND model_unique_id IS NOT NULL) AS monitored FROM declared)
SELECT count(*) FILTER (monitored) AS monitored, count(*) FILTER (NOT monitored) AS unmonitored FROM seen
""",
)
def q_monitoring_coverage(spark, sf):
    """Declared = model ids of two lists derived from events; monitored = models of the latest run's results."""
    e = table(spark, sf, "events")
    uid = lambda c: F.concat(F.lit("model."), c.cast("string")).alias("unique_id")
    declared = [e.select(uid(F.col("user_id") % 30)), e.select(uid(F.col("event_id") % 10))]
    return dq.coverage_of_latest_run(declared, results(spark, sf))


@q(
    "new_failures",
    f"""
WITH {TR}, pair AS (
  SELECT test_unique_id, list(test_name) FILTER (nth = 1 AND failing) AS names, count(*) FILTER (nth = 2) AS earlier,
         count(*) FILTER (nth = 2 AND coalesce(status, 'pass') = 'pass') AS cleared
  FROM aged WHERE nth <= 2 GROUP BY test_unique_id
)
SELECT unnest(names) AS "Test Name" FROM (SELECT names, unnest(range(if(earlier = 0, 1, cleared))) FROM pair)
""",
)
def q_new_failures(spark, sf):
    return dq.new_failures(results(spark, sf))


@q(
    "failing_days",
    f"""
WITH {TR}, history AS (
  SELECT list_distinct(list(test_name) FILTER (nth = 1 AND status <> 'pass')) AS names,
         DATE '{TODAY}' - coalesce(max(created_at) FILTER (status = 'pass'), min(created_at))::DATE AS days
  FROM aged GROUP BY test_unique_id
)
SELECT DISTINCT unnest(names) AS "Test Name", greatest(days, 1)::INTEGER AS "Days Failing" FROM history
""",
)
def q_failing_days(spark, sf):
    return dq.failing_days(results(spark, sf), TODAY)


@q(
    "zero_fill_daily",
    """
WITH users AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'),
days AS (SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) t(d)),
counts AS (
  SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY ALL
)
SELECT u.user_id, d.day, COALESCE(c.purchases, 0) AS purchases
FROM users u, days d LEFT JOIN counts c ON c.user_id = u.user_id AND c.day = d.day
""",
)
def q_zero_fill_daily(spark, sf):
    """Purchases per user per day over the last 7 days, missing days filled with 0 (every purchasing user)."""
    e = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    daily = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("purchases"))
    start = TODAY - dt.timedelta(days=6)
    return zero_fill_daily(daily, "day", ["purchases"], start, TODAY, keys=["user_id"])


@q(
    "day_over_day",
    f"""
WITH c AS (
  SELECT event_type,
    COALESCE(SUM(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-30' THEN 1 END), 0) AS today,
    COALESCE(SUM(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-29' THEN 1 END), 0) AS yesterday
  FROM events GROUP BY event_type
)
SELECT event_type, today, yesterday,
  CASE WHEN today = 0 AND yesterday = 0 THEN 0.0 WHEN yesterday = 0 THEN 100.0
       ELSE round_even(CAST(today - yesterday AS DOUBLE) / CAST(yesterday AS DOUBLE) * 100.0, 0) END AS pct_change,
  CASE WHEN (CASE WHEN today = 0 AND yesterday = 0 THEN 0.0 WHEN yesterday = 0 THEN 100.0
       ELSE round_even(CAST(today - yesterday AS DOUBLE) / CAST(yesterday AS DOUBLE) * 100.0, 0) END) > 0 THEN 'up'
       WHEN (CASE WHEN today = 0 AND yesterday = 0 THEN 0.0 WHEN yesterday = 0 THEN 100.0
       ELSE round_even(CAST(today - yesterday AS DOUBLE) / CAST(yesterday AS DOUBLE) * 100.0, 0) END) < 0 THEN 'down'
       ELSE 'flat' END AS direction
FROM c
""",
)
def q_day_over_day(spark, sf):
    e = table(spark, sf, "events")
    daily = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return dq.day_over_day(daily, "day", "n", TODAY, keys=["event_type"])


def _zsql(metric: str, keys: str = "event_type") -> str:
    w = f"OVER (PARTITION BY {keys} ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"
    mean = f"AVG({metric}) {w}"
    std = f"STDDEV_SAMP({metric}) {w}"
    z = f"({metric} - {mean}) / NULLIF({std}, 0)"
    return f"""{sround(mean)} AS baseline_mean, {sround(std)} AS baseline_std, {sround(z)} AS z_score,
       COALESCE(abs({z}) > 3.0, FALSE) AS is_anomaly"""


@q(
    "volume_anomalies",
    f"""
WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY ALL),
span AS (SELECT event_type, MIN(day) AS lo, MAX(day) AS hi FROM c GROUP BY event_type),
spine AS (SELECT event_type, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
daily AS (SELECT s.event_type, s.day, CAST(COALESCE(c.n, 0) AS BIGINT) AS row_count
          FROM spine s LEFT JOIN c ON c.event_type = s.event_type AND c.day = s.day)
SELECT event_type, day, row_count, {_zsql('row_count')} FROM daily
""",
)
def q_volume_anomalies(spark, sf):
    return dq.volume_anomalies(table(spark, sf, "events"), "ts", keys=["event_type"])


@q(
    "freshness_anomalies",
    f"""
WITH g AS (
  SELECT event_type, CAST(ts AS DATE) AS day,
         (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts))) / 1e6 AS gap
  FROM events
),
daily AS (SELECT event_type, day, MAX(gap) AS max_gap_seconds FROM g GROUP BY ALL)
SELECT event_type, day, max_gap_seconds, {_zsql('max_gap_seconds')} FROM daily
""",
)
def q_freshness_anomalies(spark, sf):
    return dq.freshness_anomalies(table(spark, sf, "events"), "ts", keys=["event_type"])


@q(
    "event_freshness",
    f"""
WITH daily AS (
  SELECT CAST(l.l_shipdate AS DATE) AS day,
         MAX(CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE)) AS max_lag
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1
)
SELECT day, max_lag, {_zsql('max_lag', '1')} FROM daily
""",
)
def q_event_freshness(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return dq.event_freshness(j, "o_orderdate", "l_shipdate")


@q(
    "column_anomalies",
    f"""
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, AVG(value) AS mean_value FROM events GROUP BY ALL)
SELECT event_type, day, {sround('mean_value')} AS mean_value, {_zsql('mean_value')} FROM daily
""",
)
def q_column_anomalies(spark, sf):
    return dq.column_anomalies(table(spark, sf, "events"), "value", "ts", keys=["event_type"])


@q(
    "schema_changes",
    """
WITH half AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderdate < DATE '1998-01-01' AS early, o_orderpriority FROM orders),
filled AS (
  SELECT early, unnest(['orderkey', 'custkey', 'note', 'totalprice', 'channel']) AS column_name,
         unnest([count(o_orderkey), count(o_custkey), count(if(early, o_orderstatus, NULL)), count(o_totalprice), count(if(early, NULL, o_orderpriority))]) AS n
  FROM half GROUP BY early
)
SELECT column_name, if(column_name = 'totalprice', 'type_changed', if(bool_or(early), 'removed', 'added')) AS change
FROM filled WHERE n > 0 GROUP BY column_name HAVING count(*) = 1 OR column_name = 'totalprice'
""",
)
def q_schema_changes(spark, sf):
    """Two extracts of orders: the later one no longer fills ``note``, fills ``channel``, and lands prices as text."""
    o = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    cols = [F.col("o_orderkey").alias("o_orderkey"), F.col("o_custkey").alias("o_custkey")]
    none = F.lit(None).cast("string")
    first = o.where(early).select(*cols, F.col("o_orderstatus").alias("o_note"), "o_totalprice", none.alias("o_channel"))
    later = o.where(~early).select(*cols, none.alias("o_note"), F.col("o_totalprice").cast("string").alias("o_totalprice"), F.col("o_orderpriority").alias("o_channel"))
    before, after = dq.observed_catalog(first), dq.observed_catalog(later)
    out = dq.schema_changes(before, after, normalise=F.regexp_replace("column_name", "^[a-z]_", ""))
    return out.select("column_name", "change")


@q(
    "uniqueness_violations",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1",
)
def q_uniqueness_violations(spark, sf):
    return dq.assert_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@q(
    "null_violations",
    """
SELECT d.doc_id, 'quality' AS null_column FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NULL
UNION ALL
SELECT d.doc_id, 'toxic' FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic IS NULL
""",
)
def q_null_violations(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    return dq.assert_not_null(j, ["doc_id"], ["quality", "toxic"])


@q(
    "not_in_null_aware",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def q_not_in_null_aware(spark, sf):
    from ledgerlake.operators.joins import not_in

    """Customers who never placed an urgent order (NOT IN with SQL NULL semantics)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    urgent = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return not_in(c, urgent, "c_custkey", "o_custkey")


RUN_TIME = "2024-01-30 12:00:00"


@q(
    "row_to_json",
    f"""
SELECT 'unique_line_key' AS test_name, TIMESTAMP '{RUN_TIME}' AS test_run_time,
       to_json({{'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber, 'n': n}}) AS test_failures_json
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1)
UNION ALL
SELECT 'labelled_document', TIMESTAMP '{RUN_TIME}',
       to_json({{'doc_id': d.doc_id, 'quality': l.quality, 'toxic': l.toxic}})
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NULL
""",
)
def q_row_to_json(spark, sf):
    """Failing rows of two checks centralised as (test, run time, row as JSON with NULLs kept)."""
    dup = dq.assert_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    unlabelled = docs.where(F.col("quality").isNull()).select("doc_id", "quality", "toxic")
    return dq.centralize_failures({"unique_line_key": dup, "labelled_document": unlabelled}, RUN_TIME)


def _zsql_key(metric: str, keys: str) -> str:
    w = f"OVER (PARTITION BY {keys} ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"
    mean, std = f"AVG({metric}) {w}", f"STDDEV_SAMP({metric}) {w}"
    z = f"({metric} - {mean}) / NULLIF({std}, 0)"
    return f"""{sround(mean)} AS baseline_mean, {sround(std)} AS baseline_std, {sround(z)} AS z_score,
       COALESCE(abs({z}) > 3.0, FALSE) AS is_anomaly"""


MONITOR_SQL = f"""
WITH stamps AS (
  SELECT 'orders' AS table_name, o_orderdate AS ts FROM orders
  UNION ALL SELECT 'lineitem', l_shipdate FROM lineitem
  UNION ALL SELECT 'events', ts FROM events
),
c AS (SELECT table_name, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM stamps GROUP BY ALL),
span AS (SELECT table_name, MIN(day) AS lo, MAX(day) AS hi FROM c GROUP BY table_name),
spine AS (SELECT table_name, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
vol AS (SELECT s.table_name, s.day, CAST(COALESCE(c.n, 0) AS DOUBLE) AS metric_value
        FROM spine s LEFT JOIN c ON c.table_name = s.table_name AND c.day = s.day),
g AS (
  SELECT table_name, CAST(ts AS DATE) AS day,
         (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY table_name ORDER BY ts))) / 1e6 AS gap
  FROM stamps
),
fresh AS (SELECT table_name, day, MAX(gap) AS metric_value FROM g GROUP BY ALL)
SELECT table_name, 'volume' AS monitor, day, metric_value, {_zsql_key('metric_value', 'table_name')} FROM vol
UNION ALL
SELECT table_name, 'freshness', day, metric_value, {_zsql_key('metric_value', 'table_name')} FROM fresh
"""


@q("source_monitoring", MONITOR_SQL)
def q_source_monitoring(spark, sf):
    """Volume and freshness monitors over the three timestamped tables in one job."""
    srcs = {
        "orders": (table(spark, sf, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf, "events"), "ts"),
    }
    return dq.monitor_sources(srcs)


def _monitored(spark, sf):
    srcs = {
        "orders": (table(spark, sf, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf, "events"), "ts"),
    }
    return dq.monitor_sources(srcs)


MONITOR_TR = f"""mon AS ({MONITOR_SQL}),
tr AS (
  SELECT 'test.' || monitor || '.' || table_name AS test_unique_id,
         'source_' || monitor || '_anomalies_' || table_name AS test_name,
         monitor || '_anomalies' AS test_short_name, 'anomaly_detection' AS test_type, monitor AS test_sub_type,
         table_name, NULL::VARCHAR AS column_name, 'source.' || table_name AS model_unique_id,
         CASE WHEN is_anomaly THEN 'fail' ELSE 'pass' END AS status,
         CAST(day AS VARCHAR) AS invocation_id,
         CAST(CAST(day AS VARCHAR) || ' 23:59:59' AS TIMESTAMP) AS created_at
  FROM mon
)"""


@q("monitor_test_results", f"WITH {MONITOR_TR} SELECT * FROM tr")
def q_monitor_test_results(spark, sf):
    """Monitor outputs as test-result rows (one per test per run day)."""
    return dq.as_test_results(_monitored(spark, sf))


@q(
    "monitor_listing",
    f"""
WITH {MONITOR_TR}
SELECT 'freshness' AS topic, table_name, column_name, test_short_name, test_sub_type, created_at, status
FROM tr WHERE created_at = (SELECT max(created_at) FROM tr) AND contains(test_short_name, 'freshness')
""",
)
def q_monitor_listing(spark, sf):
    """The detail list of the latest run, fed by the monitors' own result rows."""
    cols = ["table_name", "column_name", "test_short_name", "test_sub_type", "created_at", "status"]
    topics = {"freshness": F.col("test_short_name").like("%freshness%")}
    return dq.latest_run_listing(dq.as_test_results(_monitored(spark, sf)), topics, cols)


@q(
    "column_monitors",
    f"""
WITH m AS (
  SELECT event_type, ts::DATE AS day, unnest(['mean', 'min', 'max', 'null_rate']) AS metric,
         unnest([avg(v), min(v), max(v), avg((v IS NULL)::INT)]) AS metric_value
  FROM (SELECT *, if(user_id % 7 = 0, NULL, value) AS v FROM events) GROUP BY event_type, ts::DATE
),
z AS (SELECT event_type, day, metric, metric_value, {_zsql('metric_value').replace('PARTITION BY event_type', 'PARTITION BY event_type, metric')} FROM m)
SELECT * REPLACE ({sround('metric_value')} AS metric_value), 'v' AS column_name FROM z
""",
)
def q_column_monitors(spark, sf):
    """All metrics of a column with missing values, in one scan."""
    e = table(spark, sf, "events").withColumn("v", F.when(F.col("user_id") % 7 != 0, F.col("value")))
    return dq.column_monitors(e, ["v"], "ts", keys=["event_type"])


STATE_FROM = ("1996-01-01", "2024-01-15")  # first loads of orders and events end here


@q(
    "monitors_from_state",
    f"""
WITH src AS (
  SELECT 'orders' AS table_name, o_orderdate AS ts, 'v' AS column_name, sqrt(o_totalprice) AS v FROM orders
  UNION ALL SELECT 'events', ts, 'v', if(user_id % 7 = 0, NULL, sqrt(abs(value))) FROM events
),
m AS (
  SELECT table_name, column_name, ts::DATE AS day, unnest(['mean', 'stddev', 'min', 'max', 'null_rate']) AS metric,
         unnest([avg(v), stddev_samp(v), min(v), max(v), avg((v IS NULL)::INT)]) AS metric_value
  FROM src GROUP BY table_name, column_name, ts::DATE
),
src_monitors AS ({MONITOR_SQL})
SELECT table_name, 'column' AS monitor, column_name, metric, day, {sround('metric_value')} AS metric_value,
       {_zsql_key('metric_value', 'table_name, column_name, metric')}
FROM m
UNION ALL
SELECT table_name, monitor, NULL, if(monitor = 'volume', 'row_count', 'max_gap_seconds'), day, {sround('metric_value')},
       baseline_mean, baseline_std, z_score, is_anomaly
FROM src_monitors WHERE table_name <> 'lineitem'
""",
)
def q_monitors_from_state(spark, sf):
    """Volume, freshness and column monitors of two tables after four runs over kept state: a first load, two
    daily slices and late rows of all days. The runs read their slices, not the tables. (Roots of amounts: their
    means don't fall on a rounding boundary, as means of cents do.)"""
    root = scratch(spark, "monitors")
    orders = table(spark, sf, "orders").withColumn("v", F.sqrt("o_totalprice"))
    events = table(spark, sf, "events").withColumn("v", F.when(F.col("user_id") % 7 != 0, F.sqrt(F.abs("value"))))
    sources = {"orders": (orders, "o_orderdate", "o_orderkey"), "events": (events, "ts", "event_id")}
    for run in range(4):
        slices = {}
        for (name, (df, ts, key)), cut in zip(sources.items(), STATE_FROM):
            late, old, even = F.col(key) % 19 == 0, F.col(ts) < F.lit(cut).cast("timestamp_ntz"), F.col(key) % 2 == 0
            landed = F.when(late, 3).when(old, 0).when(even, 1).otherwise(2)
            slices[name] = {"new": df.where(landed == run), "landed": df.where(landed <= run), "ts": ts, "columns": ["v"]}
        absorb_all(spark, root, run, slices)
        if run == 1:
            root = fold(spark, root, f"{root}-folded", run)
    return monitors(spark, root)


@q(
    "distinct_from_sketches",
    """
SELECT event_type, date_trunc('week', ts)::DATE AS period, count(DISTINCT user_id) AS exact, TRUE AS within_bound FROM events GROUP BY ALL
""",
)
def q_distinct_from_sketches(spark, sf):
    """Different users a week and event type: estimated from daily sketches, beside the exact count of the rows."""
    path = scratch(spark, "sketches")
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    for late in (False, True):  # the last days arrive twice, the second time whole
        write_distinct_states(e.where((F.col("day") >= F.lit("2024-01-20")) if late else ((F.col("day") < F.lit("2024-01-20")) | (F.col("event_id") % 2 == 0))), path, "day", "user_id", ["event_type"])
    week = F.date_trunc("week", "day").cast("date")
    found = distinct_over(read_states(spark, path), week, ["event_type"])
    exact = e.groupBy("event_type", week.alias("period")).agg(F.count_distinct("user_id").alias("exact"))
    off = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * distinct_error())
    return exact.join(found, ["event_type", "period"]).select("event_type", "period", "exact", off.alias("within_bound"))


@q(
    "top_value_from_state",
    """
WITH o AS (SELECT o_custkey, if(o_orderkey % 10 < 7, 'main', o_orderpriority) AS v FROM orders),
n AS (SELECT o_custkey, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_custkey) AS total FROM o GROUP BY o_custkey, v)
SELECT o_custkey, v AS top, n AS top_count FROM n WHERE 2 * n > total
""",
)
def q_top_value_from_state(spark, sf):
    """The value that most of a customer's orders have, from sketches kept by customer and year."""
    path = scratch(spark, "top")
    v = F.when(F.col("o_orderkey") % 10 < 7, F.lit("main")).otherwise(F.col("o_orderpriority"))
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), v.alias("v"))
    write_top_states(o, path, "year", "v", ["o_custkey"], tracked=100)
    found = top_over(read_states(spark, path, part="year"), ["o_custkey"], tracked=100)
    return found.where(2 * F.col("top_count") > F.col("n_rows")).drop("n_rows")


@q(
    "nested_schema_changes",
    """
SELECT unnest(['customer.tier', 'lines[].price', 'note', 'remark']) AS path, unnest(['added', 'type_changed', 'removed', 'added']) AS change,
       unnest([NULL, NULL, NULL, 'note']) AS renamed_from WHERE (SELECT count(*) > 0 FROM orders)
""",
)
def q_nested_schema_changes(spark, sf):
    """Orders with nested customer and lines, before and after: a field more in the record, another type inside
    the array, and a column with a new name, told by its values."""
    o = table(spark, sf, "orders")
    line = lambda kind: F.array(F.struct(F.lit(1).alias("nr"), F.col("o_totalprice").cast(kind).alias("price")))
    customer = F.struct(F.col("o_custkey").alias("id"))
    text = F.concat(F.col("o_orderpriority"), F.col("o_orderkey").cast("string"))
    before = o.select("o_orderkey", customer.alias("customer"), line("double").alias("lines"), text.alias("note"))
    more = F.struct(F.col("o_custkey").alias("id"), F.lit("gold").alias("tier"))
    after = o.select("o_orderkey", more.alias("customer"), line("string").alias("lines"), text.alias("remark"))
    found = dq.nested_schema_changes(before.schema, after.schema)
    changes = spark.createDataFrame([(p, c) for p, c, _, _ in found], "path string, change string")
    renamed = dq.rename_candidates(before, after).select(F.col("removed"), F.col("added").alias("path"))
    return changes.join(renamed, "path", "left").select("path", "change", F.col("removed").alias("renamed_from"))
