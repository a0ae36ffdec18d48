"""Data-quality monitors and test-result reporting.

Monitors reduce the monitored table to one row per (table, day) with partial
aggregation first; the trailing-baseline windows then run on that small daily
series (bounded by the number of days, not by rows). The freshness monitor
needs consecutive timestamps, which it gets from the range-partitioned
``neighbour_value`` operator rather than one window over the whole table.

Result-table reports all start from "the invocation of the newest row",
computed with ``max_by`` as a one-row frame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ledgerlake.functions import pct_change, row_to_json
from ledgerlake.operators.setops import union_all

FAIL_STATUSES = ("fail", "error")


# --- D1-D4: anomaly monitors ----------------------------------------------------------------
def zscore_flags(
    daily: DataFrame,
    keys: Sequence[str],
    day: str,
    metric: str,
    train: int = 14,
    k: float = 3.0,
    digits: int = 4,
) -> DataFrame:
    """Baseline mean / sample stddev of ``metric`` over the previous ``train`` days, z-score, flag.

    ``daily`` must be one row per (keys, day); the window frame is
    ``ROWS BETWEEN train PRECEDING AND 1 PRECEDING`` within each key.
    """
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-train, -1)
    mean = F.avg(metric).over(w)
    std = F.stddev_samp(metric).over(w)
    z = F.try_divide(F.col(metric) - mean, F.nullif(std, F.lit(0.0)))
    return daily.withColumns(
        {
            "baseline_mean": F.round(mean, digits),
            "baseline_std": F.round(std, digits),
            "z_score": F.round(z, digits),
            "is_anomaly": F.coalesce(F.abs(z) > F.lit(k), F.lit(False)),
        }
    )


def _spine(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Every day from each key's first to last day (generated per key, no join)."""
    span = df.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return span.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day))


def volume_anomalies(
    df: DataFrame, ts: str, keys: Sequence[str] = (), train: int = 14, k: float = 3.0
) -> DataFrame:
    """Daily row count (zero-filled between first and last day) vs its trailing baseline."""
    counts = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    return volume_of_counts(counts, keys, train, k)


def volume_of_counts(counts: DataFrame, keys: Sequence[str] = (), train: int = 14, k: float = 3.0) -> DataFrame:
    """D1 from daily counts ``(keys, day, row_count)``."""
    daily = _spine(counts, keys, "day").join(counts, [*keys, "day"], "left").withColumn(
        "row_count", F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint")
    )
    return zscore_flags(daily, keys, "day", "row_count", train, k)


def freshness_anomalies(
    df: DataFrame, ts: str, keys: Sequence[str] = (), train: int = 14, k: float = 3.0
) -> DataFrame:
    """Per day, the largest gap (seconds) between consecutive timestamps, vs baseline.

    The first row of a day is measured from the last row before it. Equal stamps are
    folded map-side first, so a load that shares one stamp is one row a task; gaps
    inside an hour come from a window over that hour's distinct stamps, and a second
    window over the short series of hours adds the gaps between hours.
    """
    return freshness_of_hours(hour_gaps(df, ts, keys), keys, train, k)


def _seconds(a: Column | str, b: Column | str) -> Column:
    # timestamp_diff on wall-clock (NTZ) values does not depend on the session time zone
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(1e6)


def hour_gaps(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, _hour, _first, _last, _inner)``: first and last stamp of each hour with rows, and the largest gap between."""
    hour = F.date_trunc("HOUR", F.col(ts)).cast("timestamp_ntz")
    stamps = df.where(F.col(ts).isNotNull()).groupBy(*keys, hour.alias("_hour"), F.col(ts).alias("_ts")).agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(*keys, "_hour").orderBy("_ts")
    return stamps.withColumn("_gap", _seconds(F.lag("_ts").over(inside), F.col("_ts"))).groupBy(*keys, "_hour").agg(
        F.min("_ts").alias("_first"), F.max("_ts").alias("_last"),
        F.greatest(F.max("_gap"), F.max(F.when(F.col("_n") > 1, F.lit(0.0)))).alias("_inner"),
    )


def freshness_of_hours(hours: DataFrame, keys: Sequence[str] = (), train: int = 14, k: float = 3.0) -> DataFrame:
    """D2 from ``hour_gaps``."""
    series = Window.partitionBy(*keys).orderBy("_hour")
    between = hours.withColumn("_gap", F.greatest("_inner", _seconds(F.lag("_last").over(series), F.col("_first"))))
    daily = between.groupBy(*keys, F.to_date("_hour").alias("day")).agg(F.max("_gap").alias("max_gap_seconds"))
    return zscore_flags(daily, keys, "day", "max_gap_seconds", train, k)


def event_freshness(
    df: DataFrame, event_ts: str, load_ts: str, keys: Sequence[str] = (), unit: str = "day", train: int = 14, k: float = 3.0
) -> DataFrame:
    """D3: per load day, the largest lag between event time and load time, vs baseline."""
    if unit == "day":
        lag = F.datediff(F.to_date(load_ts), F.to_date(event_ts)).cast("double")
    else:
        lag = F.timestamp_diff("SECOND", F.col(event_ts), F.col(load_ts)).cast("double")
    daily = df.groupBy(*keys, F.to_date(load_ts).alias("day")).agg(F.max(lag).alias("max_lag"))
    return zscore_flags(daily, keys, "day", "max_lag", train, k)


def column_anomalies(
    df: DataFrame,
    column: str,
    ts: str,
    keys: Sequence[str] = (),
    metric: str = "mean",
    train: int = 14,
    k: float = 3.0,
) -> DataFrame:
    """One daily column metric (``mean``, ``min``, ``max``, ``null_rate``) vs baseline."""
    daily = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(_column_metrics(column)[metric].alias(f"{metric}_value"))
    out = zscore_flags(daily, keys, "day", f"{metric}_value", train, k)
    return out.withColumn(f"{metric}_value", F.round(f"{metric}_value", 4))


def _column_metrics(column: str) -> dict[str, Column]:
    c = F.col(column)
    return {
        "mean": F.avg(c).cast("double"),
        "min": F.min(c).cast("double"),
        "max": F.max(c).cast("double"),
        "null_rate": F.avg(F.when(c.isNull(), 1.0).otherwise(0.0)),
    }


def column_monitors(
    df: DataFrame,
    columns: Sequence[str],
    ts: str,
    keys: Sequence[str] = (),
    metrics: Sequence[str] = ("mean", "min", "max", "null_rate"),
    train: int = 14,
    k: float = 3.0,
) -> DataFrame:
    """D4 for several columns and metrics in one scan: one row per (keys, day, column, metric)."""
    found = {(c, m): _column_metrics(c)[m] for c in columns for m in metrics}
    wide = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(*[e.alias(f"_{i}") for i, e in enumerate(found.values())])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"), F.col(f"_{i}").alias("metric_value")) for i, (c, m) in enumerate(found)]
    long = wide.select(*keys, "day", F.inline(F.array(*rows)))
    out = zscore_flags(long, [*keys, "column_name", "metric"], "day", "metric_value", train, k)
    return out.withColumn("metric_value", F.round("metric_value", 4))


def schema_changes(before: DataFrame, after: DataFrame, normalise: Column | None = None) -> DataFrame:
    """Added / removed / retyped columns between two catalog frames ``(column_name, data_type)``.

    Build the catalog frames from ``df.schema`` (metadata, bounded by the column
    count); ``normalise`` optionally rewrites names before matching.
    """
    def prep(df, side):
        name = F.col("column_name") if normalise is None else normalise
        return df.select(name.alias("column_name"), F.col("data_type").alias(f"{side}_type"))

    b, a = prep(before, "before"), prep(after, "after")
    j = b.join(a, "column_name", "full")
    change = (
        F.when(F.col("before_type").isNull(), F.lit("added"))
        .when(F.col("after_type").isNull(), F.lit("removed"))
        .when(F.col("before_type") != F.col("after_type"), F.lit("type_changed"))
    )
    return j.withColumn("change", change).where(F.col("change").isNotNull())


def catalog_frame(spark, df: DataFrame) -> DataFrame:
    """A table's columns as a frame (schema metadata only)."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def type_paths(dtype: DataType, path: str = "") -> list[tuple[str, str]]:
    """``(path, type)`` of a type and of all within: ``a.b`` for a struct's field, ``a[]`` for an array's
    elements, ``a{key}`` and ``a{value}`` for a map's. Containers are given by their kind only."""
    own = [(path, dtype.typeName() if isinstance(dtype, (StructType, ArrayType, MapType)) else dtype.simpleString())] if path else []
    if isinstance(dtype, StructType):
        within = [(f"{path}.{f.name}" if path else f.name, f.dataType) for f in dtype]
    elif isinstance(dtype, ArrayType):
        within = [(f"{path}[]", dtype.elementType)]
    else:
        within = [(f"{path}{{key}}", dtype.keyType), (f"{path}{{value}}", dtype.valueType)] if isinstance(dtype, MapType) else []
    return own + [x for p, t in within for x in type_paths(t, p)]


def nested_schema_changes(before: StructType, after: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """D5 at any depth: ``(path, change, before_type, after_type)`` of paths added, removed or retyped.
    What lies within an added, removed or retyped path is not told again."""
    old, new = dict(type_paths(before)), dict(type_paths(after))
    out = []
    for path in sorted({*old, *new}, key=lambda p: (p.count(".") + p.count("[") + p.count("{"), p)):
        if old.get(path) == new.get(path) or any(path.startswith((f"{p}.", f"{p}[", f"{p}{{")) for p, *_ in out):
            continue
        out.append((path, "added" if path not in old else "removed" if path not in new else "type_changed", old.get(path), new.get(path)))
    return out


def rename_candidates(before: DataFrame, after: DataFrame, least: float = 0.8, lg_k: int = 12) -> DataFrame:
    """``(removed, added, likeness)``: top-level columns that went and came with the same type and much
    the same values, by the Jaccard estimate of theta sketches of their values (one scan of each side)."""
    changes = nested_schema_changes(before.schema, after.schema)
    tops = {c: [(p, b if c == "removed" else a) for p, c2, b, a in changes if c2 == c and not any(x in p for x in ".[{")] for c in ("removed", "added")}
    spark = before.sparkSession
    schema = "removed string, added string, likeness double"

    def sketches(df: DataFrame, names: list) -> DataFrame:
        rows = df.agg(*[F.theta_sketch_agg(F.col(f"`{n}`").cast("string"), lg_k).alias(f"_{i}") for i, (n, _) in enumerate(names)])
        return rows.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.col(f"_{i}").alias("state")) for i, (n, t) in enumerate(names)])))

    if not tops["removed"] or not tops["added"]:
        return spark.createDataFrame([], schema)
    gone = sketches(before, tops["removed"]).select(F.col("name").alias("removed"), "type", F.col("state").alias("_old"))
    come = sketches(after, tops["added"]).select(F.col("name").alias("added"), "type", F.col("state").alias("_new"))
    both = gone.join(come, "type")  # columns, not rows
    shared, all_ = F.theta_sketch_estimate(F.theta_intersection("_old", "_new")), F.theta_sketch_estimate(F.theta_union("_old", "_new"))
    likeness = F.try_divide(shared.cast("double"), all_.cast("double"))
    return both.select("removed", "added", likeness.alias("likeness")).where(F.col("likeness") >= least)


def observed_catalog(df: DataFrame) -> DataFrame:
    """The columns that hold data: ``(column_name, data_type)`` of each column with a non-NULL row.

    A column that an extract still declares but no longer fills counts as removed. One scan
    with one counter per column.
    """
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"_{i}").alias("n"))
            for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows))).where("n > 0").drop("n")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial-aggregated)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_not_null(df: DataFrame, id_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per (row id, column) where the column is NULL."""
    checks = [F.when(F.col(c).isNull(), F.lit(c)) for c in cols]
    return df.select(*id_cols, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("null_column"))


# --- D7 / D8: failure centralisation ----------------------------------------------------------
def centralize_failures(failing: Mapping[str, DataFrame], run_time: dt.datetime | str, enabled: bool = True) -> DataFrame | None:
    """Failing rows of every test as ``(test_name, test_run_time, test_failures_json)``.

    Each failing row becomes one JSON object with NULL fields kept; all tests are
    unioned into one frame (append it with ``append_table``).
    """
    if not enabled or not failing:
        return None
    parts = [
        df.select(
            F.lit(name).cast("string").alias("test_name"),
            F.lit(run_time).cast("timestamp_ntz").alias("test_run_time"),
            row_to_json().alias("test_failures_json"),
        )
        for name, df in failing.items()
    ]
    return union_all(parts)


def results_to_store(results: DataFrame, store_failures_for: Sequence[str] = ("fail", "warn")) -> DataFrame:
    """Which results get their failing rows stored (skipped / errored tests are excluded)."""
    return results.where(F.col("status").isin(list(store_failures_for)))


# --- C22-C29: result-table reports ----------------------------------------------------------
def latest_invocation(results: DataFrame, ts: str = "created_at", inv: str = "invocation_id") -> DataFrame:
    """One-row frame: the invocation of the newest result row (of equal stamps, the greatest id)."""
    return results.agg(F.max(F.struct(ts, inv))[inv].alias("_latest_inv"))


def latest_run(results: DataFrame, inv: str = "invocation_id", ts: str = "created_at") -> DataFrame:
    """Rows of the latest invocation (join to the one-row frame; broadcast is bounded by one row)."""
    li = latest_invocation(results, ts, inv)
    return results.join(F.broadcast(li), F.col(inv) == F.col("_latest_inv"), "left_semi")


def daily_distinct(
    results: DataFrame,
    as_of: dt.date,
    what: str = "test_name",
    statuses: Sequence[str] | None = FAIL_STATUSES,
    days: int = 7,
    out: str = "unique_tests",
) -> DataFrame:
    """Distinct ``what`` per day over the last ``days`` days (optionally only given statuses), by day."""
    d = F.to_date("created_at")
    f = results.where(d >= F.date_sub(F.lit(as_of).cast("date"), days - 1))
    if statuses:
        f = f.where(F.col("status").isin(list(statuses)))
    return f.groupBy(d.alias("created_at_date")).agg(F.count_distinct(what).alias(out)).orderBy("created_at_date")


def latest_run_metric(results: DataFrame, topics: Mapping[str, Column]) -> DataFrame:
    """For each topic predicate, total / pass / fail of the latest invocation.

    One pass over the latest run computes every topic; sums are NULL when no
    row matches while the count is 0, as in SQL.
    """
    run = latest_run(results)
    aggs = []
    for name, pred in topics.items():
        n = F.count_if(pred)
        aggs += [
            n.alias(f"{name}__total"),
            F.when(n > 0, F.count_if(pred & (F.col("status") == "pass"))).alias(f"{name}__pass"),
            F.when(n > 0, F.count_if(pred & F.col("status").isin(*FAIL_STATUSES))).alias(f"{name}__fail"),
        ]
    wide = run.agg(*aggs)
    rows = [
        F.struct(F.lit(name).alias("topic"), F.col(f"{name}__total").alias("total"), F.col(f"{name}__pass").alias("pass"),
                 F.col(f"{name}__fail").alias("fail"))
        for name in topics
    ]
    return wide.select(F.inline(F.array(*rows)))


def latest_run_listing(results: DataFrame, topics: Mapping[str, Column], columns: Sequence[str]) -> DataFrame:
    """Detail rows of the latest invocation for each topic predicate (``topic`` column added), sorted by
    topic, status and table where listed, then by the other columns."""
    run = latest_run(results)
    tags = F.filter(F.array(*[F.when(p, F.lit(n)) for n, p in topics.items()]), lambda x: x.isNotNull())
    first = [c for c in ("status", "table_name") if c in columns]
    return run.select(F.explode(tags).alias("topic"), *columns).orderBy("topic", *first, *[c for c in columns if c not in first])


def results_breakdown(results: DataFrame) -> DataFrame:
    """Pass / fail over the distinct (test, status) pairs of the latest run."""
    pairs = latest_run(results).select("test_unique_id", "status").distinct()
    return pairs.agg(
        F.sum(F.when(F.col("status") == "pass", 1).otherwise(0)).alias("pass"),
        F.sum(F.when(F.col("status").isin(*FAIL_STATUSES), 1).otherwise(0)).alias("fail"),
    )


def tables_health(results: DataFrame, entity: str = "model_unique_id") -> DataFrame:
    """Entities whose worst status in the latest run is pass / not pass."""
    per = (
        latest_run(results)
        .where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.max(F.when(F.col("status") == "pass", 0).otherwise(1)).alias("status"))
    )
    return per.agg(F.count_if(F.col("status") == 0).alias("pass"), F.count_if(F.col("status") == 1).alias("fail"))


def monitoring_coverage(all_ids: Sequence[DataFrame], monitored: DataFrame, id_col: str = "unique_id") -> DataFrame:
    """Monitored vs unmonitored among the union of declared ids (ids only on the monitored side are ignored)."""
    a = union_all([d.select(F.col(id_col).alias("_a")) for d in all_ids]).distinct()
    m = monitored.select(F.col(id_col).alias("_m")).distinct()
    j = a.join(m, a._a == m._m, "left")
    monitored_n = F.count_distinct("_m")
    return j.agg(monitored_n.alias("monitored"), (F.count_distinct("_a") - monitored_n).alias("unmonitored"))


def coverage_of_latest_run(all_ids: Sequence[DataFrame], results: DataFrame, entity: str = "model_unique_id", id_col: str = "unique_id") -> DataFrame:
    """C27 over test results: an id counts as monitored if the latest run has a result for it."""
    seen = latest_run(results).where(F.col(entity).isNotNull()).select(F.col(entity).alias(id_col))
    return monitoring_coverage(all_ids, seen, id_col)


def two_latest_runs(results: DataFrame) -> DataFrame:
    """At most two rows ``(run, nth)``: the ids of the newest run (1) and of the one before (2).

    Runs are reduced to one row each first and ordered by their newest stamp, then id.
    """
    runs = results.where(F.col("invocation_id").isNotNull()).groupBy("invocation_id").agg(F.max("created_at").alias("at"))
    newest = [F.desc("at"), F.desc("invocation_id")]
    top = runs.orderBy(*newest).limit(2)
    return top.select(F.col("invocation_id").alias("run"), F.row_number().over(Window.orderBy(*newest)).alias("nth"))


def new_failures(results: DataFrame) -> DataFrame:
    """Tests failing (fail/error) in the latest run that passed or were absent in the previous run, by name.

    One scan finds the two run ids, a second reads the rows of those two runs only
    and folds them per test: how often it fails now, and its earlier statuses.
    """
    runs = F.broadcast(two_latest_runs(results))  # two rows
    now = F.col("nth") == 1
    rows = results.join(runs, F.col("invocation_id") == F.col("run"), "inner")
    failing = now & F.col("status").isin(*FAIL_STATUSES)
    per_test = rows.groupBy("test_unique_id").agg(
        F.collect_list(F.when(failing, F.struct("test_name"))).alias("failing"),
        F.count_if(~now).alias("earlier"),
        F.count_if(~now & ((F.col("status") == "pass") | F.col("status").isNull())).alias("cleared"),
    )
    # a failing row stands once per earlier row that lets it through, or alone without any earlier row
    alone = F.col("test_unique_id").isNull() | (F.col("earlier") == 0)
    times = F.when(alone, F.lit(1)).otherwise(F.col("cleared")).cast("int")
    named = per_test.select(F.explode("failing").alias("f"), times.alias("times"))
    return named.select(F.explode(F.array_repeat("f.test_name", F.col("times"))).alias("Test Name")).orderBy("`Test Name`")


def failing_days(results: DataFrame, as_of: dt.date) -> DataFrame:
    """Per currently failing test (status != pass), days since its last pass, or since first
    seen when it never passed; 0 counts as 1. Deduplicated per (test name, days) (trap G26), sorted by days, then name.

    One aggregate per test over the history: last pass, first seen, and the names under
    which it fails in the latest run.
    """
    li = F.broadcast(latest_invocation(results))  # one row
    now = F.col("_latest_inv").isNotNull()
    rows = results.where(F.col("test_unique_id").isNotNull()).join(li, F.col("invocation_id") == F.col("_latest_inv"), "left")
    per_test = rows.groupBy("test_unique_id").agg(
        F.max(F.when(F.col("status") == "pass", F.col("created_at"))).alias("_last_pass"),
        F.min("created_at").alias("_first_seen"),
        F.collect_set(F.when(now & (F.col("status") != "pass"), F.struct("test_name"))).alias("_names"),
    )
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.coalesce("_last_pass", "_first_seen")))
    out = per_test.select(
        F.explode("_names.test_name").alias("Test Name"),
        F.when(days == 0, F.lit(1)).otherwise(days).alias("Days Failing"),
    )
    return out.distinct().orderBy("`Days Failing`", "`Test Name`")


# --- C30 / C31: report series ---------------------------------------------------------------
def day_over_day(daily: DataFrame, day: str, value: str, as_of: dt.date, keys: Sequence[str] = ()) -> DataFrame:
    """today's and yesterday's values, percent change (three rules) and its direction."""
    t = F.lit(as_of).cast("date")
    agg = daily.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col(day) == t, F.col(value))), F.lit(0)).alias("today"),
        F.coalesce(F.sum(F.when(F.col(day) == F.date_sub(t, 1), F.col(value))), F.lit(0)).alias("yesterday"),
    )
    pct = pct_change("today", "yesterday")
    return agg.withColumns(
        {
            "pct_change": pct,
            "direction": F.when(pct > 0, F.lit("up")).when(pct < 0, F.lit("down")).otherwise(F.lit("flat")),
        }
    )


# --- Source monitoring: the same monitors over many sources in one job ------------------------
def monitor_sources(
    sources: Mapping[str, tuple[DataFrame, str]],
    monitors: Sequence[str] = ("volume", "freshness"),
    train: int = 14,
    k: float = 3.0,
) -> DataFrame:
    """Run volume and/or freshness monitors over several tables at once.

    ``sources`` maps a table name to ``(frame, timestamp column)``. Only the
    timestamp column of each table is read; the tables are unioned with a
    ``table_name`` tag and every monitor runs once over the union, keyed by table
    (one set of shuffles for all sources instead of one job per table).
    Output: ``table_name, monitor, day, metric_value, baseline_mean,
    baseline_std, z_score, is_anomaly``.
    """
    stamps = union_all(
        [df.select(F.lit(name).alias("table_name"), F.col(ts).cast("timestamp_ntz").alias("_ts")) for name, (df, ts) in sources.items()]
    )
    parts = []
    if "volume" in monitors:
        v = volume_anomalies(stamps, "_ts", keys=["table_name"], train=train, k=k)
        parts.append(v.select("table_name", F.lit("volume").alias("monitor"), "day",
                              F.col("row_count").cast("double").alias("metric_value"),
                              "baseline_mean", "baseline_std", "z_score", "is_anomaly"))
    if "freshness" in monitors:
        f = freshness_anomalies(stamps, "_ts", keys=["table_name"], train=train, k=k)
        parts.append(f.select("table_name", F.lit("freshness").alias("monitor"), "day",
                              F.col("max_gap_seconds").alias("metric_value"),
                              "baseline_mean", "baseline_std", "z_score", "is_anomaly"))
    return union_all(parts)


def as_test_results(monitored: DataFrame, test_type: str = "anomaly_detection") -> DataFrame:
    """Monitor output -> one result row per test per invocation (the day it ran for).

    A test is (monitor, table); status is ``fail`` for an anomalous day, else
    ``pass``; the result time is the end of that day. The shape is the one the
    result reports (C22-C29) read.
    """
    day_end = F.to_timestamp_ntz(F.concat(F.col("day").cast("string"), F.lit(" 23:59:59")))
    return monitored.select(
        F.concat(F.lit("test."), F.col("monitor"), F.lit("."), F.col("table_name")).alias("test_unique_id"),
        F.concat(F.lit("source_"), F.col("monitor"), F.lit("_anomalies_"), F.col("table_name")).alias("test_name"),
        F.concat(F.col("monitor"), F.lit("_anomalies")).alias("test_short_name"),
        F.lit(test_type).alias("test_type"),
        F.col("monitor").alias("test_sub_type"),
        F.col("table_name"),
        (F.col("column_name") if "column_name" in monitored.columns else F.lit(None)).cast("string").alias("column_name"),
        F.concat(F.lit("source."), F.col("table_name")).alias("model_unique_id"),
        F.when(F.col("is_anomaly"), F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.col("day").cast("string").alias("invocation_id"),
        day_end.alias("created_at"),
    )
