"""D1-D4 from kept state: a run of the monitors reads the newest slice only.

What the monitors need of a table is a small state that merges: per day the row count, and per
column the number, mean, sum of squared deviations (M2), least, greatest of its values; per hour the
first and last stamp and the largest gap between. Each run appends the state of its slice to a log
(``run=<n>`` folders; a repeated run overwrites its own), and the monitors are computed from the
log: rows of it are days and hours times the runs that touched them, never table rows.

Counts and moments of one day merge whatever order their rows came in, so late rows correct their
day. Gaps don't merge when late rows fall between known stamps; an hour that is touched again is
read again from the landed table, restricted to the days of such hours.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.keyed import latest_per_key
from ledgerlake.plans.quality import freshness_of_hours, hour_gaps, volume_of_counts, zscore_flags
from ledgerlake.sources.tables import path_exists

METRICS = ("mean", "stddev", "min", "max", "null_rate")
_DAYS = "table_name string, day date, column_name string, n_rows long, n long, mean double, m2 double, lo double, hi double, max_lag double, run long"
_HOURS = "table_name string, _hour timestamp_ntz, _first timestamp_ntz, _last timestamp_ntz, _inner double, run long"


def daily_state(table_name: str, df: DataFrame, ts: str, columns: Sequence[str] = (), event_ts: str | None = None) -> DataFrame:
    """One row per day for the table (``column_name`` NULL) and one per day and column, in one scan.

    ``max_lag`` is the most days between ``event_ts`` and ``ts`` (D3), NULL without ``event_ts``.
    """
    lag = F.max(F.datediff(F.to_date(ts), F.to_date(event_ts)).cast("double")) if event_ts else F.lit(None).cast("double")
    found = [F.count(F.lit(1)).alias("_rows"), lag.alias("_lag")]
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        found += [F.struct(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("lo"), F.max(v).alias("hi")).alias(f"_{i}")]
    wide = df.groupBy(F.to_date(ts).alias("day")).agg(*found)
    nothing = F.struct(F.lit(None).cast("string").alias("column_name"), *[F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("mean", "double"), ("m2", "double"), ("lo", "double"), ("hi", "double"))])
    rows = [nothing, *[F.struct(F.lit(c).alias("column_name"), *[F.col(f"_{i}.{x}").alias(x) for x in ("n", "mean", "m2", "lo", "hi")]) for i, c in enumerate(columns)]]
    long = wide.select("day", F.col("_rows").alias("n_rows"), F.col("_lag").alias("max_lag"), F.inline(F.array(*rows)))
    return long.select(F.lit(table_name).alias("table_name"), "day", "column_name", "n_rows", "n", "mean", "m2", "lo", "hi", "max_lag")


def merged_days(parts: DataFrame) -> DataFrame:
    """States of the same table, day and column as one. M2 of the whole is the parts' M2 plus the
    squared distances of their means from the whole's mean, each times its number of values."""
    keys = ["table_name", "day", "column_name"]
    w = Window.partitionBy(*keys)
    together = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(w), F.sum("n").over(w))
    apart = F.col("mean") - F.col("_mean")
    merged = parts.withColumn("_mean", together).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("max_lag").alias("max_lag"),
    )
    return merged


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _within(ts: str, days: list[dt.date], most: int = 64) -> Column:
    """``ts`` on one of ``days`` or between near ones: at most ``most`` ranges, which reach the scan."""
    days = sorted(days)
    gaps = sorted(range(1, len(days)), key=lambda i: days[i - 1] - days[i])[: most - 1]
    cuts = [0, *sorted(i for i in gaps if days[i] - days[i - 1] > dt.timedelta(1)), len(days)]
    stamp = lambda d: F.lit(str(d)).cast("timestamp_ntz")
    return reduce(Column.__or__, [(F.col(ts) >= stamp(days[a])) & (F.col(ts) < stamp(days[b - 1] + dt.timedelta(1))) for a, b in zip(cuts, cuts[1:])])


def absorb(
    spark: SparkSession, root: str, run: int, table_name: str, new: DataFrame, landed: DataFrame, ts: str,
    columns: Sequence[str] = (), event_ts: str | None = None,
) -> None:
    """Add the ``new`` rows of a table to the state at ``root``, as run number ``run``.

    ``landed`` is the whole table with the new rows; only days with an hour that an earlier run has
    seen are read of it. Runs are numbered upwards; the same run again replaces what it wrote. Rows
    without ``ts`` count on no day.
    """
    dated = new.where(F.col(ts).isNotNull())
    days = daily_state(table_name, dated, ts, columns, event_ts)
    days.write.mode("overwrite").parquet(f"{root}/days/run={run}/of={table_name}")
    seen = _log(spark, f"{root}/hours", _HOURS).where((F.col("table_name") == table_name) & (F.col("run") < run)).select("_hour").distinct()
    hour = F.date_trunc("HOUR", F.col(ts)).cast("timestamp_ntz")
    touched = dated.select(hour.alias("_hour")).distinct()
    again = touched.join(seen, "_hour", "left_semi")
    late = [r[0] for r in again.select(F.to_date("_hour")).distinct().collect()]  # a row a day
    fresh = dated
    if late:
        fresh = dated.join(again.withColumnRenamed("_hour", "_h"), hour == F.col("_h"), "left_anti")
        whole = landed.where(_within(ts, late)).join(again.withColumnRenamed("_hour", "_h"), hour == F.col("_h"), "left_semi")
        fresh = fresh.select(ts).unionByName(whole.select(ts))
    hours = hour_gaps(fresh.select(ts), ts).select(F.lit(table_name).alias("table_name"), "_hour", "_first", "_last", F.col("_inner").cast("double").alias("_inner"))
    hours.write.mode("overwrite").parquet(f"{root}/hours/run={run}/of={table_name}")


def fold(spark: SparkSession, root: str, target: str, run: int) -> str:
    """The state at ``root`` as one run, number ``run``, in the new folder ``target``; later runs go on there."""
    days, hours = current_state(spark, root)
    days.write.mode("overwrite").parquet(f"{target}/days/run={run}/of=all")
    hours.write.mode("overwrite").parquet(f"{target}/hours/run={run}/of=all")
    return target


def current_state(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(days, hours): the log merged by table, day and column; the last reading of each table's hour."""
    hours = latest_per_key(_log(spark, f"{root}/hours", _HOURS), ["table_name", "_hour"], ["run"])
    return merged_days(_log(spark, f"{root}/days", _DAYS)), hours.drop("run")


def monitors(spark: SparkSession, root: str, metrics: Sequence[str] = METRICS, train: int = 14, k: float = 3.0) -> DataFrame:
    """All monitors of all tables: ``(table_name, monitor, column_name, metric, day, metric_value,
    baseline_mean, baseline_std, z_score, is_anomaly)``.

    ``volume`` (D1, days without rows count 0), ``freshness`` (D2, seconds), ``event_freshness`` (D3,
    days) where it is kept, and ``column`` (D4) for each column and metric.
    """
    days, hours = current_state(spark, root)
    key = ["table_name"]
    of_table = days.where(F.col("column_name").isNull())
    volume = volume_of_counts(of_table.select(*key, "day", F.col("n_rows").alias("row_count")), key, train, k)
    fresh = freshness_of_hours(hours, key, train, k)
    lag = zscore_flags(of_table.where(F.col("max_lag").isNotNull()), key, "day", "max_lag", train, k)
    n = F.col("n")
    values = {
        "mean": F.col("mean"), "stddev": F.sqrt(F.try_divide(F.col("m2"), F.nullif(n - 1, F.lit(0)))), "min": F.col("lo"), "max": F.col("hi"),
        "null_rate": 1 - n / F.col("n_rows"),
    }
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), values[m].alias("metric_value")) for m in metrics])
    long = days.where(F.col("column_name").isNotNull()).select(*key, "column_name", "day", F.inline(pairs))
    column = zscore_flags(long, [*key, "column_name", "metric"], "day", "metric_value", train, k)

    def shown(df: DataFrame, monitor: str, value: str, column_name: Column, metric: Column) -> DataFrame:
        return df.select(
            *key, F.lit(monitor).alias("monitor"), column_name.alias("column_name"), metric.alias("metric"), "day",
            F.round(F.col(value).cast("double"), 4).alias("metric_value"), "baseline_mean", "baseline_std", "z_score", "is_anomaly",
        )

    none = F.lit(None).cast("string")
    out = shown(volume, "volume", "row_count", none, F.lit("row_count"))
    out = out.unionByName(shown(fresh, "freshness", "max_gap_seconds", none, F.lit("max_gap_seconds")))
    out = out.unionByName(shown(lag, "event_freshness", "max_lag", none, F.lit("max_lag")))
    return out.unionByName(shown(column, "column", "metric_value", F.col("column_name"), F.col("metric")))


def absorb_all(spark: SparkSession, root: str, run: int, slices: Mapping[str, dict]) -> None:
    """``absorb`` for several tables: name -> its other arguments (``new, landed, ts``, ...)."""
    for name, arguments in slices.items():
        absorb(spark, root, run, name, **arguments)
