import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import monitor_state as ms
from ledgerlake.plans import quality as dq

SCHEMA = "id long, at timestamp_ntz, made timestamp_ntz, v double"
START = dt.datetime(2024, 3, 1)


def make(n, seed=1):
    rng, out = random.Random(seed), []
    for i in range(n):
        at = START + dt.timedelta(seconds=rng.randrange(0, 12 * 86400, 600 if i % 2 else 1))
        value = None if rng.random() < 0.2 else 1e6 + rng.random() * (100 if at.day % 4 else 0)
        out.append((i, at, at - dt.timedelta(days=rng.randrange(4)), value))
    return out + [(n, None, None, 1.0)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(make(600), SCHEMA).cache()


def state(spark, root, rows, runs, again=()):
    for run, share in enumerate(runs):
        landed = rows.where(F.expr(" OR ".join(f"({s})" for s in runs[: run + 1])))
        for _ in range(2 if run in again else 1):
            ms.absorb(spark, root, run, "t", rows.where(share), landed, "at", ["v"], "made")


def shown(df):
    return sorted(tuple(round(x, 3) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_runs_over_kept_state_equal_one_pass(spark, tmp_path, rows):
    late = "id % 11 = 0"
    state(spark, f"{tmp_path}/s", rows, [f"at < '2024-03-05' AND NOT {late}", f"at >= '2024-03-05' AND id % 2 = 0 AND NOT {late}", f"at >= '2024-03-05' AND id % 2 = 1 AND NOT {late}", f"{late} OR at IS NULL"], again=(1, 3))
    got = ms.monitors(spark, f"{tmp_path}/s").cache()
    cut = ["day", "metric_value", "baseline_mean", "baseline_std", "z_score", "is_anomaly"]
    dated = rows.where("at IS NOT NULL")
    plain = {
        "volume": dq.volume_anomalies(dated, "at").withColumnRenamed("row_count", "metric_value"),
        "freshness": dq.freshness_anomalies(dated, "at").withColumnRenamed("max_gap_seconds", "metric_value"),
        "event_freshness": dq.event_freshness(dated, "made", "at").withColumnRenamed("max_lag", "metric_value"),
    }
    for monitor, want in plain.items():
        assert shown(got.where(F.col("monitor") == monitor).select(cut)) == shown(want.withColumn("metric_value", F.col("metric_value").cast("double")).select(cut)), monitor
    columns = dq.column_monitors(dated, ["v"], "at")
    for metric in ("mean", "min", "max", "null_rate"):
        assert shown(got.where(F.col("metric") == metric).select(cut)) == shown(columns.where(F.col("metric") == metric).select(cut)), metric
    # values of a million that differ by parts: a difference of squares would have lost them
    std = {r.day: r.s for r in dated.groupBy(F.to_date("at").alias("day")).agg(F.stddev_samp("v").alias("s")).collect()}
    mine = {r.day: r.metric_value for r in got.where("metric = 'stddev'").collect()}
    assert mine.keys() == std.keys() and all(mine[d] == pytest.approx(std[d], abs=1e-3) for d in std)


def test_folded_state_goes_on(spark, tmp_path, rows):
    runs = ["id < 200", "id >= 200 AND id < 400", "id >= 400"]
    state(spark, f"{tmp_path}/plain", rows, runs)
    state(spark, f"{tmp_path}/a", rows, runs[:2])
    root = ms.fold(spark, f"{tmp_path}/a", f"{tmp_path}/b", 1)
    ms.absorb(spark, root, 2, "t", rows.where(runs[2]), rows, "at", ["v"], "made")
    assert shown(ms.monitors(spark, root)) == shown(ms.monitors(spark, f"{tmp_path}/plain"))


def test_a_run_reads_its_slice_and_the_days_it_touches_again(spark, tmp_path, rows):
    ms.absorb(spark, f"{tmp_path}/s", 0, "t", rows.where("id < 500"), rows, "at", ["v"])

    read = spark.sparkContext.accumulator(0)
    count = F.udf(lambda at: read.add(1) or at, "timestamp_ntz")
    late = rows.where("id >= 500 AND at >= '2024-03-10'")
    days = {r[0] for r in late.select(F.to_date("at")).collect()}
    landed = rows.where(ms._within("at", list(days))).withColumn("at", count("at"))
    ms.absorb(spark, f"{tmp_path}/s", 1, "t", late, landed, "at", ["v"])
    whole = rows.where("at >= '2024-03-10'").count()
    assert 0 < read.value <= 3 * whole < 3 * rows.count() / 3
    assert ms._within("at", [dt.date(2024, 1, 1) + dt.timedelta(3 * i) for i in range(1000)]) is not None


def test_nothing_yet(spark, tmp_path, rows):
    assert ms.monitors(spark, f"{tmp_path}/none").collect() == []
    ms.absorb(spark, f"{tmp_path}/s", 0, "t", rows.limit(0), rows, "at", ["v"])
    assert ms.monitors(spark, f"{tmp_path}/s").collect() == []
