import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import quality as dq
from tests.conftest import rows

SCHEMA = "test_unique_id string, test_name string, status string, invocation_id string, created_at timestamp_ntz, model_unique_id string"


def run(day, hour=12):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture()
def results(spark):
    data = [
        # previous run (day 9)
        ("t1", "pass_to_fail", "pass", "r9", run(9), "m1"),
        ("t2", "fail_to_fail", "fail", "r9", run(9), "m1"),
        ("t3", "error_to_fail", "error", "r9", run(9), "m2"),
        ("t5", "pass_to_warn", "pass", "r9", run(9), "m2"),
        # older history
        ("t2", "fail_to_fail", "pass", "r6", run(6), "m1"),
        ("t4", "absent_to_error", "fail", "r7", run(7), None),
        # latest run (day 10)
        ("t1", "pass_to_fail", "fail", "r10", run(10), "m1"),
        ("t2", "fail_to_fail", "fail", "r10", run(10), "m1"),
        ("t3", "error_to_fail", "fail", "r10", run(10), "m2"),
        ("t4", "absent_to_error", "error", "r10", run(10), None),
        ("t5", "pass_to_warn", "warn", "r10", run(10), "m2"),
        ("t6", "ok", "pass", "r10", run(10, 13), "m3"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_new_failures_golden(spark, results):
    got = sorted(r[0] for r in dq.new_failures(results).collect())
    assert got == ["absent_to_error", "pass_to_fail"]


def test_failing_days_golden(spark, results):
    got = dict(rows(dq.failing_days(results, dt.date(2024, 1, 10))))
    # last pass today -> 1 (t1 passed on day 9 -> 1 day); t2 last passed day 6 -> 4; t4 never passed, first seen day 7 -> 3
    assert got["pass_to_fail"] == 1
    assert got["fail_to_fail"] == 4
    assert got["absent_to_error"] == 3
    assert got["pass_to_warn"] == 1


def test_tables_health_and_breakdown(spark, results):
    assert tuple(dq.tables_health(results).collect()[0]) == (1, 2)  # m3 pass; m1, m2 fail; null model ignored
    assert tuple(dq.results_breakdown(results).collect()[0]) == (1, 4)


def test_latest_run_metric_null_sums(spark, results):
    topics = {"all": F.lit(True), "none": F.col("test_name") == "nothing"}
    got = {r.topic: (r.total, r.pass_, r.fail) for r in dq.latest_run_metric(results, topics).withColumnRenamed("pass", "pass_").collect()}
    assert got["all"] == (6, 1, 4) and got["none"] == (0, None, None)


def test_monitoring_coverage_ignores_unknown_monitored(spark):
    models = spark.createDataFrame([("a",), ("b",), ("c",)], "unique_id string")
    sources = spark.createDataFrame([("c",), ("d",)], "unique_id string")
    monitored = spark.createDataFrame([("a",), ("zz",)], "unique_id string")
    assert tuple(dq.monitoring_coverage([models, sources], monitored).collect()[0]) == (1, 3)


def test_volume_anomaly_flags_spike(spark):
    # 9 or 11 rows a day, then a spike (a flat baseline has no stddev, so no z-score)
    data = [(dt.datetime(2024, 1, d, 1, i),) for d in range(1, 21) for i in range(9 + 2 * (d % 2))]
    data += [(dt.datetime(2024, 1, 21, 1, i),) for i in range(60)]
    out = dq.volume_anomalies(spark.createDataFrame(data, "ts timestamp_ntz"), "ts")
    flagged = [r.day for r in out.where("is_anomaly").collect()]
    assert flagged == [dt.date(2024, 1, 21)]


def test_freshness_gap_spans_midnight(spark):
    data = [(dt.datetime(2024, 1, 1, 22),), (dt.datetime(2024, 1, 2, 3),), (dt.datetime(2024, 1, 2, 4),)]
    out = {r.day: r.max_gap_seconds for r in dq.freshness_anomalies(spark.createDataFrame(data, "ts timestamp_ntz"), "ts").collect()}
    assert out[dt.date(2024, 1, 2)] == 5 * 3600 and out[dt.date(2024, 1, 1)] is None


def test_schema_changes(spark):
    before = spark.createDataFrame([("a", "int"), ("b", "string"), ("c", "int")], "column_name string, data_type string")
    after = spark.createDataFrame([("a", "bigint"), ("b", "string"), ("d", "int")], "column_name string, data_type string")
    got = dict(rows(dq.schema_changes(before, after), "column_name", "change"))
    assert got == {"a": "type_changed", "c": "removed", "d": "added"}


def test_assertions_and_centralisation(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 2, None), (2, 3, "y")], "id int, a int, b string")
    assert rows(dq.assert_unique(df, ["id"])) == [(1, 2)]
    assert rows(dq.assert_not_null(df, ["id"], ["a", "b"])) == [(1, "a"), (1, "b")]
    central = dq.centralize_failures({"unique_id": dq.assert_unique(df, ["id"])}, "2024-01-10 12:00:00")
    r = central.collect()[0]
    assert r.test_name == "unique_id" and r.test_failures_json == '{"id":1,"n":2}'
    assert dq.centralize_failures({"x": df}, "2024-01-10", enabled=False) is None


def test_monitor_sources_to_failing_days(spark):
    """Monitors over two sources -> test-result rows -> failing-days report."""
    steady = [(dt.datetime(2024, 1, d, 1, i),) for d in range(1, 21) for i in range(9 + 2 * (d % 2))]
    spike = steady + [(dt.datetime(2024, 1, 21, 1, i),) for i in range(60)]
    srcs = {"a": (spark.createDataFrame(steady, "ts timestamp_ntz"), "ts"), "b": (spark.createDataFrame(spike, "ts timestamp_ntz"), "ts")}
    mon = dq.monitor_sources(srcs, monitors=("volume",))
    res = dq.as_test_results(mon)
    flagged = [(r.test_name, r.invocation_id) for r in res.where("status = 'fail'").collect()]
    assert flagged == [("source_volume_anomalies_b", "2024-01-21")]
    got = dict(rows(dq.failing_days(res, dt.date(2024, 1, 21))))
    assert got == {"source_volume_anomalies_b": 1}  # passed the day before


def test_results_to_store_excludes_skipped_and_errors(spark, results):
    assert sorted(r.status for r in dq.results_to_store(results).collect()) == ["fail"] * 5 + ["warn"]


def test_freshness_when_half_of_a_load_shares_one_stamp(spark):
    import datetime as dt

    from ledgerlake.plans.quality import freshness_anomalies

    base = dt.datetime(2024, 1, 1)
    stamps = [base + dt.timedelta(hours=i, minutes=(7 * i) % 50) for i in range(60)]
    rows = [(t,) for t in stamps] + [(base + dt.timedelta(days=1, hours=3),)] * 60 + [(None,)]
    got = {r.day: r.max_gap_seconds for r in freshness_anomalies(spark.createDataFrame(rows, "ts timestamp_ntz").repartition(7), "ts").collect()}
    want, seen = {}, sorted(t for t, in rows if t)
    for a, b in zip(seen, seen[1:]):
        want[b.date()] = max(want.get(b.date(), 0.0), (b - a).total_seconds())
    assert got == want


def test_equal_stamps_do_not_depend_on_the_order_of_rows(spark):
    import datetime as dt

    from ledgerlake.plans.ads import latest_history
    from ledgerlake.plans.quality import latest_run

    t = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame([("b", t, 1), ("a", t, 2), ("a", t, 3)], "invocation_id string, created_at timestamp_ntz, n int")
    history = spark.createDataFrame([(1, t, None, "x"), (1, t, "n", "y"), (1, t, "n", "z")], "id int, _sdc_extracted_at timestamp_ntz, name string, status string")
    for parts in (1, 2, 5):
        assert [r.n for r in latest_run(runs.repartition(parts, "n")).collect()] == [1]
        assert latest_history(history.repartition(parts), ["id"], ["name", "status"]).collect()[0][1:] == ("n", "z")


def test_nested_schema_changes_and_renames(spark):
    from pyspark.sql.types import StructType

    ddl = StructType.fromDDL
    before = ddl("a int, s struct<x: int, y: array<struct<p: double, q: string>>>, m map<string, struct<v: int>>, gone struct<z: int>")
    after = ddl("a bigint, s struct<x: int, y: array<struct<p: string, q: string, r: date>>>, m map<string, struct<v: int, w: int>>, s2 array<int>")
    assert dq.nested_schema_changes(before, after) == [
        ("a", "type_changed", "int", "bigint"), ("gone", "removed", "struct", None), ("s2", "added", None, "array"),
        ("m{value}.w", "added", None, "int"), ("s.y[].p", "type_changed", "double", "string"), ("s.y[].r", "added", None, "date"),
    ]
    assert dq.nested_schema_changes(before, before) == []
    rows = spark.range(3000).selectExpr("id", "CAST(id * 7 AS STRING) AS old_name", "CAST(id AS STRING) AS dropped")
    renamed = rows.selectExpr("id", "IF(id % 50 = 0, 'x', old_name) AS new_name", "'new' AS fresh")
    got = [(r.removed, r.added) for r in dq.rename_candidates(rows, renamed).collect()]
    assert got == [("old_name", "new_name")]
    assert dq.rename_candidates(rows, rows).collect() == []
