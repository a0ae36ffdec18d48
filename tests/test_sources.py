import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import (
    append_table,
    deleted_rows,
    full_refresh,
    incremental_slice,
    jdbc_options,
    merge_batches,
    next_bookmark,
    read_files,
    schema_for,
    upsert_by_key,
    write_table,
)
from tests.conftest import rows


def test_k_batches_equal_one_full_load(spark, sf_small):
    events = spark.read.parquet(f"{sf_small}/events.parquet").select("event_id", "ts", "value")
    cuts = ["2024-01-08", "2024-01-15", "2024-01-22"]
    bounds = [None, *cuts, None]
    batches = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        b = events
        if lo:
            b = b.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            b = b.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        batches.append(b)
    empty = events.limit(0)
    merged = merge_batches(empty, batches, ["event_id"], ["ts"])
    assert rows(merged) == rows(events)


def test_upsert_batch_wins_and_missing_key_fails(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, b int")
    new = spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "k int, v string, b int")
    assert rows(upsert_by_key(old, new, ["k"], ["b"])) == [(1, "a", 0), (2, "B", 1), (3, "C", 1)]
    with pytest.raises(ValueError):
        upsert_by_key(old, new, ["missing"], ["b"])


def test_incremental_slice_and_bookmark(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "t int")
    assert rows(incremental_slice(df, "t", 5)) == [(5,), (9,)]
    assert rows(incremental_slice(df, "t", 2, floor=6)) == [(9,)]
    assert next_bookmark(df, "t").collect()[0][0] == 9
    assert rows(incremental_slice(df, "t", next_bookmark(df.where("t < 9"), "t").scalar())) == [(5,), (9,)]


def test_full_refresh_reports_deleted(spark):
    old = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    snap = spark.createDataFrame([(1,), (3,)], "k int")
    new, gone = full_refresh(old, snap, ["k"])
    assert rows(new) == [(1,), (3,)] and rows(gone) == [(2,)] == rows(deleted_rows(old, snap, ["k"]))


def test_write_append_and_read_files(spark):
    base = tempfile.mkdtemp(prefix="ledgerlake-test-")
    path = os.path.join(base, "t")
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    write_table(df, "t", path=path)
    append_table(df, path=path)
    assert spark.read.parquet(path).count() == 2
    write_table(df, "t", path=path, mode="overwrite")
    assert spark.read.parquet(path).count() == 1
    csv = os.path.join(base, "c")
    df.write.option("header", "true").csv(csv)
    assert rows(read_files(spark, csv, "csv", "id int, s string")) == [(1, "x")]


def test_schema_rule_and_jdbc_options():
    assert schema_for("node", "custom") == "node" and schema_for(None, "custom") == "custom" and schema_for(None, None) == "marts"
    opts = jdbc_options("jdbc:postgresql://h/db", table="(select 1) q", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert opts["numPartitions"] == "4" and opts["dbtable"] == "(select 1) q"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1", partition_column="id", lower_bound=0, upper_bound=1, num_partitions=2)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_read_source_keeps_the_files_own_splits(spark, sf_small):
    from ledgerlake.sources import read_source

    plan = read_source(spark, sf_small, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text and "Exchange" not in text


def test_ingest_keeps_new_versions_and_late_rows(spark, tmp_path):
    import datetime as dt

    from ledgerlake.streaming import compact, current_table, incremental_ingest

    landing, sink, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    schema = "k int, ts timestamp_ntz, v string"
    day = dt.datetime(2024, 3, 10)
    drops = [
        [(1, day.replace(hour=12), "old"), (2, day + dt.timedelta(days=2), "far ahead")],
        [(1, day.replace(hour=12, minute=30), "NEW"), (4, day - dt.timedelta(days=10), "backfill"), (5, None, "no stamp")],
        [(1, day.replace(hour=13, minute=30), "NEWER"), (2, day, "too old to win"), (5, day, "stamped")],
    ]
    want = [{1: "old", 2: "far ahead"}, {1: "NEW", 2: "far ahead", 4: "backfill", 5: "no stamp"},
            {1: "NEWER", 2: "far ahead", 4: "backfill", 5: "stamped"}]
    snapshot = None
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        incremental_ingest(spark, landing, schema, sink, checkpoint)
        for s in {None, snapshot}:
            assert {r.k: r.v for r in current_table(spark, sink, ["k"], "ts", s).collect()} == want[i]
        snapshot = compact(spark, sink, ["k"], "ts", str(tmp_path / f"snapshot{i}"), snapshot)
    assert spark.read.parquet(snapshot).count() == 4


def test_damaged_rows_are_kept_apart(spark, tmp_path):
    from ledgerlake.sources import read_files_checked

    (tmp_path / "a.csv").write_text("id,qty,name,day\n1,2,x,2024-01-01\n2,two,y,2024-01-01\n3,4\n4,5,z,2024-01-01,extra\n5,,\"a,b\",\n6,1,q,never\n")
    (tmp_path / "b.csv").write_text('id,qty,name,day\n7, 8 ,"unclosed,2024-01-01\n')
    good, bad = read_files_checked(spark, str(tmp_path), "id int, qty int, name string, day date")
    assert sorted((r.id, r.qty, r.name) for r in good.collect()) == [(1, 2, "x"), (5, None, "a,b")] and good.dtypes == [("id", "int"), ("qty", "int"), ("name", "string"), ("day", "date")]
    found = {r.record.split(",")[0]: (r.reason, r.file.rsplit("/", 1)[1]) for r in bad.collect()}
    assert found == {"2": ("qty is no int", "a.csv"), "3": ("malformed", "a.csv"), "4": ("malformed", "a.csv"), "6": ("day is no date", "a.csv"), "7": ("malformed", "b.csv")}
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "x.json").write_text('{"id": 1, "qty": 2}\n{"id": 2, "qty": "n"}\n{"id": 3\n{"id": 4}\n')
    good, bad = read_files_checked(spark, str(tmp_path / "j"), "id int, qty int", "json")
    assert sorted((r.id, r.qty) for r in good.collect()) == [(1, 2), (4, None)]
    assert sorted((r.reason, r.record) for r in bad.collect()) == [("malformed", '{"id": 3'), ("qty is no int", '{"id":"2","qty":"n"}')]


def test_snapshot_changes_reads_differing_buckets_only(spark, tmp_path):
    import glob

    from ledgerlake.sources import snapshot_changes, write_snapshot
    from ledgerlake.sources.snapshots import differing_buckets

    schema = "k long, a string, b double"
    rows = [(i, f"a{i}", float(i)) for i in range(200)] + [(None, "null key", None)]
    later = [r for r in rows if r[0] != 5] + [(900, "new", None)]
    later = [(i, a, None if i == 7 else b) for i, a, b in later]
    for name, data in (("old", rows), ("new", later)):
        write_snapshot(spark.createDataFrame(data, schema), f"{tmp_path}/{name}", ["k"], 64)
    buckets = differing_buckets(spark, f"{tmp_path}/old", f"{tmp_path}/new")
    assert 1 <= len(buckets) <= 3
    for f in glob.glob(f"{tmp_path}/*/rows/snapshot_bucket=*/part-*"):
        if int(f.split("snapshot_bucket=")[1].split("/")[0]) not in buckets:
            open(f, "wb").write(b"not to be read")
    got = {r.k: (r.change, r.changed, r.before and r.before.b, r.after and r.after.b) for r in snapshot_changes(spark, f"{tmp_path}/old", f"{tmp_path}/new", schema, ["k"]).collect()}
    assert got == {5: ("deleted", None, 5.0, None), 7: ("updated", ["b"], 7.0, None), 900: ("inserted", None, None, None)}
    assert snapshot_changes(spark, f"{tmp_path}/old", f"{tmp_path}/old", schema, ["k"]).count() == 0


def test_bucketed_stages_join_and_sum_without_a_shuffle(spark, sf_small):
    from ledgerlake.testbed import commerce

    out = commerce._by_order(spark, commerce._bucketed(spark, sf_small))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and "Bucketed: true" in plan
