"""Sources, sinks, incremental loads and streaming on the generated tables.

Scratch output goes under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster), one fresh sub-folder per call.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ledgerlake.operators import flatten_structs, key_totals_beside_rows, label_columns, normalise_timestamps, override_types, salted_join, select_fields
from ledgerlake.sources import (
    append_table,
    deleted_rows,
    full_snapshot,
    incremental_slice,
    merge_partitions,
    next_bookmark,
    read_files,
    read_files_checked,
    snapshot_changes,
    upsert_by_key,
    write_snapshot,
    write_table,
)
from ledgerlake.streaming import compact, current_table, incremental_ingest, upsert_stream, upserted
from ledgerlake.testbed.base import registry, scratch, table

QUERIES, ORACLE, q = registry()


@q("csv_round_trip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_csv_round_trip(spark, sf):
    """nation written as CSV files and read back through the file-drop source with an explicit schema."""
    path = scratch(spark, "csv")
    table(spark, sf, "nation").write.mode("overwrite").option("header", "true").csv(path)
    return read_files(spark, path, "csv", schema="n_nationkey int, n_name string, n_regionkey int")


@q(
    "select_flatten_label",
    """
SELECT o_orderkey AS "Order", o_custkey AS "Customer", o_orderstatus AS "Status", o_totalprice AS "Total"
FROM orders
""",
)
def q_select_flatten_label(spark, sf):
    """Nested record -> ``a__b`` columns -> glob field selection (last match wins) -> display labels."""
    o = table(spark, sf, "orders")
    nested = o.select(
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("priority")).alias("customer"),
            F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total")).alias("money"),
        ).alias("order")
    )
    flat = flatten_structs(nested)
    picked = select_fields(flat, ["order__*", "!order__customer__*", "order__customer__id"])
    return label_columns(
        picked,
        {"order__key": "Order", "order__customer__id": "Customer", "order__money__status": "Status", "order__money__total": "Total"},
    )


CUT = "2024-01-20"
BATCH_FROM = "2024-01-15"


@q(
    "incremental_slice",
    f"""
SELECT event_id, ts, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{CUT}')
""",
)
def q_incremental_slice(spark, sf):
    """Rows at/after the bookmark left by a load that stopped at the cut (bookmark row included)."""
    e = table(spark, sf, "events")
    bookmark = next_bookmark(e.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")), "ts").scalar()
    return incremental_slice(e, "ts", bookmark).select("event_id", "ts", "event_type")


@q(
    "upsert_by_key",
    f"""
SELECT event_id, ts, user_id, event_type, CASE WHEN ts >= TIMESTAMP '{BATCH_FROM}' THEN value + 1 ELSE value END AS value
FROM events
""",
)
def q_upsert_by_key(spark, sf):
    """A load up to the cut merged with an overlapping corrected batch: the batch wins on its keys."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    existing = e.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).withColumn("_batch", F.lit(0))
    batch = e.where(F.col("ts") >= F.lit(BATCH_FROM).cast("timestamp_ntz")).withColumns(
        {"value": F.col("value") + 1, "_batch": F.lit(1)}
    )
    return upsert_by_key(existing, batch, ["event_id"], ["_batch", "ts"]).drop("_batch")


@q(
    "deleted_rows",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'",
)
def q_deleted_rows(spark, sf):
    """Rows gone from a full snapshot (the snapshot no longer has pending orders)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    snapshot = o.where(F.col("o_orderstatus") != "P")
    return deleted_rows(o, snapshot, ["o_orderkey"])


@q(
    "streaming_ingest",
    f"""
SELECT event_id, ts, user_id, event_type,
       value + (CASE WHEN event_id % 3 = 0 THEN 100 ELSE 0 END + CASE WHEN ts < TIMESTAMP '{BATCH_FROM}' AND event_id % 5 = 0 THEN 1000 ELSE 0 END) AS value
FROM events
""",
)
def q_streaming_ingest(spark, sf):
    """events landed as four files over three stream runs: a first extract of two files, then newer
    versions of every third event minutes later (inside any delay one might set), then a late file that
    corrects the oldest days. The newest version of each event wins; a snapshot is folded in between."""
    run = scratch(spark, "stream")
    landing, sink, checkpoint = (os.path.join(run, x) for x in ("landing", "table", "checkpoint"))
    snapshot = None
    for i, files in enumerate(_event_drops(spark, sf)):
        for f in files:
            f.write.mode("append").parquet(landing)
        incremental_ingest(spark, source=landing, sink=sink, checkpoint=checkpoint, schema=EVENT_VERSIONS)
        if i == 1:
            snapshot = compact(spark, sink, ["event_id"], "version", os.path.join(run, "snapshot"))
    return current_table(spark, sink, ["event_id"], "version", snapshot).select("event_id", "ts", "user_id", "event_type", "value")


EVENT_VERSIONS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, version timestamp_ntz"


def _event_drops(spark, sf):
    """The files of each of three stream runs."""
    e = table(spark, sf, "events").withColumn("version", F.col("ts"))
    cut = F.lit(BATCH_FROM).cast("timestamp_ntz")
    newer = e.where("event_id % 3 = 0").withColumns({"value": F.col("value") + 100, "version": F.col("ts") + F.expr("INTERVAL 5 MINUTES")})
    fix = F.when(F.col("event_id") % 3 == 0, F.col("value") + 1100).otherwise(F.col("value") + 1000)
    late = e.where((F.col("ts") < cut) & (F.col("event_id") % 5 == 0)).withColumns({"value": fix, "version": F.col("ts") + F.expr("INTERVAL 10 MINUTES")})
    drops = [[e.where(F.col("ts") >= cut), e.where(F.col("ts") < cut)], [newer], [late]]
    return [[f.select("event_id", "ts", "user_id", "event_type", "value", "version") for f in files] for files in drops]


@q("streaming_upsert", ORACLE["streaming_ingest"])
def q_streaming_upsert(spark, sf):
    """The same files through a stream that keeps the newest version of each event in its state and rewrites
    only the buckets of events that changed; each run starts anew from the stream's checkpoint."""
    run = scratch(spark, "upsert")
    landing, target, checkpoint = (os.path.join(run, x) for x in ("landing", "table", "checkpoint"))
    for files in _event_drops(spark, sf):
        for f in files:
            f.write.mode("append").parquet(landing)
        upsert_stream(spark, landing, EVENT_VERSIONS, target, checkpoint, keys=["event_id"], ts="version", buckets=16)
    return upserted(spark, target, EVENT_VERSIONS).drop("version")


@q(
    "typed_fields",
    """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS seen_at, value::DECIMAL(18,2)::DOUBLE AS amount,
       '{"user":' || user_id || ',"kind":"' || event_type || '"}' AS who
FROM events
""",
)
def q_typed_fields(spark, sf):
    """Landed text fields brought to their declared types, a nested one to JSON text, time stamps to ISO-8601."""
    e = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("seen_at"), F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
        F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")).alias("who"),
    )
    return normalise_timestamps(override_types(e, {"amount": "double", "who": "json"}), ["seen_at"], "yyyy/MM/dd HH:mm:ss")


@q(
    "table_writes",
    """
SELECT o_orderkey, if(o_orderstatus = 'P', -o_totalprice, o_totalprice) AS o_totalprice, o_orderstatus FROM orders
""",
)
def q_table_writes(spark, sf):
    """orders through every kind of write: a stale snapshot replaced by a full one of the closed orders, the
    others appended in two batches, then one partition overwritten with corrected rows."""
    path = scratch(spark, "writes")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    part = ["o_orderstatus"]
    write_table(o.where("o_orderkey % 2 = 0"), "", path=path, partition_by=part, mode="overwrite")
    full = scratch(spark, "snapshot")
    full_snapshot(o.where("o_orderkey % 3 = 0"), path=full)
    full_snapshot(o.where("o_orderstatus = 'F'"), path=full)
    write_table(spark.read.parquet(full), "", path=path, partition_by=part)
    write_table(o.where("o_orderstatus = 'O'"), "", path=path, partition_by=part)
    for odd in (0, 1):
        append_table(o.where(f"o_orderstatus = 'P' AND o_orderkey % 2 = {odd}"), path=(late := full + f"-{odd}"))
        write_table(spark.read.parquet(late), "", path=path, partition_by=part, mode="append" if odd else "overwrite")
    fixed = o.where("o_orderstatus = 'P'").withColumn("o_totalprice", -F.col("o_totalprice"))
    write_table(fixed, "", path=path, partition_by=part)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("o_orderstatus").cast("string").alias("o_orderstatus"))


@q(
    "partition_merge",
    """
SELECT o_orderkey, if(o_orderstatus = 'P' AND o_orderkey % 2 = 0, o_totalprice + 1, o_totalprice) AS o_totalprice, o_orderstatus FROM orders
""",
)
def q_partition_merge(spark, sf):
    """Corrections to every other pending order merged into orders by status: one partition is rewritten."""
    path = scratch(spark, "orders")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").withColumn("version", F.lit(0))
    write_table(o, "", path=path, partition_by=["o_orderstatus"])
    fixed = o.where("o_orderstatus = 'P' AND o_orderkey % 2 = 0").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "version": F.lit(1)})
    merge_partitions(spark, path, fixed, ["o_orderkey"], ["version"], ["o_orderstatus"], scratch(spark, "merged"))
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("o_orderstatus").cast("string").alias("o_orderstatus"))


@q(
    "damaged_file_drop",
    """
WITH d AS (
  SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice, o_orderstatus,
         CASE WHEN o_orderkey % 11 = 3 THEN 'malformed' WHEN o_orderkey % 13 = 5 THEN 'o_totalprice is no double'
              WHEN o_orderkey % 17 = 7 THEN 'day is no date' END AS reason
  FROM orders
)
SELECT o_orderkey AS id, if(reason IS NULL, day, NULL) AS day, if(reason IS NULL, o_totalprice, NULL) AS total, if(reason IS NULL, o_orderstatus, NULL) AS status,
       reason, CASE WHEN reason = 'malformed' THEN o_orderkey || ',' || day
                    WHEN reason IS NOT NULL THEN o_orderkey || ',' || if(reason LIKE 'day%', 'soon', day::VARCHAR) || ',' || if(reason LIKE 'o_%', 'n/a', '7.5') || ',' || o_orderstatus END AS record
FROM d
""",
)
def q_damaged_file_drop(spark, sf):
    """orders dropped as CSV files with cut lines and wrong types: good rows typed, the others kept apart
    with the reason and the record as it came (their ids are read off it)."""
    path = scratch(spark, "drop")
    key = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    cut, no_total, no_day = key % 11 == 3, (key % 11 != 3) & (key % 13 == 5), (key % 11 != 3) & (key % 13 != 5) & (key % 17 == 7)
    day = F.when(no_day, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    total = F.when(no_total, "n/a").when(no_day, "7.5").otherwise(F.col("o_totalprice").cast("string"))
    line = F.when(cut, F.concat_ws(",", key, day)).otherwise(F.concat_ws(",", key, day, total, "o_orderstatus"))
    o.select(line.alias("value")).write.text(path)
    good, bad = read_files_checked(spark, path, "o_orderkey long, day date, o_totalprice double, o_orderstatus string", options={"header": "false"})
    none = F.lit(None)
    kept = good.select(F.col("o_orderkey").alias("id"), "day", F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"), none.cast("string").alias("reason"), none.cast("string").alias("record"))
    return kept.unionByName(bad.select(
        F.substring_index("record", ",", 1).cast("long").alias("id"), none.cast("date").alias("day"), none.cast("double").alias("total"), none.cast("string").alias("status"), "reason", "record",
    ))


@q(
    "snapshot_changes",
    """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 101 = 1 THEN 'inserted' WHEN o_orderkey % 101 = 2 THEN 'deleted' ELSE 'updated' END AS change,
       CASE o_orderkey % 101 WHEN 3 THEN 'o_totalprice' WHEN 4 THEN 'o_orderstatus,o_totalprice' END AS columns,
       if(o_orderkey % 101 = 1, NULL, o_totalprice) AS before, if(o_orderkey % 101 = 2, NULL, if(o_orderkey % 101 IN (3, 4), o_totalprice + 1, o_totalprice)) AS after
FROM orders WHERE o_orderkey % 101 IN (1, 2, 3, 4)
""",
)
def q_snapshot_changes(spark, sf):
    """Two full loads of orders: rows that came, went, or have another price or status."""
    root, key = scratch(spark, "snapshots"), F.col("o_orderkey") % 101
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_snapshot(o.where(key != 1), f"{root}/old", ["o_orderkey"], 32)
    later = o.where(key != 2).withColumns({
        "o_totalprice": F.when(key.isin(3, 4), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(key == 4, F.lit("X")).otherwise(F.col("o_orderstatus")),
    })
    write_snapshot(later, f"{root}/new", ["o_orderkey"], 32)
    found = snapshot_changes(spark, f"{root}/old", f"{root}/new", "o_orderkey long, o_orderstatus string, o_totalprice double", ["o_orderkey"])
    columns = F.when(F.col("change") == "updated", F.array_join("changed", ","))
    return found.select("o_orderkey", "change", columns.alias("columns"), F.col("before.o_totalprice").alias("before"), F.col("after.o_totalprice").alias("after"))


@q(
    "join_with_hot_key",
    """
WITH o AS (SELECT o_orderkey, if(o_orderkey % 2 = 0, 0, o_custkey) AS cust FROM orders),
c AS (SELECT c_custkey AS cust, c_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT 0, 'placeholder')
SELECT cust, o_orderkey, c_name FROM o FULL JOIN c USING (cust)
""",
)
def q_join_with_hot_key(spark, sf):
    """Orders full-joined with customers, half of them on one placeholder customer, whose rows are salted."""
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, 0).otherwise(F.col("o_custkey")).cast("long").alias("cust"))
    c = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("long").alias("cust"), "c_name")
    c = c.unionByName(spark.range(1).select(F.col("id").alias("cust"), F.lit("placeholder").alias("c_name")))
    return salted_join(o, c, ["cust"], "full")


@q(
    "totals_beside_orders",
    """
WITH o AS (SELECT o_orderkey, if(o_orderkey % 2 = 0, 0, o_custkey) AS cust, o_totalprice::DECIMAL(18,2) AS price FROM orders)
SELECT o_orderkey, cust, (sum(price) OVER (PARTITION BY cust))::DECIMAL(28,2) AS cust_total, count(*) OVER (PARTITION BY cust) AS cust_orders FROM o
""",
)
def q_totals_beside_orders(spark, sf):
    """Each order beside its customer's total, half of the orders on one placeholder customer."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, 0).otherwise(F.col("o_custkey")).cast("long").alias("cust"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    total = {"cust_total": F.sum("price").cast("decimal(28,2)"), "cust_orders": F.count(F.lit(1))}
    return key_totals_beside_rows(o, ["cust"], total).drop("price")
