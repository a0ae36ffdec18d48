import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from ledgerlake.plans.incremental import LedgerRules, refresh_ledger
from ledgerlake.sources import replace_rows

ORDERS, REFUNDS = "id long, email string, created_at date, amount long", "order_id long, day date, amount long"


def small_chain(t, first):
    """Order days and refund days of a tiny shop, with the order's type."""
    o = t["orders"].join(first.withColumn("_first", F.lit(True)), F.col("id") == F.col("order_id"), "left").select(
        F.col("id").alias("_o"), F.col("created_at").alias("_d"), F.col("amount").alias("sold"), F.when(F.col("_first"), "New").otherwise("Returning").alias("type")
    )
    r = t["refunds"].groupBy("order_id", "day").agg(F.sum("amount").alias("back"))
    j = o.join(r, (F.col("_o") == F.col("order_id")) & (F.col("_d") == F.col("day")), "full")
    return j.select(F.coalesce("_o", "order_id").alias("order_id"), F.coalesce("_d", "day").alias("fulldate"), "sold", "type", "back")


RULES = LedgerRules({"orders": "id", "refunds": "order_id"}, lambda t: t["orders"].where("amount > 0"), small_chain, orders_per_part=10, email_buckets=4)


def plain(orders, refunds):
    """The same ledger from all rows at once; ``orders`` by id, ``refunds`` lists by order id."""
    first = {}
    for i, (_, email, day, amount) in orders.items():
        key = email.lower() if email else None
        if amount > 0 and (key not in first or (day, i) < first[key]):
            first[key] = (day, i)
    first, out = {i for _, i in first.values()}, {}
    for i, (_, _, day, amount) in orders.items():
        out[i, day] = [amount, "New" if i in first else "Returning", None]
    for i, rows in refunds.items():
        for _, day, amount in rows:
            row = out.setdefault((i, day), [None, None, None])
            row[2] = (row[2] or 0) + amount
    return sorted((i, day, *row) for (i, day), row in out.items())


def shown(ledger):
    return sorted(tuple(r) for r in ledger.select("order_id", "fulldate", "sold", "type", "back").collect())


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def test_slices_give_the_ledger_of_one_load(spark, tmp_path):
    rng, orders, refunds = random.Random(2), {}, {}
    for run in range(3):
        names = rng.sample(range(40), 40 if run == 0 else 6) + ([rng.randrange(40, 60)] if run else [])
        new_orders = {i: (i, rng.choice(["a", "B", "b", "c", None, f"x{i % 7}"]), day(rng.randrange(120)), rng.randrange(-1, 5)) for i in names}
        new_refunds = {i: [(i, day(rng.randrange(150)), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 3))] for i in rng.sample(range(45), 12 if run == 0 else 3)}
        for i in list(new_refunds)[::2]:  # some on the order's own day
            if i in new_orders:
                new_refunds[i][0] = (i, new_orders[i][2], 3)
        slices = {"orders": new_orders.values(), "refunds": [r for rows in new_refunds.values() for r in rows]}
        if run == 1:
            slices, new_orders = {"refunds": slices["refunds"]}, {}
        orders.update(new_orders)
        refunds.update(new_refunds)
        frames = {n: spark.createDataFrame(list(rows), ORDERS if n == "orders" else REFUNDS) for n, rows in slices.items()}
        ledger = refresh_ledger(spark, f"{tmp_path}/shop", f"{tmp_path}/run{run}", frames, RULES)
        assert shown(ledger) == plain(orders, refunds)
        if run == 2:  # a run that is repeated changes nothing
            assert shown(refresh_ledger(spark, f"{tmp_path}/shop", f"{tmp_path}/run{run}", frames, RULES)) == plain(orders, refunds)


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    root = f"{tmp_path}/shop"
    orders = [(i, f"c{i}", day(i), 5) for i in range(100)]
    frames = {"orders": spark.createDataFrame(orders, ORDERS), "refunds": spark.createDataFrame([(3, day(4), 1)], REFUNDS)}
    refresh_ledger(spark, root, f"{tmp_path}/run0", frames, RULES)
    # a late refund of order 95 in May: order range 9, the months of its day and of the refund
    keep = {"schemas/orders", "schemas/refunds", "landed/orders/order_part=9", "landed/refunds/order_part=9", "ledger/ledger_month=2024-04", "ledger/ledger_month=2024-05", "months/order_part=9"}
    bucket = spark.sql("SELECT pmod(xxhash64('c95'), 4)").first()[0]
    keep.add(f"emails/email_bucket={bucket}")
    spoilt = {}
    for f in glob.glob(f"{root}/**/part-*.parquet", recursive=True):
        if os.path.relpath(os.path.dirname(f), root) not in keep:
            with open(f, "wb") as out:
                out.write(b"no parquet")
            spoilt[f] = os.stat(f).st_mtime_ns
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    assert len(spoilt) > 15
    ledger = refresh_ledger(spark, root, f"{tmp_path}/run1", {"refunds": spark.createDataFrame([(95, day(130), 2)], REFUNDS)}, RULES)
    assert {f: os.stat(f).st_mtime_ns for f in spoilt} == spoilt
    rows = shown(ledger.where("ledger_month >= '2024-04' AND order_id = 95"))
    assert rows == [(95, day(95), 5, "New", None), (95, day(130), None, None, 2)]


def test_replace_rows(spark, tmp_path):
    def rows(*r):
        return spark.createDataFrame(r, "k long, v string, p string")

    path, none = f"{tmp_path}/t", rows((0, "", "")).limit(0)
    assert sorted(replace_rows(spark, path, rows((1, "a", "x"), (2, "b", "x"), (3, "c", "y")), none, "k", "p", f"{tmp_path}/s0")) == ["x", "y"]
    moved, old = rows((3, "C", "x")), rows((3, "", "y"))
    for i in (1, 2):  # key 3 moves to x; y has no rows left; a repeat does nothing
        assert sorted(replace_rows(spark, path, moved, old, "k", "p", f"{tmp_path}/s{i}")) == ["x", "y"]
        got = sorted(tuple(r) for r in spark.read.schema("k long, v string, p string").parquet(path).select("k", "v", "p").collect())
        assert got == [(1, "a", "x"), (2, "b", "x"), (3, "C", "x")]
        assert not os.path.exists(f"{path}/p=y")
    assert replace_rows(spark, path, none, none, "k", "p", f"{tmp_path}/s3") == []


def test_replace_rows_writes_the_rows_once(spark, tmp_path):
    schema = "k long, v string, p string"
    path, scratch = f"{tmp_path}/t", f"{tmp_path}/s"
    replace_rows(spark, path, spark.createDataFrame([(None, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z"), (5, "e", "z")], schema), spark.createDataFrame([], schema), "k", "p", f"{tmp_path}/s0")
    rows, gone = spark.createDataFrame([(None, "A", "x"), (6, "f", "x"), (6, "g", "x")], schema), spark.createDataFrame([(3, "", "y"), (4, "", "z"), (9, "", "w")], schema)
    assert sorted(replace_rows(spark, path, rows, gone, "k", "p", scratch)) == ["w", "x", "y", "z"]
    assert "v" not in spark.read.parquet(scratch).columns  # keys only: the rows go to the table directly
    got = sorted(((r.k or 0), r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [(0, "A", "x"), (2, "b", "x"), (5, "e", "z"), (6, "f", "x"), (6, "g", "x")]
    assert not os.path.exists(f"{path}/p=y")


def test_chain_reads_the_touched_rows_from_files(spark, tmp_path):
    seen = []

    def chain(t, first):
        seen.extend(f for rows in t.values() for f in rows.inputFiles())
        return small_chain(t, first)

    rules = LedgerRules(RULES.keys, RULES.orders, chain, orders_per_part=10, email_buckets=4)
    frames = {"orders": spark.createDataFrame([(i, f"c{i}", day(i), 5) for i in range(30)], ORDERS), "refunds": spark.createDataFrame([(3, day(4), 1)], REFUNDS)}
    refresh_ledger(spark, f"{tmp_path}/shop", f"{tmp_path}/run0", frames, rules)
    assert seen and all("/run0/touched_" in f for f in seen)


def test_a_complete_run_leaves_no_stages(spark, tmp_path):
    frames = {"orders": spark.createDataFrame([(i, f"c{i}", day(i), 5) for i in range(30)], ORDERS), "refunds": spark.createDataFrame([(3, day(4), 1)], REFUNDS)}
    done = []
    rules = LedgerRules(RULES.keys, RULES.orders, small_chain, orders_per_part=10, email_buckets=4, chain_done=lambda: done.append(sorted(os.listdir(f"{tmp_path}/run0"))))
    ledger = refresh_ledger(spark, f"{tmp_path}/shop", f"{tmp_path}/run0", frames, rules)
    assert len(done) == 1 and {"rows", "touched_orders", "touched_refunds"} <= set(done[0])  # told once, when the chain's rows are written
    assert not os.path.exists(f"{tmp_path}/run0") and ledger.count() == 31


def test_a_run_that_broke_off_at_its_end_can_be_repeated(spark, tmp_path, monkeypatch):
    from ledgerlake.plans import incremental

    def slices(orders):
        return {"orders": spark.createDataFrame(orders, ORDERS), "refunds": spark.createDataFrame([(3, day(4), 1)], REFUNDS)}

    base = [(i, f"c{i % 9}", day(i), 5) for i in range(30)]
    root, plain_drop, dropped = f"{tmp_path}/shop", incremental.drop_path, []
    refresh_ledger(spark, root, f"{tmp_path}/run0", slices(base), RULES)
    new = [(0, "c0", day(50), 7), (40, "c1", day(0), 2)]  # the first orders of c0 and c1 change

    def breaks(spark, path):
        dropped.append(path)
        if len(dropped) == 6:
            raise RuntimeError("lost")
        plain_drop(spark, path)

    monkeypatch.setattr(incremental, "drop_path", breaks)
    try:
        refresh_ledger(spark, root, f"{tmp_path}/run1", slices(new), RULES)
        raise AssertionError("it should have broken off")
    except RuntimeError:
        assert all(p.endswith("/_SUCCESS") for p in dropped[2:])  # no stage goes while it looks finished
    monkeypatch.setattr(incremental, "drop_path", plain_drop)
    ledger = refresh_ledger(spark, root, f"{tmp_path}/run1", slices(new), RULES)
    orders = {o[0]: o for o in [*base, *new]}
    assert shown(ledger) == plain(orders, {3: [(3, day(4), 1)]})


def test_a_write_drops_its_own_shuffles(spark, tmp_path):
    import time

    from ledgerlake.session import _CLEANUP, own_shuffles_dropped
    from ledgerlake.sources.sinks import staged

    def files():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    before = files()
    written = staged(spark.range(1000).repartition(4, "id"), f"{tmp_path}/t")
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and written.count() == 1000
    with own_shuffles_dropped(spark), own_shuffles_dropped(spark):
        assert spark.conf.get(_CLEANUP) == "true"
    assert spark.conf.get(_CLEANUP) == "false"
