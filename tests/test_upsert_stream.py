import random

import pytest

from ledgerlake.streaming import newest_versions, upsert_stream, upserted

SCHEMA = "a long, b string, at long, v double"


def shown(df):
    return sorted((tuple(r) for r in df.select("a", "b", "at", "v").collect()), key=str)


def test_runs_and_restart_equal_the_batch_answer(spark, tmp_path):
    rng, landed, told = random.Random(5), [], []
    paths = {x: f"{tmp_path}/{x}" for x in ("landing", "table", "checkpoint")}

    def run(**more):
        upsert_stream(spark, paths["landing"], SCHEMA, paths["table"], paths["checkpoint"], ["a", "b"], "at", buckets=8, on_batch=lambda i, b: told.append(sorted(b)), **more)

    def land(rows):
        landed.extend(rows)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(paths["landing"])

    def right():
        assert shown(upserted(spark, paths["table"], SCHEMA)) == shown(newest_versions(spark.createDataFrame(landed, SCHEMA), ["a", "b"], "at"))

    land([(rng.randrange(60), rng.choice(["x", None]), rng.choice([None, *range(9)]), float(i)) for i in range(300)])
    run()
    right()
    land([(i, "x", 1000 + i, 0.5) for i in range(0, 60, 9)] + [(None, None, 1, 1.0)])
    land([(7, "x", -10**6, 9.0)])  # older than anything seen: held back by nothing, changes nothing
    run(max_files_per_trigger=1)  # two batches
    right()
    before = len(told)
    land([(i, "x", -5, 1.0) for i in range(60) if any(r[:2] == (i, "x") and (r[2] or -1) >= 0 for r in landed)])
    run()
    right()
    assert told[before:] == [[]]  # nothing newer: no bucket was rewritten

    class Down(Exception):
        pass

    def fail(number, buckets):
        raise Down

    land([(1, "x", 5000, 1.0), (2, None, 5000, 2.0)])
    with pytest.raises(Exception, match="Down"):  # the batch merges, then the driver goes down before it is committed
        upsert_stream(spark, paths["landing"], SCHEMA, paths["table"], paths["checkpoint"], ["a", "b"], "at", buckets=8, on_batch=fail)
    land([(3, "x", 5000, 3.0)])
    run()
    right()


def test_plan_has_no_python(spark, tmp_path):
    rows = spark.createDataFrame([], SCHEMA)
    assert "Python" not in newest_versions(rows, ["a"], "at")._jdf.queryExecution().executedPlan().toString()
