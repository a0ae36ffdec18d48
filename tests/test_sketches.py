from pyspark.sql import functions as F

from ledgerlake.plans import sketches as sk


def test_states_of_days_give_weeks_within_the_bound(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("CAST(id % 14 AS INT) AS day", "xxhash64(id % 20000, IF(id % 14 = 3, 0, 1)) AS who", "IF(id % 3 = 0, 'hot', 'x') AS k")
    sk.write_distinct_states(rows, f"{tmp_path}/s", "day", "who", ["k"])
    week = F.floor(F.col("day") / 7)
    got = {(r.period, r.k): r.estimate for r in sk.distinct_over(sk.read_states(spark, f"{tmp_path}/s"), week, ["k"]).collect()}
    want = {(r.period, r.k): r.n for r in rows.groupBy(week.alias("period"), "k").agg(F.count_distinct("who").alias("n")).collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - n) <= sk.distinct_error() * n for x, n in want.items())
    one = sk.read_states(spark, f"{tmp_path}/s", 3, 3)
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString() and one.select("day").distinct().collect()[0][0] == 3
    sk.write_distinct_states(rows.where("day = 3").limit(0).unionByName(spark.createDataFrame([(3, 1, "x")], rows.schema)), f"{tmp_path}/s", "day", "who", ["k"])
    again = sk.distinct_over(sk.read_states(spark, f"{tmp_path}/s"), F.col("day"), ["k"]).where("period = 3").collect()
    assert [(r.k, r.estimate) for r in again] == [("x", 1)]  # the day was replaced, the others stand


def test_top_of_combined_states(spark, tmp_path):
    rows = [(p, c, v) for p in (1, 2, 3) for c, vs in {"a": "xxy", "b": "yz", "c": "q"}.items() for v in vs] + [(1, "n", None), (2, "n", "w")]
    sk.write_top_states(spark.createDataFrame(rows, "part int, c string, v string"), f"{tmp_path}/t", "part", "v", ["c"])
    got = {r.c: (r.top, r.top_count, r.n_rows) for r in sk.top_over(sk.read_states(spark, f"{tmp_path}/t"), ["c"]).collect()}
    assert got["a"] == ("x", 6, 9) and got["b"] == ("y", 3, 6) and got["c"] == ("q", 3, 3) and got["n"][2] == 2
