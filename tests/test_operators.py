import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import (
    first_per_key,
    flatten_structs,
    key_totals_beside_rows,
    label_columns,
    latest_per_key,
    neighbour_value,
    normalise_timestamps,
    override_types,
    select_fields,
    union_all,
    zero_fill_daily,
)
from ledgerlake.operators.joins import is_in, not_in
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A frame where one key holds a third of the rows, with ties on the order column."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 200)
        data.append((k, rnd.randint(0, 50), i, rnd.random()))
    return spark.createDataFrame(data, "k int, t int, id int, v double")


def test_latest_per_key_matches_row_number(spark, skewed):
    w = Window.partitionBy("k").orderBy(F.desc("t"), F.desc("id"))
    expected = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = latest_per_key(skewed, ["k"], ["t", "id"])
    assert got.columns == skewed.columns
    assert rows(got) == rows(expected)


def test_first_per_key_matches_row_number(spark, skewed):
    w = Window.partitionBy("k").orderBy("t", "id")
    expected = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(first_per_key(skewed, ["k"], ["t", "id"])) == rows(expected)


def test_latest_per_key_missing_key_fails_fast(spark, skewed):
    with pytest.raises(ValueError):
        latest_per_key(skewed, ["nope"], ["t"])


@pytest.mark.parametrize("direction,fn", [("next", F.lead), ("prev", F.lag)])
@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_neighbour_value_matches_window(spark, skewed, direction, fn, ranges):
    w = Window.partitionBy("k").orderBy("t", "id")
    expected = skewed.withColumn("nb", fn("v").over(w))
    got = neighbour_value(skewed, ["k"], ["t", "id"], "v", "nb", direction=direction, num_ranges=ranges)
    assert rows(got, "k", "t", "id", "v", "nb") == rows(expected, "k", "t", "id", "v", "nb")


def test_neighbour_value_without_keys(spark, skewed):
    expected = skewed.withColumn("nb", F.lag("v").over(Window.orderBy("id")))
    got = neighbour_value(skewed, [], ["id"], "v", "nb", direction="prev", num_ranges=5)
    assert rows(got, "id", "nb") == rows(expected, "id", "nb")


def test_key_totals_beside_rows_includes_null_key_group(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (None, 4.0), (None, 1.0)], "k int, v double")
    got = key_totals_beside_rows(df, ["k"], {"tot": F.sum("v")})
    assert rows(got) == [(1, 2.0, 5.0), (1, 3.0, 5.0), (None, 1.0, 5.0), (None, 4.0, 5.0)]


def test_select_fields_last_match_wins(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a__x int, a__y int, b__x int, updated_time int")
    got = select_fields(df, ["*", "!a__*", "a__y", "!updated*", "updated_time"])
    assert got.columns == ["a__y", "b__x", "updated_time"]
    assert select_fields(df, ["!b__x"]).columns == ["a__x", "a__y", "updated_time"]


def test_flatten_and_label(spark):
    df = spark.createDataFrame([((1, (2, "z")),)], "r struct<a:int, b:struct<c:int, d:string>>")
    flat = flatten_structs(df)
    assert flat.columns == ["r__a", "r__b__c", "r__b__d"]
    lab = label_columns(flat, {"r__b__d": "Label", "r__a": "A"})
    assert lab.columns == ["Label", "A"] and lab.collect()[0] == ("z", 1)
    dotted = label_columns(flat, {"r__a": "results.A", "r__b__d": "results.D"})  # quoted names with dots (F29)
    assert dotted.orderBy("`results.A`").columns == ["results.A", "results.D"]
    assert dotted.select("`results.D`").collect()[0][0] == "z"


def test_override_types_json_and_cast(spark):
    df = spark.createDataFrame([("12.5", [1, 2])], "p string, arr array<int>")
    got = override_types(df, {"p": "double", "arr": "json"}).collect()[0]
    assert got == (12.5, "[1,2]")


def test_normalise_timestamps(spark):
    df = spark.createDataFrame([("2024-03-01T10:00:00+0000",), ("junk",)], "u string")
    got = [r[0] for r in normalise_timestamps(df, ["u"]).collect()]
    assert got[0].startswith("2024-03-01T10:00:00") and got[1] is None


def test_zero_fill_daily_per_key(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2), 5)], "k int, day date, n int")
    got = rows(zero_fill_daily(df, "day", ["n"], dt.date(2024, 1, 1), dt.date(2024, 1, 3), keys=["k"]))
    assert got == [(1, dt.date(2024, 1, 1), 0), (1, dt.date(2024, 1, 2), 5), (1, dt.date(2024, 1, 3), 0)]


def test_union_all_counts_add_up(spark, skewed):
    assert union_all([skewed, skewed, skewed]).count() == 3 * skewed.count()


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    no_null = spark.createDataFrame([(2,)], "k int")
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(not_in(left, no_null, "k", "k")) == [(1,)]
    assert rows(not_in(left, with_null, "k", "k")) == []
    assert rows(not_in(left, empty, "k", "k")) == [(1,), (2,), (None,)]
    assert rows(is_in(left, with_null, "k", "k")) == [(2,)]


@pytest.mark.parametrize("direction,fn", [("next", F.lead), ("prev", F.lag)])
def test_neighbour_value_with_many_ranges_and_null_order(spark, direction, fn):
    """More ranges than distinct keys, NULL order values, a key spanning many ranges."""
    rnd = random.Random(11)
    data = [(0 if i % 2 else rnd.randint(1, 5), None if i % 97 == 0 else rnd.randint(0, 10_000), i) for i in range(4000)]
    df = spark.createDataFrame(data, "k int, t int, id int").withColumn("v", F.col("id") * 2)
    w = Window.partitionBy("k").orderBy("t", "id")
    expected = df.withColumn("nb", fn("v").over(w))
    got = neighbour_value(df, ["k"], ["t", "id"], "v", "nb", direction=direction, num_ranges=64)
    assert rows(got, "k", "t", "id", "nb") == rows(expected, "k", "t", "id", "nb")


def test_neighbour_value_default_ranges_with_adaptive_coalescing(spark, skewed):
    """Default range count: adaptive execution may merge small ranges; results stay exact."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        w = Window.partitionBy("k").orderBy("t", "id")
        expected = skewed.withColumn("nb", F.lead("v").over(w))
        got = neighbour_value(skewed, ["k"], ["t", "id"], "v", "nb")
        assert rows(got, "k", "t", "id", "nb") == rows(expected, "k", "t", "id", "nb")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_salted_join_equals_the_plain_join_and_spreads_the_hot_key(spark):
    from ledgerlake.operators import heavy_hitters, salted_join

    left = spark.range(4000).selectExpr("IF(id % 2 = 0, 7, id) AS k", "IF(id % 50 = 1, NULL, 'x') AS j", "id AS v")
    right = spark.createDataFrame([(7, "x", "hot"), (7, "x", "hot2"), (1, "x", "a"), (3, "x", "b"), (9000, "x", "none"), (None, "x", "null"), (55, None, "n")], "k long, j string, w string")
    hot = heavy_hitters(left, ["k", "j"])
    assert len(hot) == 1
    for how in ("inner", "left", "full"):
        got = salted_join(left, right, ["k", "j"], how, salts=8)
        want = left.join(right, ["k", "j"], how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), how
    with pytest.raises(ValueError):
        salted_join(left, right, ["k", "j"], "cross")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        sizes = [r[0] for r in salted_join(left, right, ["k", "j"], "left", salts=64).groupBy(F.spark_partition_id()).count().select("count").collect()]
        plain = [r[0] for r in left.join(right, ["k", "j"], "left").groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == sum(plain) and max(plain) > 4000 and max(sizes) < max(plain) / 3


def test_totals_beside_rows_let_a_hot_key_be_split(spark):
    from ledgerlake.operators import key_totals_beside_rows

    df = spark.range(20_000).selectExpr("IF(id % 2 = 0, 0, id) AS k", "id AS v")
    wanted = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        out = key_totals_beside_rows(df, ["k"], {"n": F.count(F.lit(1))})
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan and all(r.n == (10_000 if r.k == 0 else 1) for r in rows) and len(rows) == 20_000
