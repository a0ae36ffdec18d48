import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import (
    bucket,
    json_array,
    json_scalar,
    local_date,
    pct_change,
    ratio,
    regex_first,
    row_to_json,
    strip_json_quotes,
    title_case,
    trim_ws,
)
from ledgerlake.plans.customer import POSTAL_AREA


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_trim_ws_strips_all_whitespace(spark):
    out = one(spark, trim_ws("s"), [("\t a b \n",), (None,)], "s string")
    assert out == ["a b", None]


def test_title_case_uses_punctuation_delimiters(spark):
    out = one(spark, title_case("s"), [("foo-bar baz",), ("O'NEIL_x",), ("",), (None,)], "s string")
    assert out == ["Foo-Bar Baz", "O'neil_X", "", None]  # apostrophe is not a delimiter


def test_json_scalar_rejects_containers_and_bad_json(spark):
    data = [('{"a": 1, "o": {"b": 2}, "s": "GBP"}',), ("not json",), (None,)]
    df = spark.createDataFrame(data, "j string")
    got = df.select(json_scalar("j", "$.a"), json_scalar("j", "$.o"), json_scalar("j", "$.s")).collect()
    assert [tuple(r) for r in got] == [("1", None, "GBP"), (None, None, None), (None, None, None)]


def test_json_array_empty_on_null_or_malformed(spark):
    out = one(spark, F.size(json_array("j")), [('[{"a":1},{"a":2}]',), ("[]",), ("oops",), (None,)], "j string")
    assert out == [2, 0, 0, 0]


def test_strip_json_quotes(spark):
    assert one(spark, strip_json_quotes("c"), [('"GBP"',), ("GBP",), (' "EUR" ',)], "c string") == ["GBP", "GBP", "EUR"]


def test_local_date_summer_and_winter(spark):
    data = [(dt.datetime(2024, 6, 30, 23, 30),), (dt.datetime(2024, 1, 31, 23, 30),)]
    out = one(spark, local_date("t", "Europe/London"), data, "t timestamp_ntz")
    assert out == [dt.date(2024, 7, 1), dt.date(2024, 1, 31)]


def test_postal_area_golden(spark):
    data = [("SW1A 1AA",), ("G1 1AA",), ("G11AA",), ("g1 1aa",)]
    assert one(spark, regex_first("z", POSTAL_AREA), data, "z string") == ["SW1A", "G1", "G11A", None]


def test_pct_change_rules(spark):
    df = spark.createDataFrame([(0, 0), (5, 0), (1, 2), (9, 8), (0, 3)], "t int, y int")
    got = [r[0] for r in df.select(pct_change("t", "y")).collect()]
    assert got == [0.0, 100.0, -50.0, 12.0, -100.0]


def test_ratio_guards_zero(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 4)], "a double, b int")
    assert [r[0] for r in df.select(ratio("a", "b", digits=2)).collect()] == [None, 2.5]


def test_bucket_first_match_wins(spark):
    tiers = [(500, "A"), (200, "B")]
    out = one(spark, bucket("v", tiers, "C"), [(600.0,), (500.0,), (250.0,), (10.0,), (None,)], "v double")
    assert out == ["A", "A", "B", "C", "C"]


def test_row_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(row_to_json()).collect()[0][0] == '{"a":1,"b":null}'


def test_json_elements_scalar_and_document_rules(spark):
    from ledgerlake.functions import json_elements, json_query, json_value

    data = [('[{"title": {"x": 1}, "rate": 0.2, "doc": {"b": [1, 2.50], "a": "\\u0031"}}, {"title": "{not json", "rate": "7", "doc": null}]', 1),
            ("not json", 2), (None, 3), ('[{"doc": 1, "doc": 2}]', 4)]
    e = json_elements(spark.createDataFrame(data, "value string, key int"), "value", "pos")
    assert e.columns == ["key", "pos"]
    got = [tuple(r) for r in e.select("key", json_value("pos", "$.title"), json_value("pos", "$.rate"), json_query("pos", "$.doc")).collect()]
    # an object in a scalar field is NULL (JSON_VALUE); text that only starts with "{" is kept; docs stay JSON text
    assert got == [(1, None, "0.2", '{"a":"1","b":[1,2.50]}'), (1, "{not json", "7", None)]


def test_json_is_parsed_once_a_row_and_not_shuffled(spark):
    from ledgerlake.functions import json_elements, json_value

    df = spark.createDataFrame([("[]", 1)], "j string, k int")
    e = json_elements(df, "j").select("k", *[json_value("element", f"$.f{i}").alias(f"f{i}") for i in range(6)])
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "Exchange" not in plan and "Join" not in plan

def test_json_numbers_are_marked_in_one_pass(spark):
    from ledgerlake.functions.json import json_document, json_query

    texts = {
        '{"a": -1.50e+3, "b\\"1": [1, "2", 0.10, {"c": -0}], "d": "x 7 \\\\"}': '{"a":-1.50e+3,"b\\"1":[1,"2",0.10,{"c":-0}],"d":"x 7 \\\\"}',
        "12": "12", '"12"': "12", "[]": "[]", " [ 1 , 2 ] ": "[1,2]",
        "[01]": None, "[1 2]": None, "[- 1]": None, '["a 1]': None, '["1", 01, "x]': None, "[1.]": None, '[\\"1\\"]': None, "[1": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", json_query(json_document("t")).alias("q"))
    assert {r.t: r.q for r in df.collect()} == texts
    marked = spark.range(1).select(json_document(F.col("id").cast("string")).alias("d"))._jdf.queryExecution().analyzed().toString()
    assert marked.count("replace(") == 4 and marked.count("regexp_replace(") == 1  # three of odd characters, one of numbers
