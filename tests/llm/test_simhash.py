import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import simhash
from ledgerlake.llm.components import components
from tests.llm import brute


def test_fingerprints_and_groups_equal_brute_force(documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.groups(prints)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert got == {d: (p, rows[g][0]) for (d, _), p, g in zip(rows, prints, root)}
    assert any(c != d for d, (_, c) in got.items())


@pytest.mark.parametrize("radius,bits", [(1, 64), (3, 64), (3, 30), (3, 14)])
def test_any_differing_bits_are_absent_from_some_mask(radius, bits):
    rng, at = random.Random(1), list(range(64 - bits, 64))
    masks = simhash.covering_masks(at, radius)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(at, radius))
        assert any(not m & diff for m in masks)


@pytest.mark.parametrize("split", [2048, 4])
def test_links_connect_what_brute_force_connects(spark, split):
    rng = random.Random(split)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):  # chains of near prints, among them large dense groups
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 60])):
            prints.add(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(nodes, split=split)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 3 for a, b in found.collect())
    root = {r.node: r.root for r in components(found).collect()}
    want = brute.groups(prints)
    got = [root.get(s, s) for s in signed]
    same = {}
    for g, w in zip(got, want):
        assert same.setdefault(g, w) == w
    assert len(set(got)) == len(set(want))


def test_components_of_long_chains_hubs_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n for n, r in got.items() if r == 0} >= set(range(1, 41)) and got[139] == 100 and got[201] == 200
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def test_a_hub_with_most_of_all_edges(spark):
    """Half of all rows on one node: its rows of the join are split (the aggregate beside them is landed)."""
    edges = spark.range(40_000).selectExpr("IF(id % 2 = 0, 0, id * 3) AS a", "id * 3 + 1 AS b")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(old, ("16k", "16k", "-1", "1.5")):
            spark.conf.set(k, v)
        both = edges.select("a", "b")
        from ledgerlake.llm.common import landed

        joined = landed(both).join(landed(both.groupBy("a").agg(F.min("b").alias("m"))), "a").where("b > m")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        got = components(edges)
        assert got.where("root = 0").count() == 20_000 + got.where("node = 0").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_odd_rows(make_docs):
    long = " ".join(f"w{i}" for i in range(50_000))
    docs = make_docs([(5, None), (3, " \n\t"), (9, ""), (7, "One Two"), (8, "one two"), (8, "one two"), (1, long), (2, long), (None, "one two"), (None, None)])
    docs = docs.withColumn("fp", docs.n_chars).withColumn("component_id", docs.source)  # clashing names
    got = simhash.near_duplicates(docs)
    rows = [(r.doc_id, r.component_id) for r in got.collect()]
    assert len(rows) == 10 and set(rows) == {(5, 3), (3, 3), (9, 3), (7, 7), (8, 7), (1, 1), (2, 1), (None, 7), (None, 3)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]


def test_groups_without_ids_and_repeated_ids(make_docs):
    docs = make_docs([(None, "alpha beta gamma"), (None, "alpha beta gamma"), (4, "x y z"), (4, "x y z"), (4, "p q r s t")])
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [("4", "p q r s t"), ("4", "x y z"), ("None", "alpha beta gamma")]  # an id may stand in two groups
    assert all(r.source is None for r in simhash.keep_one(docs).collect())
    twice = make_docs([(2, "a b c d e", "en", "t"), (1, "q r s t u", "en", "z"), (1, "a b c d e", "en", "s"), (1, "a b c d e", "de", "t"), (3, "q r s t u")])
    kept = sorted((r.doc_id, r.text, r.lang, r.source) for r in simhash.keep_one(twice).collect())
    assert kept == [(1, "a b c d e", "de", "t"), (1, "q r s t u", "en", "z")]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0
