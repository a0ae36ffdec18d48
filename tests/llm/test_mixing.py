import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing, queries
from tests.llm import brute


def test_equals_brute_force(documents):
    rows = [(r.doc_id, r.source, len(brute.WORD.findall(r.text))) for r in documents.collect()]
    want = dict(zip((r[0] for r in rows), brute.mixed(rows)))
    got = mixing.mix(documents).select("doc_id", "mix.*").collect()
    assert len(got) == len(rows)
    for r in got:
        size, target, taken, copies = want[r.doc_id]
        assert (r.source_size, r.taken, len(r.copies)) == (size, taken, copies) and r.target == pytest.approx(target, rel=1e-12)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(sum(t) == int(target) for (_, target), t in by.items())


def test_targets_stop_and_share_the_excess(spark):
    sizes = {"a": 10, "b": 1, "c": 0, "d": 5, "é": 2, None: 50}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (1.0, 2.0, 3.0))
    want = brute.targets(sizes)
    assert {r.source: r.target for r in got.collect()} == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_positions_follow_the_schedule(make_docs):
    # the first source fades out, the second fades in; equal integrals
    docs = make_docs([(i, "w " * 10, "en", "ab"[i % 2]) for i in range(400)])
    rows = mixing.mix(docs, cycle=[[(0, 1), (1, 0)], [(0, 0), (1, 1)]]).select("source", F.col("mix.copies.position")[0].alias("t"), "mix.taken").collect()
    early = [r.t for r in rows if r.source == "a"], [r.t for r in rows if r.source == "b"]
    assert sum(early[0]) / 200 == pytest.approx(1 / 3, abs=0.02) and sum(early[1]) / 200 == pytest.approx(2 / 3, abs=0.02)
    for t in sorted(early[0])[::20]:  # demand 2t - t^2
        assert sum(x < t for x in early[0]) / 200 == pytest.approx(2 * t - t * t, abs=0.01)
    assert all(0 <= x < 1 for x in early[0] + early[1])


def test_steps_and_pauses_of_a_schedule(make_docs):
    docs = make_docs([(i, "w " * 5, "en", "a") for i in range(100)])
    step = [(0, 0), (0.5, 0), (0.5, 2), (1, 2)]
    ts = [r.t for r in mixing.mix(docs, cycle=[step]).select(F.col("mix.copies.position")[0].alias("t")).collect()]
    assert min(ts) >= 0.5 and max(ts) < 1


def test_the_production_mix_changes_over_time(make_docs):
    assert [mixing.integral(x) for x in mixing.CYCLE] == [1.0, 2.0, 3.0]
    docs = make_docs([(i, "w " * 10, "en", "abc"[i % 3]) for i in range(900)])
    order = [r.source for r in mixing.stream(docs).collect()]
    share = lambda part, s: part.count(s) / len(part)
    third = len(order) // 3
    first, middle, last = order[:third], order[third : 2 * third], order[2 * third :]
    assert share(first, "a") < share(middle, "a") < share(last, "a") and share(first, "c") > share(last, "c")
    assert share(middle, "b") > max(share(first, "b"), share(last, "b"))


def test_op4_rows_stand_in_training_order(spark, make_docs, tmp_path):
    docs = make_docs([(i, "w " * 10, "en", "abc"[i % 3]) for i in range(300)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    first = {r.doc_id: r.t for r in mixing.mix(docs).select("doc_id", F.get("mix.copies.position", F.lit(0)).alias("t")).collect()}
    rows = queries.op4_mixing(spark, str(tmp_path)).collect()
    placed = [r.position for r in rows if r.position is not None]
    assert [r.position for r in rows[: len(placed)]] == sorted(placed) and len(rows) == 300
    assert all((r.position is not None) == (r.taken > 0) for r in rows)
    assert all(first[r.doc_id] in (None, r.position) for r in rows) and any(first.values())


def test_stream_repeats_and_orders(make_docs):
    docs = make_docs([(i, "w " * 10, "en", "abc"[i % 3]) for i in range(90)] + [(500, None, "en", "a"), (501, "", "en", "a")])
    n = {r.doc_id: len(r.copies) for r in mixing.mix(docs).select("doc_id", "mix.copies").collect()}
    out = mixing.stream(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: c for d, c in n.items() if c} and max(n.values()) > 1 and n[500] == n[501] == 0


def test_odd_rows(make_docs):
    docs = make_docs([(1, "a b", "en", None), (None, "a b c", "en", "s"), (2, "x", "en", "s"), (2, "x", "en", "s"), (3, None, None, None)])
    docs = docs.withColumn("mix", F.lit(1)).withColumn("slot", F.lit(2)).withColumn("_n", F.lit(3)).withColumn("target", F.lit(4))
    out = mixing.mix(docs)
    assert out.columns[-1] == "mix_" and out.count() == 5
    rows = out.select("doc_id", "source", "mix_.*").collect()
    assert all(r.taken <= 3 * r.size for r in rows) and sum(r.taken for r in rows) == 2 + 4  # targets 7/3 and 14/3
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3)).select("doc_id", "source", "mix_.*").collect()))
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.stream(docs.limit(0)).count() == 0
