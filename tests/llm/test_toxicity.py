import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity
from ledgerlake.llm.common import held_out, table


def made(make_docs, n=600):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=8)) for _ in range(rng.randint(2, 9))]
        toxic = int(i % 8 == 0)
        if toxic:
            at = rng.randrange(len(parts))
            parts[at] = f"you are a {rng.choice(['zzidiot', 'zzmoron', 'zztrash'])} my friend"
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, toxic))
    return make_docs(rows), labels


def test_offending_sentences_are_found_from_document_labels(spark, make_docs):
    docs, labels = made(make_docs)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ~held_out(F.col("doc_id")))
    texts, toxic = {r.doc_id: r.text for r in docs.collect()}, dict(labels)
    for r in toxicity.score(docs, model).collect():
        assert (r.score >= 0.3) == bool(toxic[r.doc_id])
        assert ["zz" in texts[r.doc_id][s.start : s.end] for s in r.offending] == [True] * toxic[r.doc_id]


@pytest.mark.parametrize("percent", [40, 60])
def test_many_toxic_labels_leave_a_vocabulary(spark, make_docs, percent):
    rng = random.Random(percent)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    rows, toxic = [], {}
    for i in range(600):
        parts = [" ".join(rng.choices(words, k=8)) for _ in range(rng.randint(2, 9))]
        toxic[i] = int(i % 100 < percent)
        if toxic[i]:
            parts[rng.randrange(len(parts))] = f"you are a {rng.choice(['zzidiot', 'zzmoron', 'zztrash'])} my friend"
        rows.append((i, ". ".join(parts) + "."))
    docs = make_docs([*rows, (9000, "abcde fgabc. " * 400)])
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels, ~held_out(F.col("doc_id")))).collect()}
    assert all((got[i] >= 0.3) == bool(toxic[i]) for i in toxic) and got[9000] < 0.3


def test_long_texts_without_evidence_are_clean(spark, make_docs):
    docs = make_docs([(1, "calm words here. " * 1000)])
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels, F.lit(True))).first().score < 1e-6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels, ~held_out(F.col("doc_id")))
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    hit = sum(r.score >= 0.3 and r.toxic == 1 for r in rows)
    said, true = sum(r.score >= 0.3 for r in rows), sum(r.toxic for r in rows)
    assert hit >= 0.9 * said and hit >= 0.6 * true and len(rows) > 60


def test_score_is_the_noisy_or_of_all_sentences(spark, make_docs):
    model = (-3.0, {"=bad": 4.0, "=ugly": 2.0})
    docs = make_docs([(1, "Bad day. Nice day.\nbad ugly bad!"), (2, "calm")])
    p = lambda z: 1 / (1 + np.exp(-z))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert abs(got[1] - (1 - (1 - p(1)) * (1 - p(-3)) * (1 - p(3)))) < 1e-12 and abs(got[2] - p(-3)) < 1e-12


def test_gradient_of_the_fit():
    import pyarrow as pa

    rows = [{"toxic": int(i % 3 == 0), "n_sentences": 5, "sent": [0, 1] if i % 3 == 0 else [], "feat": [0, i % 2] if i % 3 == 0 else []} for i in range(60)]
    schema = pa.schema([("toxic", pa.int32()), ("n_sentences", pa.int32()), ("sent", pa.list_(pa.int32())), ("feat", pa.list_(pa.int32()))])
    bias, weights = toxicity.fit(pa.Table.from_pylist(rows, schema), 2)
    assert weights[0] > 3 and bias < -3 and toxicity.fit(schema.empty_table(), 4)[1].tolist() == [0] * 4


def test_the_sample_is_bounded_and_ignores_held_out_rows(spark, make_docs):
    docs, labels = made(make_docs, 200)
    frame = spark.createDataFrame(labels + [(1, 1), (None, 1), (900, 0), (5, None)], "doc_id long, toxic int")
    assert toxicity.training_sample(docs, frame, ~held_out(F.col("doc_id")), 50).count() == 50
    texts = {r.text: r.toxic for r in toxicity.training_sample(docs, frame, F.lit(True)).collect()}
    by = {r.doc_id: r.text for r in docs.collect()}
    assert len(texts) == 200 and texts[by[1]] == 1


def test_odd_rows(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, " .!? \n"), (None, "word"), (4, "w " * 50_000), (4, "w " * 50_000)]).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1)], "doc_id long, toxic int")
    for frame in (labels, labels.limit(0)):
        got = toxicity.score(docs, toxicity.train(docs, frame, F.lit(True))).collect()
        assert len(got) == 6 and all(0 <= r.score < 0.3 for r in got)
        assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    assert toxicity.score(docs.limit(0), (-6.0, {})).count() == 0
