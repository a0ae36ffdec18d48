import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid
from ledgerlake.llm.common import held_out
from ledgerlake.llm.queries import op2_language


def test_held_out_accuracy(spark, sf_small, documents):
    true = {r.doc_id: r.lang for r in documents.collect()}
    got = op2_language(spark, sf_small).collect()
    assert len(got) == len(true)
    tested = [r for r in got if r.held_out]
    assert len(tested) > 20 and sum(r.lang_pred == true[r.doc_id] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_is_the_crc_of_the_id(spark):
    import zlib

    ids = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids)


def test_counts_and_scores_equal_a_plain_version(make_docs):
    texts = [("aba abc", "x"), ("ccc bca", "y"), ("abab", "x"), ("Ünï cøde", "y")]
    docs = make_docs([(i, t, lang) for i, (t, lang) in enumerate(texts)])
    langs, matrix = langid.train(docs)
    assert langs == ["x", "y"]

    def buckets(text):
        g, starts, _ = langid.grams([(0, text.lower(), len(text))])
        return [b for b in g.ravel().tolist() if b < langid.BUCKETS]

    counts = np.zeros((langid.BUCKETS, 2))
    for t, lang in texts:
        b = buckets(t)
        assert len(b) == sum(max(0, len(t) - n + 1) for n in langid.SIZES)
        np.add.at(counts[:, langs.index(lang)], b, 1)
    logs = np.log(counts + langid.ALPHA) - np.log(counts.sum(axis=0) + langid.ALPHA * langid.BUCKETS)
    for r in langid.predict(docs, (langs, matrix)).collect():
        s = np.log(np.array([2, 2]) / 4) + logs[buckets(texts[r.doc_id][0])].sum(axis=0)
        assert r.lang_pred == langs[s.argmax()] and abs(r.score - 1 / (1 + np.exp(s.min() - s.max()))) < 1e-9


def test_segments_cover_long_texts(monkeypatch):
    text = "the quick brown fox " * 50
    whole = np.sort(langid.grams([(0, text, len(text))])[0].ravel())
    monkeypatch.setattr(langid, "_BLOCK", 64)
    parts = np.sort(np.concatenate([langid.grams(b)[0].ravel() for b in langid._blocks([text])]))
    assert (whole[whole < langid.BUCKETS] == parts[parts < langid.BUCKETS]).all()


def test_too_many_languages_are_refused_before_they_are_collected(make_docs, monkeypatch):
    docs = make_docs([(i, f"text {i}", f"l{i}") for i in range(5)])
    monkeypatch.setattr(langid, "MAX_MODEL_CELLS", 4 * langid.BUCKETS)
    with pytest.raises(ValueError, match="more than 4"):
        langid.train(docs)
    assert len(langid.train(docs.where("doc_id < 4"))[0]) == 4


def test_odd_rows(make_docs):
    docs = make_docs([(1, "hello there", "en"), (2, "guten tag", "de"), (3, None, "en"), (4, "123 !?", "de"), (5, "\0x\0", None), (None, "hello", None), (1, "hello there", "en")])
    docs = docs.withColumn("score", F.lit("clash"))
    got = langid.identify(docs, F.lit(True)).collect()
    pred = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == 7 and pred[3] == pred[4] == ("und", 0.0) and pred[1][0] == pred[None][0] == "en" and pred[2][0] == "de"
    assert langid.identify(docs.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}
