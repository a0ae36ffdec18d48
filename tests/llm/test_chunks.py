import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import chunks


def check(docs, rows):
    """``rows`` (doc_id, text) in order."""
    got = {}
    for r in chunks.compare_with_edits(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        f, e, n = (chunks.fingerprint(x) for x in (t, edited, after))
        want = (len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, chunks.containment(chunks.read(f), chunks.read(e)), chunks.containment(chunks.read(f), chunks.read(n)))
        assert want in [tuple(r)[1:] for r in got[d]]
    assert sum(map(len, got.values())) == len(rows)


def test_equals_brute_force(documents):
    check(documents.repartition(5), sorted((r.doc_id, r.text) for r in documents.collect()))


def test_candidates_do_not_depend_on_blocks(monkeypatch):
    data = random.Random(1).randbytes(5000)
    whole = chunks._candidates(data)
    monkeypatch.setattr(chunks, "_BLOCK", 333)
    assert chunks._candidates(data) == whole


def test_chunks_survive_shifts(documents):
    for r in documents.where("n_chars > 3000").limit(10).collect():
        a = chunks.read(chunks.fingerprint(r.text))
        b = chunks.read(chunks.fingerprint("Some new words before. " + r.text[:1500] + " inserted " + r.text[1500:]))
        assert chunks.containment(a, b) > 0.9 and chunks.containment(a, a) == 1
    ends = chunks.boundaries([b"ab" * 5000, b"", b"x"])
    assert all(16 <= e - s <= 128 for s, e in zip([0, *ends[0]], ends[0][:-1])) and ends[1:] == [[], [1]]


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "abc"), (4, "é" * 9000), (7, "same words here " * 9), (7, "same words here " * 9), (8, "other"), (None, "last one of all")]
    docs = make_docs(rows).withColumn("part", F.lit("x")).withColumn("last", F.lit(1))
    check(docs, rows)
    check(make_docs([(5, "a single document, followed by itself")]), [(5, "a single document, followed by itself")])
    check(make_docs([(None, "b"), (None, "a")]), [(None, "a"), (None, "b")])
    assert chunks.compare_with_edits(docs.limit(0)).count() == 0
    assert chunks.containment({}, {}) == 1 and chunks.containment({}, {1: 2}) == 0


def test_ids_that_are_no_integers_are_refused(spark):
    with pytest.raises(TypeError):
        chunks.compare_with_edits(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
