import math
import re

import numpy as np
import pytest

from ledgerlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    """Every document scored for every item."""
    words = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    asked, df = {}, {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = set()
    for i, query in asked.items():
        scores = []
        for r, (d, w) in enumerate(words):
            m = 10 + (90 * len(w) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in query if t in w)
            if s > 0:
                scores.append((-s, d is None, d or 0, r))
        out |= {(i, rank, None if none else d, -s) for rank, (s, none, d, _) in enumerate(sorted(scores)[:k], 1)}
    return out


def found(spark, docs, items, **more):
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = lexical.search(d.repartition(3).withColumn("item_id", d.doc_id), i.selectExpr("*", "1 AS rank", "2 AS doc_id"), **more).collect()
    assert len(rows) == len({(r.item_id, r.rank) for r in rows})
    return {tuple(r) for r in rows}


def test_terms():
    for text in ("Don't STOP é2É\x00a\x7fb_c—d", "", " \t", "日本語 ÀB1"):
        assert [t.decode() for t in lexical.terms(text.encode())] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("block", [7, 4096])
def test_best_documents(spark, monkeypatch, block):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = 1 / np.arange(1, 61)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))
    docs = [(i, text(rng.integers(1, 60))) for i in range(300)] + [(1000 + i, "w7 w9 rare") for i in range(40)]
    items = [(i, text(8)) for i in range(12)] + [(50, "w7 w9"), (51, "rare w1"), (52, "unheard of")]
    monkeypatch.setattr(lexical, "_BLOCK_DOCS", block)
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, query_bytes=40, k=3) == plain(docs, items, 3)


def test_left_out_documents_cannot_reach_the_best():
    rng = np.random.default_rng(9)
    stopped = 0
    for _ in range(300):
        n, k = int(rng.integers(1, 40)), int(rng.integers(1, 5))
        lists, total = {}, np.zeros(n, np.int64)
        for t in range(6):
            docs = np.flatnonzero(rng.random(n) < 0.15 * (t + 1)).astype(np.int32)
            part = rng.integers(0, 4 ** (6 - t), len(docs))
            if len(docs):
                lists[t] = docs, part
                total[docs] += part
        want = [(int(total[d]), int(d)) for d in np.lexsort((np.arange(n), -total))[:k] if total[d] > 0]
        assert lexical.best(list(range(6)), lists, n, k) == want
        if len(want) == k:  # a floor as high as the k-th score still finds all that reach it
            assert lexical.best(list(range(6)), lists, n, k, want[-1][0]) == want
        stopped += len(lists) > 2
    assert stopped > 200


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (4, "a b"), (4, "a b"), (None, "a b"), (None, "a"), (5, "a " * 50_000), (6, "c")]
    items = [(1, "A"), (1, "b"), (2, None), (None, "c C c"), (3, "..."), (4, "zzz")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "q")], "doc_id string, text string")
    got = lexical.search(docs, spark.createDataFrame([("i", "x")], "item_id string, text string")).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [("i", 1, "a"), ("i", 2, "b"), ("i", 3, None)]
