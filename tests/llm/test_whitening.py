import math

import numpy as np
import pytest

from ledgerlake.llm import whitening


def check(rows, vectors, most=32):
    """``rows`` hold, against a plain whitening of ``vectors`` (id, entries), repeated ids included."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in vectors])
    n, s = len(x), x.sum(0)
    centred = (n * x - s) / n
    v = centred.T @ centred / n
    e = np.linalg.eigvalsh(v)[::-1]
    k = min(most, len(e))
    assert len(rows) == n * k
    want = sorted((i, int(((n * a - s) ** 2).sum())) for (i, _), a in zip(vectors, x))
    got = {}
    for r in rows:
        assert r.n == n and r.identity_error == rows[0].identity_error < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(v), rel=1e-9)
        got.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
    assert sorted(got) == list(range(1, k + 1))
    _, directions = np.linalg.eigh(v)
    for c, values in got.items():
        assert sorted((i, d) for i, d, _ in values) == want
        order = sorted(range(n), key=lambda r: (vectors[r][0], int(((n * x[r] - s) ** 2).sum())))
        a, b = np.array([w for _, _, w in sorted(values)]), (centred @ directions[:, -c] / math.sqrt(e[c - 1]))[order]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    w = np.array([[w for _, _, w in sorted(got[c])] for c in sorted(got)])
    assert np.abs(w @ w.T / n - np.eye(k)).max() < 1e-9


def test_given_vectors(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    check(whitening.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLS", 4)
    monkeypatch.setattr(whitening, "_SPLIT_BLOCKS", 2)
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.normal(size=10) * np.arange(1, 11)).tolist()) for i in range(230)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    check(whitening.whiten(df, most=6).collect(), vectors, 6)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=3)]) for i in range(40)]
    good += [(7, good[7][1]), (7, [0.5, 0.25, -3.0]), (None, [0.1, 0.2, 0.3]), (90, [2.0**40, -1e9, 3.0])] + [(91, [1.0, 1.0, 1.0])] * 60
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0]), (106, [1e300, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + bad, schema).repartition(3).selectExpr("*", "vec_id AS n", "'x' AS component")
    rows = whitening.whiten(df).collect()
    n = len(good)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], object)
    exact = sorted((i is None, i or 0, d if d < 1 << 63 else None) for (i, _), d in zip(good, ((n * x - x.sum(0)) ** 2).sum(1).tolist()))
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    assert sorted(((r.vec_id is None, r.vec_id or 0, r.deviation) for r in rows if r.component == 1), key=key) == sorted(exact, key=key)
    plain = [g for g in good if g[0] is not None and g[0] != 90]
    check(whitening.whiten(spark.createDataFrame(plain + bad, schema)).collect(), plain)
    for few in ([], bad[:4], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 9):
        assert whitening.whiten(spark.createDataFrame(few, schema)).collect() == []


def test_directions_without_variance_are_none(spark):
    vectors = [(f"v{i}", [float(i), float(2 * i), 5.0]) for i in range(30)]
    rows = whitening.whiten(spark.createDataFrame(vectors, "vec_id string, embedding array<float>")).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 30 and rows[0].explained == pytest.approx(1)
