import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import substrings
from tests.llm import brute


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    some = lambda n: " ".join(word() for _ in range(n))
    shared = [some(rng.randint(20, 90)) for _ in range(6)]
    rows = []
    for i in range(120):
        kind = i % 6
        if kind == 0:
            t = some(80)
        elif kind == 1:
            t = some(10) + rng.choice(shared) + some(10)  # a passage at any byte
        elif kind == 2:
            t = rows[rng.randrange(len(rows))][1]  # an exact copy
        elif kind == 3:
            t = rows[rng.randrange(len(rows))][1] or ""
            at = rng.randint(0, len(t))
            t = t[:at] + word() + t[at:]  # a near copy
        elif kind == 4:
            t = "x" * rng.choice([99, 100, 101, 350]) + some(3) + "ab" * rng.randint(40, 200)  # repeats inside
        else:
            t = rng.choice([None, "", "short", some(30) + shared[0] + shared[1][:150]])
        rows.append((i * 3, t))
    return rows


@pytest.mark.parametrize("crowded, flush", [(4096, 1 << 19), (1, 1 << 19), (0, 600)])
def test_equals_brute_force(make_docs, monkeypatch, crowded, flush):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    monkeypatch.setattr(substrings, "_FLUSH", flush)
    rows = corpus()
    want = brute.without_repeats(rows, 100)
    got = substrings.digest(substrings.deduplicate(make_docs(rows).repartition(7))).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(w[1] for w in want.values()) > 1000


def common_line(n, seed=4):
    rng = random.Random(seed)
    some = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    line = "one line that a third of all documents hold, word for word, wherever they come from and whatever they are about"
    return [(i, some(60) + line + some(60) if i % 3 == 0 else some(150)) for i in range(n)]


def test_a_common_line_moves_packed_and_in_proportion(spark, make_docs, monkeypatch):
    monkeypatch.setattr(substrings, "CROWDED", 50)
    sent = {}
    plain = substrings.map_partitions

    def counted(df, fn, schema):
        rows = spark.sparkContext.accumulator(0)

        def run(batches):
            for out in fn(batches):
                rows.add(out.num_rows)
                yield out

        made = plain(df, run, schema)
        sent.setdefault(fn.__qualname__, []).append(rows)
        return made

    monkeypatch.setattr(substrings, "map_partitions", counted)
    totals = []
    for n in (600, 1200):
        sent.clear()
        rows = common_line(n)
        got = {r.doc_id: tuple(r)[1:] for r in substrings.digest(substrings.deduplicate(make_docs(rows).repartition(4))).collect()}
        assert got == brute.without_repeats(rows, 100)
        totals.append({k: sum(a.value for a in v) for k, v in sent.items()})
    assert totals[0].keys() == totals[1].keys() and any("_by_range" in k for k in totals[0])
    for k, v in totals[1].items():
        assert v <= 2.5 * totals[0][k] + 40, k
        if "_by_range" in k and "first" in k:
            assert v < 1200 / 4


def test_ids_that_are_no_integers_are_refused(spark):
    with pytest.raises(TypeError):
        substrings.deduplicate(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_documents_equal_brute_force(documents):
    want = brute.without_repeats(sorted((r.doc_id, r.text) for r in documents.collect()), 100)
    assert {r.doc_id: tuple(r)[1:] for r in substrings.digest(substrings.deduplicate(documents)).collect()} == want


def test_spans_and_kept_bytes(make_docs):
    body = " ".join(f"word{i}" for i in range(60))
    rows = {r.doc_id: r for r in substrings.deduplicate(make_docs([(2, "é" + body + "end"), (1, body)])).collect()}
    assert rows[1].spans == [] and rows[2].spans == [(2, 2 + len(body))] and bytes(rows[2].kept) == "éend".encode()


def test_multikey_quicksort_finds_equal_suffixes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[2000:2300] = data[100:400]
    at = np.arange(len(data) - 100 + 1)
    live, group = substrings.equal_suffixes(data, at, 100)
    seen = {}
    for i in at:
        seen.setdefault(data[i : i + 100].tobytes(), []).append(int(i))
    want = sorted(x for x in seen.values() if len(x) > 1)
    got = {}
    for i, g in zip(live, group):
        got.setdefault(int(g), []).append(int(at[i]))
    assert sorted(sorted(x) for x in got.values()) == want and len(want) >= 200


def test_runs_cover_every_suffix_once():
    rng = random.Random(2)
    datas = [bytes(rng.choices(b"ab c", k=n)) for n in (0, 0, 99, 100, 5, 700, 0, 2500, 0)]
    doc, lo, n, g, s = substrings.runs(datas)
    seen = [(int(d), int(a) + i) for d, a, c in zip(doc, lo, n) for i in range(c)]
    assert seen == [(d, i) for d, x in enumerate(datas) for i in range(len(x) - 99)]


def test_odd_rows(make_docs):
    text = " ".join(f"some{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, None), (None, text), (3, text + "!"), (4, "x" * 120_000)]
    docs = make_docs(rows).withColumn("h", F.lit("clash")).withColumn("gone", F.lit(1))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in substrings.digest(substrings.deduplicate(docs)).collect())
    n = len(text)
    assert got == [("1", n, 0, 0), ("1", n, 0, 0), ("2", 0, 0, 0), ("3", n + 1, n, 1), ("4", 120_000, 119_999, 1), ("None", n, n, 1)]
    assert substrings.deduplicate(docs.limit(0)).count() == 0


def test_ranges_grow_in_number_with_the_texts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(substrings, "RANGE", 1000, raising=False)
    monkeypatch.setattr(substrings, "CROWDED", 1)
    rows, dealt = corpus(), []
    plain = type(make_docs(rows)).repartitionById
    monkeypatch.setattr(type(make_docs(rows)), "repartitionById", lambda self, n, *cols: dealt.append(n) or plain(self, n, *cols))
    got = {r.doc_id: tuple(r)[1:] for r in substrings.digest(substrings.deduplicate(make_docs(rows).repartition(3))).collect()}
    assert got == brute.without_repeats(rows, 100)
    size = sum(len((t or "").encode()) for _, t in rows)
    assert dealt[0] == -(-size // 1000) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(dealt) == 2 and dealt[1] > 8  # and so do those of sorted suffixes


def test_few_suffixes_of_many_bytes_need_little_memory():
    data = np.random.default_rng(1).integers(0, 256, 1 << 20).astype(np.uint8)
    tracemalloc.start()
    live, _ = substrings.equal_suffixes(data, np.arange(0, 1 << 19, 1000), 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not len(live) and peak < 1 << 20


def test_pieces_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(substrings, "_BLOCK", 10)
    texts = ["", None, "abc", "é" * 30, "", "x" * 9, None, "y", "z" * 11]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    pieces = [p.column("text").to_pylist() for p in substrings._pieces(batch.slice(1))]
    assert sum(pieces, []) == texts[1:] and len(pieces) > 2 and all(sum(len((t or "").encode()) for t in p[:-1]) < 10 for p in pieces)
    assert not list(substrings._pieces(batch.slice(0, 0)))
