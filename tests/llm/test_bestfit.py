import bisect
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import bestfit
from ledgerlake.llm.queries import tokenizer_file


def one_by_one(sizes, most):
    """Best-fit decreasing, a piece at a time: the filled lengths of its sequences."""
    rooms = []
    for s in sorted(sizes, reverse=True):
        at = bisect.bisect_left(rooms, s)
        room = rooms.pop(at) if at < len(rooms) else most
        bisect.insort(rooms, room - s)
    return sorted(rooms)


def placed(counts, most):
    rows, n = bestfit.plan(counts, most)
    fill = [[] for _ in range(n)]
    for size, c in counts.items():
        starts = [r[0] for r in rows[size]]
        for rank in range(c):
            first_rank, each, first, base = rows[size][bisect.bisect_right(starts, rank) - 1]
            fill[first + (rank - first_rank) // each].append((base + (rank - first_rank) % each * size, size))
    return fill


@pytest.mark.parametrize("most", [1, 7, 16, 100, 2048])
def test_plan_equals_placing_one_by_one(most):
    rng = random.Random(most)
    for _ in range(40):
        few = rng.sample(range(1, most + 1), min(most, rng.randint(1, 12)))
        sizes = [rng.choice(few) if rng.random() < 0.7 else rng.randint(1, most) for _ in range(rng.randint(0, 400))]
        fill = placed(Counter(sizes), most)
        for pieces in fill:
            at = 0
            for offset, size in sorted(pieces):
                assert offset == at
                at += size
            assert 0 < at <= most
        assert sorted(most - sum(s for _, s in p) for p in fill) == one_by_one(sizes, most)


def test_tightest_capacity():
    rng, tree, have = random.Random(1), bestfit.Capacities(50), Counter()
    for _ in range(2000):
        c = rng.randint(1, 50)
        n = 1 if rng.random() < 0.4 or not have[c] else -1
        tree.add(c, n)
        have[c] += n
        s = rng.randint(1, 50)
        assert tree.tightest(s) == min((x for x in have if have[x] and x >= s), default=None)


def test_cut():
    assert bestfit.cut(5, 4) == [1, 4] and bestfit.cut(8, 4) == [4, 4] and bestfit.cut(3, 4) == [3]


def checked(rows, ids_of, most):
    back, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.start)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        back.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, pieces in back.items():
        whole = [i for _, _, ids in pieces for i in ids]
        assert whole == ids_of[doc] and [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert all(len(ids) == most for _, _, ids in pieces[1:])
    assert back.keys() == ids_of.keys()
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= most
    assert len(sequences) == len(one_by_one([r.length for r in rows], most))


@pytest.mark.parametrize("most", [2048, 100])
def test_given_documents(spark, documents, most):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    docs = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [0] for r in documents.collect()}
    checked(bestfit.pack(documents.repartition(7, "doc_id"), tokenizer_file(), most).collect(), docs, most)


def test_odd_rows(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "z " * 40_000)]).withColumnRenamed("source", "length")
    rows = bestfit.pack(docs, tokenizer_file(), 16).collect()
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    assert total[1] == total[2] == 1 and total[3] == 6 and total[None] == 2 and total[4] > 40_000
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    thin = bestfit.pack(docs, tokenizer_file(), 16, keep_ids=False)
    assert "ids" not in thin.columns and thin.count() == len(rows)
    assert bestfit.pack(docs.limit(0), tokenizer_file()).count() == 0
    with pytest.raises(ValueError):
        bestfit.pack(docs, tokenizer_file(), 0)


def test_copies_fill_sequences(make_docs):
    rows = bestfit.pack(make_docs([(i, "same words here") for i in range(500)] + [(900, "other")]).repartition(6), tokenizer_file(), 16).collect()
    assert len({r.sequence_id for r in rows}) == -(-sum(r.length for r in rows) // 16)
