import random
import zlib

import numpy as np
import pytest

from ledgerlake.llm import packing
from ledgerlake.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def slow():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer_file(slow):
    encode, rng = packing.Encoder(tokenizer_file()).encode, random.Random(3)
    marks = "ab'sSt  \n\r\t\x0b\x1c\x1f\x85\xa0  　​é中😀1²½.,!_-\x00"
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encode(text), "<u4").tolist() == slow(text), repr(text)
    for _ in range(300):
        text = "".join(rng.choice([*marks, "<|endoftext|>", "<|endof"]) for _ in range(rng.randint(0, 14))) + "<|endoftext|> b"
        assert np.frombuffer(encode(text), "<u4").tolist() == slow(text), repr(text)
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    for text in ("a" * 5000, " " * 3000, "word " * 3000, "é中" * 2000):
        assert np.frombuffer(encode(text), "<u4").tolist() == slow(text)


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_piece_lengths(n):
    parts = packing.piece_lengths(n)
    assert sum(parts) == n and parts == sorted(parts, reverse=True)
    assert all(p & (p - 1) == 0 and p <= 1024 for p in parts) and len({p for p in parts if p < 1024}) == sum(p < 1024 for p in parts)


def test_round_trip(documents, slow):
    docs = {r.doc_id: slow(r.text) + [0] for r in documents.collect()}
    pieces = packing.pack(documents, tokenizer_file())
    rows = pieces.collect()
    back = {}
    for r in sorted(rows, key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.offset == 0 and r.start == len(back.setdefault(r.doc_id, [])) and r.doc_tokens == len(docs[r.doc_id])
        back[r.doc_id] += ids
    assert back == docs and len({r.sequence_id for r in rows}) == len(rows)
    batches = {}
    for r in rows:
        batches.setdefault(r.batch_id, set()).add(r.length)
    assert all(len(x) == 1 for x in batches.values())
    for r in packing.digest(pieces).limit(50).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_odd_rows(make_docs, spark):
    docs = make_docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "z " * 40_000)]).withColumnRenamed("source", "ids")
    rows = packing.pack(docs, tokenizer_file(), batch_ids=4).collect()
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total[1] == total[2] == 1 and total[3] == 6 and total[None] == 2 and total[4] > 40_000
    assert packing.pack(docs.limit(0), tokenizer_file()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer_file(), max_length=1000)


def test_uneven_blanks_equal_the_search():
    rng, marks = random.Random(8), "ab  \n\t\r\x0b\x1c\x85\xa0 ​\x00é"
    for _ in range(20000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(1, 6)))
        assert packing.uneven(text) == bool(packing._UNEVEN.search(text)), repr(text)


def test_words_are_kept_once_and_looked_up_as_they_are_split():
    e = packing.Encoder(tokenizer_file())
    e.encode("one two\nthree two one  two")
    assert set(e) == {"two\nthree", "two", "one  two"}
