import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm.common import table
from ledgerlake.llm.queries import tokenizer_file
from tests.llm import brute


def expected(rows, disclosed=()):
    """(doc_id, ids) of what the pipeline packs, one entry per copy, from (doc_id, text, source). The
    ``disclosed`` words give an address away and go."""
    from tokenizers import Tokenizer

    rows = sorted(r for r in rows if not brute.base_failed(r[1]))
    root = brute.groups([brute.simhash(t) for _, t, _ in rows])
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    clean = []
    for d, t, s in rows:
        out, at, done = [], 0, 0
        marks = [(a, b, f"<{k.upper()}>") for k, a, b in brute.spans(t)]
        marks += [(m.start(), m.end(), "") for w in disclosed for m in re.finditer(rf"(?<!\S){w}(?!\S)", t)]
        for a, b, mark in sorted(marks, key=lambda x: (x[0], -x[1])):
            if a >= done:
                out += [t[at:a], mark]
            done = at = max(done, b)
        clean.append((d, "".join([*out, t[at:]]), s))
    mixed = brute.mixed([(d, s, len(brute.WORD.findall(t))) for d, t, s in clean])
    encode = Tokenizer.from_file(tokenizer_file()).encode
    return sorted((d, encode(t, add_special_tokens=False).ids + [0]) for (d, t, _), m in zip(clean, mixed) for _ in range(m[3]))


def packed(spark, sf_dir):
    rows = sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=lambda r: r.sequence_id)
    got, held = [], []
    for r in rows:
        held += np.frombuffer(r.ids, "<u4").tolist()
        if len(held) == r.doc_tokens:
            got.append((r.doc_id, held))
            held = []
    assert not held
    return sorted(got)


def test_run_equals_brute_force(spark, sf_small, documents):
    assert packed(spark, sf_small) == expected([(r.doc_id, r.text, r.source) for r in documents.collect()])


def test_words_that_give_an_address_away_are_removed_on_the_way(spark, make_docs, tmp_path):
    rng = random.Random(6)
    some = lambda n: " ".join(f"w{rng.randrange(40_000)}x" for _ in range(n))
    rows = [(i, f"{some(30)} Zebulon writes to z@corp.example today {some(30)}", "en", f"s{i % 3}") for i in range(12)]
    rows += [(100, f"{some(30)} and Zebulon was there {some(30)}", "en", "s0"), (101, f"{some(40)} other@corp.example {some(9)}", "en", "s1")]
    rows += [(200 + i, some(60) + " today there writes", "en", f"s{i % 3}") for i in range(90)]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = expected([(r[0], r[1], r[3]) for r in rows], disclosed=("Zebulon",))
    assert packed(spark, str(tmp_path)) == want and len({d for d, _ in want}) > 80


def test_stages_keep_the_columns_and_stand_empty_tables(spark, sf_small):
    docs = table(spark, sf_small, "documents").limit(0).withColumn("component_id", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() == 0


@pytest.mark.parametrize("step", range(5))
def test_odd_rows(spark, make_docs, step):
    text = "one two three four five six seven eight nine ten eleven"
    docs = make_docs([(1, None), (None, text), (2, text), (2, text), (3, ""), (4, text + " mail a@b.c now", None, "s")])
    out = corpus_pipeline.STAGES[step][1](spark, docs, "").collect()
    assert len(out) > 0
    if step == 0:
        assert len(out) == 4
    if step == 1:
        assert sorted(str(r.doc_id) for r in out) == ["1", "2", "4"]
    if step == 2:
        assert [r.n_chars == len(r.text) for r in out if r.text is not None] == [True] * 5 and any("<EMAIL>" in (r.text or "") for r in out)
