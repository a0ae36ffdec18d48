import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import pii
from tests.llm import brute


def test_patterns_equal_plain_regular_expressions():
    rng = random.Random(4)
    for n in range(20_000):
        text = "".join(rng.choice("a.b@@-+%é 1234567890123450 ()..\n") for _ in range(rng.randint(0, 50)))
        if n % 3 == 0:
            text = "".join(c if c in "0123456789 -" else "4" for c in text)
        assert pii.base_spans(text) == brute.spans(text), repr(text)
    assert pii.base_spans("a" * 200_000 + " 1" * 50_000) == []


def test_documents_equal_brute_force(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = pii.digest(pii.detect(documents)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.spans(texts[r.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in want) for x in pii.KINDS)


def planted(make_docs):
    secret, common = "mr.x@corp.example", "the of and is"
    rows = [(i, f"{common} letter {i} from Zebulon at {secret} about topic{i} {common}") for i in range(6)]
    rows += [(100 + i, f"{common} nothing private in text {i} about weather letter from at") for i in range(60)]
    rows += [(300 + i, f"copied rareword y{i % 1}@z.example tail") for i in range(8)]  # one surrounding only
    return make_docs(rows)


def test_a_term_that_gives_an_entity_away_is_found(make_docs):
    docs = planted(make_docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: [(texts[r.doc_id][t.start : t.end], t.action) for t in r.terms] for r in pii.detect(docs).collect()}
    assert all(found[i] == [("Zebulon", "remove")] for i in range(6))
    assert not any(found[i] for i in found if i >= 100)


def test_shares_equal_brute_force(make_docs):
    import math

    docs = planted(make_docs)
    seen = pii.found(docs)
    shares = {r.term: r.share for r in pii.disclosing(seen, docs, lower=-99.0, sure=0.0).collect()}
    n, c = 74, 6
    assert abs(shares["zebulon"] - 1) < 1e-12
    assert abs(shares["from"] - math.log(6 * n / (c * 66)) / math.log(n / c)) < 1e-12


def test_sanitised_texts(make_docs):
    docs = planted(make_docs).withColumn("_hash", F.lit(1)).withColumn("_terms", F.lit(2))
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0].startswith("the of and is letter 0 from  at <EMAIL> about") and texts[300] == "copied rareword <EMAIL> tail"
    assert pii.redact("a 10.0.0.1 b", [(2, 4, "generalise"), (11, 12, "remove")]) == "a <IP> "


@pytest.mark.parametrize("bound", [pii.MAX_BROADCAST, 0])
def test_disclosing_terms_go_wherever_they_stand(make_docs, monkeypatch, bound):
    monkeypatch.setattr(pii, "MAX_BROADCAST", bound)
    far = "one two three four five six seven eight"
    rows = [(r.doc_id, r.text) for r in planted(make_docs).collect()]
    rows += [(400, f"letter 9 from Zebulon at mr.x@corp.example {far}.\n\nZebulon, again"), (401, "Zebulon<mr.x@corp.example>"), (402, "we met Zebulon")]
    rows += [(500 + i, f"Quixote {far} note{i} q@r.example tail{i}") for i in range(8)] + [(510, "Quixote alone"), (None, "a Quixote")]
    rows += [(600 + i, f"{far} again tail") for i in range(60)]
    docs = make_docs(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: [texts[r.doc_id][t.start : t.end] for t in r.terms] for r in pii.detect(docs).collect()}
    assert found[400] == ["Zebulon", "Zebulon,"] and found[401] == ["Zebulon<"] and found[402] == ["Zebulon"]
    assert all("Quixote" in found[i] for i in (*range(500, 508), 510, None)) and not any(found[100 + i] for i in range(60))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any("Zebulon" in t for t in clean.values()) and "Quixote" not in clean[510] and clean[401] == "<EMAIL>>"


def test_words_that_met_an_entity_by_chance_stay(make_docs):
    """20,000 texts of words drawn independently of four addresses in 400 of them; one name goes with one address."""
    rng = random.Random(3)
    words = [f"word{int(rng.paretovariate(0.7)) % 30_000}" for _ in range(400_000)]
    rows, at = [], 0
    for i in range(20_000):
        text = " ".join(words[at : at + 20])
        at += 20
        if i < 400:
            name = " Zebulon" if i % 4 == 0 and i % 40 < 20 else ""
            text += f" write{name} to box{i % 4}@corp.example " + words[i]
        rows.append((i, text + (" Zebulon" if i == 9000 else "")))
    docs = make_docs(rows)
    touched = {r.doc_id: [(t.action, r.text[t.start : t.end]) for t in r.terms] for r in pii.detect(docs).join(docs.select("doc_id", "text"), "doc_id").collect() if r.terms}
    assert touched.pop(9000) == [("remove", "Zebulon")]
    assert {i for i in touched if i < 400 and i % 4 == 0 and i % 40 < 20} == {i for i in range(0, 400, 4) if i % 40 < 20}
    assert sum(i >= 400 for i in touched) <= 2  # of 19,600 texts without an address


def test_a_page_of_addresses_gives_terms_in_proportion(make_docs):
    def pairs(n):
        text = " ".join(f"person{i} at p{i}@corp.example" for i in range(n))
        return sum(len(e.terms) for e in pii.found(make_docs([(1, text)])).first().entities)

    assert pairs(50) <= 4 * 50 and pairs(400) <= 8.5 * pairs(50)
    assert pii.beside("a1x a@b.c b1x c@d.e c1x a@b.c", [("email", 4, 9), ("email", 14, 19), ("email", 24, 29)]) == {
        pii._entity("email", "a@b.c"): {"a1x", "b1x", "c1x"}, pii._entity("email", "c@d.e"): {"b1x", "c1x"}}


def test_copies_and_single_documents_prove_nothing(make_docs):
    many = " ".join(f"w{i}a w{i}b w{i}c w{i}d w{i}e w{i}f m@n.example" for i in range(4))
    docs = make_docs([(i, f"{many} rareword") for i in range(5)] + [(10 + i, f"plain text number {i}") for i in range(50)])
    assert not any(r.terms for r in pii.detect(docs).collect())


def test_odd_rows(make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "a@b.c"), (3, "a@b.c a@b.c"), (3, "a@b.c a@b.c"), (4, "+1 (234) 567-8901 " * 3000)])
    docs = docs.withColumn("near", F.lit(1)).withColumn("text_hash", F.lit("x"))
    got = sorted((str(r.doc_id), r.n_email, r.n_phone) for r in pii.detect(docs).collect())
    assert got == [("1", 0, 0), ("2", 0, 0), ("3", 2, 0), ("3", 2, 0), ("4", 0, 3000), ("None", 1, 0)]
    clean = sorted((str(r.doc_id), r.text) for r in pii.sanitise(docs).collect())
    assert clean[0] == ("1", None) and clean[2] == clean[3] == ("3", "<EMAIL> <EMAIL>")
    assert pii.detect(docs.limit(0)).count() == 0 and pii.sanitise(docs.limit(0)).count() == 0
