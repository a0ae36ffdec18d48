import random

from pyspark.sql import functions as F

from ledgerlake.llm import quality
from tests.llm import brute


def test_measures_equal_brute_force(documents):
    rng = random.Random(5)
    texts = [r.text for r in documents.collect()]
    texts += ["".join(rng.choice("ab \n\t\x0b\xa0#é") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    for t in [*texts, None, "", " ", "x " * 30_000]:
        assert quality.measures(t) == brute.measures(t)


def test_verdicts(documents):
    got = quality.judge(documents).collect()
    failed = {r.doc_id: brute.base_failed(r.text) for r in documents.collect()}
    assert {r.doc_id: r.base_failed for r in got} == failed
    assert all(r.kept == (not r.base_failed) for r in got)  # no host here is bad enough


def test_a_bad_host_loses_its_clean_documents(make_docs):
    clean = "these ten plain words make up a whole clean text " * 1
    good = [(i, f"{clean} number {i} of host {i % 9}", "en", f"h{i % 9}") for i in range(900)]
    bad = [(1000 + i, "too short" if i % 10 else clean + str(i), "en", "bad") for i in range(300)]
    docs = make_docs(good + bad + [(2000, "one short", "en", "tiny"), (2001, clean, "en", None), (2002, None, "en", None)])
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(got[i].kept for i in range(900)) and not any(got[1000 + i].kept for i in range(300))
    assert not got[1000].base_failed and got[2001].kept and got[2001].host_rate is None and not got[2002].kept
    assert got[2000].host_rate < 0.95  # one failure is shrunk towards the corpus
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_hosts_are_judged_by_all_rules(make_docs):
    """Hosts of symbol spam, of repeated lines, of endless words: no document fails a base rule, each host goes."""
    words = [f"word{i} and{i}" for i in range(400)]
    rng = random.Random(8)
    text = lambda n: " ".join(rng.sample(words, n))
    plain = [(i, text(12), "en", f"h{i % 8}") for i in range(800)]
    spam = {
        "symbols": lambda: " ".join(w + " #" for w in rng.sample(words, 8)),
        "dup_lines": lambda: (text(3) + "\nmenu one\n") + (text(3) + "\nmenu one\n") + text(3) + "\nmenu one\n" + text(2),
        "word_chars": lambda: " ".join(w.replace(" ", "") * 4 for w in rng.sample(words, 14)),
    }
    rows = plain + [(10_000 * (k + 1) + i, make(), "en", name) for k, (name, make) in enumerate(spam.items()) for i in range(100)]
    docs = make_docs(rows)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {r.doc_id for r in got.values() if r.kept} == {r[0] for r in plain}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {r[0] for r in plain}
    counts = {r.host: r for r in quality.host_verdicts(quality.measured(docs.withColumnRenamed("source", "host").select("host", "text"))).collect()}
    for name in spam:
        assert counts[name][f"n_{name}"] == 100 and counts[name].host_docs == 100 and not counts[name].host_kept
    assert counts["h1"].host_failed == 0


def test_odd_rows(make_docs):
    docs = make_docs([(1, None), (None, "a b c d e f g h i j", None, "s"), (2, "x", "en", "s"), (2, "x", "en", "s")])
    docs = docs.withColumn("base_failed", F.lit("clash")).withColumn("_host", F.lit(1)).withColumn("_BAD", F.lit(2))
    rows = quality.judge(docs).collect()
    assert len(rows) == 4 and sum(r.kept for r in rows) == 0 + sum(not r.base_failed and r.host_rate < 0.5 for r in rows)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.judge(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0
