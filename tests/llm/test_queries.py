import duckdb
import pytest

from ledgerlake.llm import queries

TABLES = ("documents", "labels", "conversations", "benchmark")


def _rows(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_small, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(queries.oracle_sql()[key])
    names = sorted(d[0] for d in cur.description)
    order = [[d[0] for d in cur.description].index(n) for n in names]
    want = _rows(tuple(r[i] for i in order) for r in cur.fetchall())
    got = queries.queries()[key](spark, sf_small)
    assert sorted(got.columns) == names and _rows(tuple(r) for r in got.select(*names).collect()) == want


@pytest.mark.parametrize("key", sorted(k for k in queries.queries() if k not in ("op3_chat", "op11_lexical", "op12_whitening")))
def test_every_document_is_covered(spark, sf_small, documents, key):
    ids = {r.doc_id for r in queries.queries()[key](spark, sf_small).select("doc_id").collect()}
    assert ids == {r.doc_id for r in documents.select("doc_id").collect()}


def test_the_entry_registers_them_and_stands_without(monkeypatch):
    import sys

    import __spark_entry__ as entry

    assert {*queries.queries(), "pipeline"} <= set(entry.queries()) and set(queries.oracle_sql()) <= set(entry.oracle_sql())
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("ledgerlake.llm")]:
        monkeypatch.setitem(sys.modules, name, None)
    monkeypatch.setitem(sys.modules, "ledgerlake.llm", None)
    monkeypatch.setitem(sys.modules, "ledgerlake.llm.queries", None)
    assert not any(k.startswith("op") and k[2].isdigit() for k in entry.queries()) and "shop_ledger" in entry.queries()
