"""Ranked lexical search: accumulator-limited, term at a time.

The documents are indexed once, by document: every task reads its texts, and writes inverted lists
of the query terms for blocks of a few thousand documents. Corpus statistics are sums over the
blocks. Then each block answers all queries on its own, so lists never meet in one task, a frequent
term costs no shuffle, and only the best few documents of a task and query move:

1. The terms of a query are taken rarest first. Each adds its part of the score to an accumulator
   a document; documents without one get one.
2. Once all terms still to come cannot lift a document from nothing to the k-th best partial score
   (of this block, or of those the task has finished), no accumulators are created any more. Partial
   scores only rise, so a document left out can neither pass nor tie with the k best.
3. The documents that have one are scored to the end, exactly.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_partitions, written

TOP = 10
QUERY_BYTES = 16 << 20  # query text answered in one pass, and so the size of what is broadcast
_BLOCK_DOCS, _BLOCK_BYTES, _SALTS = 4096, 32 << 20, 64
_SCALE = 1_000_000_000
_TERM = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERM).split()


def _inverted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """A row per block: its documents in id order with their lengths, and the lists of the terms
    found, as (term, end of its list) and (document in the block, occurrences)."""
    kind = docs.schema[id_col].dataType
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most QUERY_BYTES of terms

    def run(batches):
        number = shared.value.get
        held, size = [], 0

        def out():
            held.sort(key=lambda d: (d[0] is None, d[0] if d[0] is not None else 0))
            doc = np.repeat(np.arange(len(held), dtype=np.int32), [len(d[2]) for d in held])
            term = np.fromiter((t for d in held for t in d[2]), np.int32, len(doc))
            tf = np.fromiter((n for d in held for n in d[2].values()), np.int32, len(doc))
            order = np.lexsort((doc, term))
            doc, term, tf = doc[order], term[order], tf[order]
            end = np.flatnonzero(np.r_[term[1:] != term[:-1], True]) + 1 if len(term) else np.zeros(0, np.int64)
            n = np.array([d[1] for d in held], np.int64)
            cols = [n, term[end - 1], end.astype(np.int32), doc, tf]
            return pa.RecordBatch.from_arrays(
                [pa.array([[d[0] for d in held]], pa.list_(id_type)), *(pa.array([c.tobytes()], pa.binary()) for c in cols)],
                ["ids", "sizes", "terms", "ends", "docs", "tfs"],
            )

        for batch in batches:
            id_type = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms(text or b"")
                found = Counter(map(number, words))
                found.pop(None, None)
                held.append((doc, len(words), found))
                size += len(text or b"")
                if len(held) >= _BLOCK_DOCS or size >= _BLOCK_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_partitions(rows, run, f"ids array<{kind.simpleString()}>, sizes binary, terms binary, ends binary, docs binary, tfs binary")


def _statistics(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all terms of the corpus, and the documents holding each query term."""

    def run(batches):
        total = Counter()
        for batch in batches:
            for sizes, found, ends in zip(*(batch.column(c).to_pylist() for c in ("sizes", "terms", "ends"))):
                n = np.frombuffer(sizes, np.int64)
                total[-1] += int((n > 0).sum())
                total[-2] += int(n.sum())
                for t, df in zip(np.frombuffer(found, np.int32).tolist(), np.diff(np.frombuffer(ends, np.int32), prepend=0).tolist()):
                    total[t] += df
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], ["term", "n"])

    sums = map_partitions(index.select("sizes", "terms", "ends"), run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in sums.collect()}  # a row a query term
    return found.pop(-1, 0), found.pop(-2, 0), found


def best(query: list[int], lists: dict[int, tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 0) -> list[tuple[int, int]]:
    """(score, document) of the ``k`` best of ``n_docs`` documents, equal scores by smaller document.

    ``query`` are its terms, rarest first; ``lists`` have, by term, the documents in ascending order
    and the term's part of their scores. Documents with less than ``floor`` may be left out.
    """
    mine = [lists[t] for t in query if t in lists]
    rest = np.cumsum([int(part.max()) for _, part in mine][::-1])[::-1].tolist() + [0]  # the most all terms from here on can add
    score = np.zeros(n_docs, np.int64)
    for i, (docs, part) in enumerate(mine):
        kth = int(np.partition(score, -k)[-k]) if n_docs >= k else 0
        if rest[i] < max(kth, floor):
            alive = np.flatnonzero(score)
            break
        score[docs] += part
    else:
        i, alive = len(mine), np.flatnonzero(score)
    if not len(alive):
        return []
    total = score[alive]
    for docs, part in mine[i:]:
        at = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
        total += np.where(docs[at] == alive, part[at], 0)
    order = np.lexsort((alive, -total))[:k]
    return [(s, d) for s, d in zip(total[order].tolist(), alive[order].tolist()) if s > 0]


def _ranked(index: DataFrame, queries: list[list[int]], weights: dict[int, int], n: int, length: int, k: int) -> DataFrame:
    """(query, doc_id, score): of each task the ``k`` best documents a query."""
    kind = index.schema["ids"].dataType.elementType
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches):
        queries, weights = shared.value
        found, task = [[] for _ in queries], TaskContext.get().partitionId() % _SALTS
        for batch in batches:
            id_type = batch.column(0).type.value_type
            for ids, *arrays in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(arrays[0], np.int64)
                term, end, docs, tf = (np.frombuffer(x, np.int32) for x in arrays[1:])
                m = 10 + 90 * sizes * n // max(length, 1)
                part = _SCALE * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * m[docs])
                lists, at = {}, 0
                for t, e in zip(term.tolist(), end.tolist()):
                    if w := weights.get(t, 0):
                        lists[t] = docs[at:e], w * part[at:e]
                    at = e
                for q, query in enumerate(queries):
                    have = found[q]
                    floor = have[-1][0] if len(have) >= k else 0
                    got = [(s, ids[d]) for s, d in best(query, lists, len(ids), k, floor)]
                    if got:
                        found[q] = heapq.nsmallest(k, have + got, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
        rows = [(q, doc, s) for q, have in enumerate(found) for s, doc in have]
        if rows:
            q, doc, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc, id_type), pa.array(s, pa.int64()), pa.array([task] * len(q), pa.int32())], ["query", "doc_id", "score", "salt"])

    return map_partitions(index, run, f"query int, doc_id {kind.simpleString()}, score long, salt int")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 for each item.

    With N documents that have a term, L terms in all, n of them in a document and df documents
    holding a term, the term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and adds
    w * (10^9 tf div (1000 tf + 8 m)) to a document where it occurs tf times; m is
    10 + (90 n N) div L. Equal scores go by ascending id, null ids last. Any number of items is
    answered: in blocks of about ``query_bytes`` of query text, one pass over the documents each.

    A null text has no terms, and an item without terms no rows; items of one id count as one, with
    the terms of all their texts. Every document row counts, repeated ids too. Empty tables give no
    rows; other columns aren't read.
    """
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_col).alias("item_id"), F.col(query_col).alias("text")))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // query_bytes)
    item_type, doc_type = (df.schema[c].dataType.simpleString() for df, c in ((items, item_col), (docs, id_col)))
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score long")
    for i in range(n_blocks):
        here = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == i)
        out = out.union(_answered(docs, here.collect(), k, id_col, text_col, item_type))  # about query_bytes
    return out


def _answered(docs: DataFrame, items: list, k: int, id_col: str, text_col: str, item_type: str) -> DataFrame:
    words: dict = {}
    for r in items:
        words.setdefault(r["item_id"], set()).update(terms((r["text"] or "").encode("utf-8", "surrogatepass")))
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*words.values())))}
    index = written(_inverted(docs, vocabulary, id_col, text_col))
    n, length, df = _statistics(index)
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in df}
    names = sorted(words, key=lambda x: (x is None, str(x)))
    rarest = [sorted((vocabulary[t] for t in words[x] if vocabulary[t] in df), key=lambda t: (df[t], t)) for x in names]
    found = _ranked(index, rarest, weights, n, length, k)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["query", "salt"], ["query"]):  # the best of a few tasks first, then of those
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    spark = docs.sparkSession
    ids = spark.createDataFrame(list(enumerate(names)), f"query int, item_id {item_type}")
    return found.join(ids, "query").select("item_id", "rank", "doc_id", "score")
