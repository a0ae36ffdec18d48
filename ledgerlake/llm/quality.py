"""Quality rules with verdicts on hosts.

Each document is measured and judged by five rules. The two base rules reject a document by
itself; the others (symbols, repeated lines, word lengths) are too weak for that, but tell of a
host that fails them again and again. Failures are summed per host and rule (partial aggregation, so
a host with a third of all rows is pre-aggregated in every task), the rate of documents that fail any
rule is shrunk towards the corpus rate with a beta prior fitted to all hosts, and hosts whose shrunk
rate reaches the limit lose all their documents.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, landed, map_batches

MAX_BROADCAST_HOSTS = 1_000_000  # rejected hosts that are broadcast; more are joined by shuffle
MIN_WORDS, MAX_REPEAT_PERCENT, HOST_LIMIT, WINDOW = 10, 20, 0.5, 5
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT, WORD_CHARS = 10, 5, (2, 15)  # of words; mean characters a word
_SYMBOLS = bytes(b for b in range(256) if b not in b"#*$%&|<>")
_BLANKS = b" \t\n\x0b\x0c\r"
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words that occurs at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    h = np.zeros(n, np.uint64)
    for i in range(window):  # exact while ids fit; a collision is undone by the check below
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n].astype(np.uint64)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    grams = [tuple(ids[i : i + window].tolist()) for i in at]
    count = Counter(grams)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, g in zip(at, grams):
        if count[g] > 1:
            covered[i] += 1
            covered[i + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    blanks = len(data) - len(data.translate(None, _BLANKS))
    symbols = len(data.translate(None, _SYMBOLS))
    dup = 0
    if b"\n" in data:
        lines = [x for x in data.split(b"\n") if x and not x.isspace()]
        dup = len(lines) - len(set(lines))
    return len(words), len(text or "") - blanks, symbols, dup, repeated_words(words)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus the measures. A null text counts as empty."""
    rest = [c for c in docs.columns if c != text_col]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = np.array([measures(t) for t in batch.column(text_col).to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in rest), *(pa.array(m[:, i].copy()) for i in range(m.shape[1]))],
            [*rest, *(x.split()[0] for x in MEASURES.split(", "))],
        )

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col), MEASURES])
    return map_batches(docs, run, fields)


def rules() -> dict[str, Column]:
    """By name, whether a document with these measures fails the rule."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * n,
        "word_chars": (F.col("word_chars") < WORD_CHARS[0] * n) | (F.col("word_chars") > WORD_CHARS[1] * n),
    }


def base_failed() -> Column:
    found = rules()
    return found["short"] | found["repeats"]


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``rows`` (host, the measures) -> (host, host_docs, one count a rule, host_failed, host_rate, host_kept).

    The prior is Beta(m s, (1 - m) s): m is the corpus rate, and s follows from how much more the
    hosts' rates vary than m alone would make them. Without such excess s is 10^6, so hosts are
    judged by m. Rows without host are left out.
    """
    failed = rules()
    hosts = landed(rows.where("host is not null").groupBy("host").agg(
        F.count("*").alias("host_docs"), *[F.count_if(c).alias(f"n_{name}") for name, c in failed.items()],
        F.count_if(reduce(Column.__or__, failed.values())).alias("host_failed"),
    ))
    n, f, h, square = hosts.agg(  # one row of sums
        F.sum("host_docs"), F.sum("host_failed"), F.count("*"), F.sum(F.col("host_failed") * F.col("host_failed") / F.col("host_docs"))
    ).first()
    m = f / n if n else 0.0
    excess = square / n - m * m - m * (1 - m) * h / n if n else 0.0
    s = min(1e6, max(1.0, m * (1 - m) / excess - 1)) if excess > 1e-12 else 1e6
    rate = (F.col("host_failed") + F.lit(m * s)) / (F.col("host_docs") + F.lit(s))
    return hosts.select("*", rate.alias("host_rate"), (rate < limit).alias("host_kept"))


def judge(docs: DataFrame, host: Column | str = "source", limit: float = HOST_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the measures, base_failed, host_rate, kept): one row per row of ``docs``.

    ``kept`` is false if a base rule fails, else the verdict on the host; documents without host
    are judged by the base rules alone. A null text counts as empty and fails. Repeated ids and
    rows are judged row by row; an empty table gives an empty result; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.col(host) if isinstance(host, str) else host).alias("host"), F.col(text_col).alias("text"))
    rows = landed(measured(rows).withColumn("base_failed", base_failed()))
    verdicts = host_verdicts(rows, limit).select("host", "host_rate", "host_kept")
    return rows.join(verdicts, "host", "left").select(
        "doc_id", *(x.split()[0] for x in MEASURES.split(", ")), "base_failed", "host_rate",
        (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept"),
    )


def keep_good(docs: DataFrame, host: Column | str = "source", limit: float = HOST_LIMIT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns. Only measures are summed per
    host; the texts are never shuffled unless the hosts' verdicts outgrow a broadcast."""
    key, bad = fresh(docs, "_host"), fresh(docs, "_bad")
    named = docs.withColumn(key, F.col(host) if isinstance(host, str) else host)

    def flag(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = [measures(t) for t in batch.column(text_col).to_pylist()]
        failed = pa.array([n < MIN_WORDS or 100 * r > MAX_REPEAT_PERCENT * n for n, *_, r in m])
        return pa.RecordBatch.from_arrays([*batch.columns, failed], [*batch.schema.names, bad])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema)
    narrow = named.select(F.col(key).alias("host"), F.col(text_col).alias("text"))
    verdicts = host_verdicts(measured(narrow), limit)
    lost = landed(verdicts.where("not host_kept").select(F.col("host").alias(key)))
    kept = map_batches(named, flag, f"{fields}, `{bad}` boolean").where(~F.col(bad))
    n_lost = lost.count()
    if n_lost:
        kept = kept.join(F.broadcast(lost) if n_lost <= MAX_BROADCAST_HOSTS else lost, key, "left_anti")
    return kept.select(*[f"`{c}`" for c in docs.columns])
