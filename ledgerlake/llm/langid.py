"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts (language, bucket) are summed per task in numpy and then by Spark; the model is a
matrix of ``BUCKETS`` x languages whose size is checked before it is collected and broadcast.
Texts are scored in batches: the hashed n-grams of a batch are a sparse matrix in row order (bucket
indices and row starts), multiplied by the matrix with a gather and a segmented sum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import landed, map_partitions, texts

SIZES = (1, 2, 3)
BUCKETS = 1 << 15
ALPHA = 0.5
MAX_MODEL_CELLS = 1 << 22  # 128 languages, 32 MB of doubles: the bound of what is collected and broadcast
_BLOCK = 1 << 20  # characters handled at once; longer texts are cut into segments that overlap
_MIX = np.uint32(0x9E3779B1)


def _segments(rows: list[str]):
    """(row number, characters, start positions that count) covering each text once."""
    reach = max(SIZES) - 1
    for i, text in enumerate(rows):
        for s in range(0, len(text), _BLOCK):
            n = min(_BLOCK, len(text) - s)
            yield i, text[s : s + n + reach], n


def _blocks(rows: list[str]):
    """Lists of segments of about ``_BLOCK`` characters."""
    held, size = [], 0
    for seg in _segments(rows):
        held.append(seg)
        size += seg[2]
        if size >= _BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def grams(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets by n-gram size and start position, first position of each segment, its row).
    A start that doesn't count has the bucket ``BUCKETS``."""
    reach = max(SIZES) - 1
    pad = "\0" * reach
    flat = np.frombuffer("".join(t.replace("\0", " ") + pad for _, t, _ in block).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) + reach for _, t, _ in block])
    starts = np.cumsum(lengths) - lengths
    live = flat != 0
    counts = np.array([n for *_, n in block])
    ok = np.zeros(len(flat) + 1, np.int8)
    np.add.at(ok, starts, 1)
    np.add.at(ok, starts + counts, -1)
    ok = np.cumsum(ok[:-1]) > 0
    out = np.full((len(SIZES), len(flat)), BUCKETS, np.int32)
    h = np.zeros(len(flat), np.uint32)
    for k in range(max(SIZES)):
        n = len(flat) - k
        h[:n] = (h[:n] ^ flat[k:]) * _MIX
        h[:n] ^= h[:n] >> np.uint32(15)
        if k:
            ok[:n] &= live[k:]
            ok[n:] = False
        if k + 1 in SIZES:
            b = ((h * np.uint32(0x85EBCA77 + 2 * k)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)
            out[SIZES.index(k + 1)] = np.where(ok, b, BUCKETS)
    return out, starts, np.array([i for i, *_ in block])


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", alpha: float = ALPHA) -> tuple[list[str], np.ndarray]:
    """(languages, matrix): log probabilities of buckets by language, the last row zero, centred so
    that only differences between languages remain; the row before it holds the log priors.
    Rows without language are left out. No rows give no languages."""

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            rows = [t.lower() for t in texts(batch)]
            langs = batch.column("lang").to_pylist()
            for x in langs:
                docs_of[x] = docs_of.get(x, 0) + 1
            order = sorted(set(langs))
            at = {x: i for i, x in enumerate(order)}
            for block in _blocks(rows):
                g, starts, row = grams(block)
                lens = np.diff(np.r_[starts, g.shape[1]])
                which = np.repeat(np.array([at[langs[i]] for i in row]), lens)
                n = np.bincount((which * (BUCKETS + 1) + g).ravel(), minlength=len(order) * (BUCKETS + 1)).reshape(-1, BUCKETS + 1)
                for x, i in at.items():
                    totals[x] = totals.get(x, 0) + n[i, :BUCKETS]
        for x, n in docs_of.items():
            n_grams = totals.get(x, np.zeros(BUCKETS, np.int64))
            b = np.flatnonzero(n_grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * (len(b) + 1)), pa.array(np.r_[b, -1].astype(np.int32)), pa.array(np.r_[n_grams[b], n].astype(np.int64))], ["lang", "bucket", "n"]
            )

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    sums = landed(map_partitions(rows, run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    limit = MAX_MODEL_CELLS // BUCKETS
    if sums.select("lang").distinct().count() > limit:  # before anything is collected
        raise ValueError(f"more than {limit} languages: the model would outgrow its bound")
    table = sums.toPandas()  # a row a language and bucket that it has
    langs = sorted(table.lang.unique(), key=lambda x: x.encode())
    if not langs:
        return [], np.zeros((BUCKETS + 2, 0))
    counts = np.zeros((BUCKETS + 1, len(langs)))
    counts[table.bucket.to_numpy(), table.lang.map({x: i for i, x in enumerate(langs)}).to_numpy()] = table.n.to_numpy()  # bucket -1: the last row
    prior = np.log(counts[-1] / counts[-1].sum())
    logs = np.log(counts[:-1] + alpha) - np.log(counts[:-1].sum(axis=0) + alpha * BUCKETS)
    return langs, np.vstack([logs - logs.mean(axis=1, keepdims=True), np.zeros((1, len(langs))), prior])


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the most probable language and its posterior probability.

    ``und`` with score 0 for a null text or one without a letter, or if the model has no language.
    Ties go to the first language by code point. One row per row; repeated rows get equal results;
    a null id stays null; an empty table gives an empty result; other columns aren't read.
    """
    langs, matrix = model
    if matrix.size > MAX_MODEL_CELLS + 2 * max(1, len(langs)):
        raise ValueError("the model outgrows its bound")
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches):
        langs, matrix = shared.value
        weights, prior = np.ascontiguousarray(matrix[:-1]), matrix[-1]
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = texts(batch)
            live = np.array([bool(langs) and _has_letter(t) for t in raw])
            best, score = np.full(len(raw), -1), np.zeros(len(raw))
            if live.any():
                sums = np.tile(prior, (len(raw), 1))
                for block in _blocks([t.lower() if ok else "" for t, ok in zip(raw, live)]):
                    g, starts, row = grams(block)
                    for x in g:
                        np.add.at(sums, row, np.add.reduceat(weights[x], starts, axis=0))
                best = np.where(live, sums.argmax(axis=1), -1)
                odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                score = np.where(live, odds.max(axis=1) / odds.sum(axis=1), 0.0)
            names = pa.array([langs[i] if i >= 0 else "und" for i in best], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), names, pa.array(score)], ["doc_id", "lang_pred", "score"])

    ids = docs.schema[id_col].dataType.simpleString()
    return map_partitions(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {ids}, lang_pred string, score double")


def identify(docs: DataFrame, learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where ``learn`` holds, predict every row."""
    return predict(docs, train(docs.where(learn), lang_col, text_col), id_col, text_col)
