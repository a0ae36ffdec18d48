"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. A sentence's score is a logistic
function of its words' weights; the document's is the noisy-or of its sentences, 1 - prod(1 - p).
Weights are fitted to document labels, so the credit falls on the sentences that explain them, and
the same sentence scores then locate the offending passages.

Words are described by themselves and their first letters, so that inflected and compound forms
share evidence. The model is fitted on at most ``SAMPLE`` labelled documents, taken in hash order;
features with too little evidence in that sample have no weight. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import landed, map_batches, map_partitions, texts

SAMPLE = 20_000  # labelled documents the model may learn from
VOCABULARY = 4_096
PREFIXES = (4, 5, 6, 7, 8)
MIN_TOXIC, MIN_EVIDENCE = 3, 12.0  # toxic documents, G-test
NO_EVIDENCE = -30.0  # bias without any feature: a text of any length scores 0
KEPT_SENTENCES = 0.6  # share of a toxic bag's sentences that each step of the fit sees
THRESHOLD = 0.3
CACHE = 400_000
_SENTENCE = re.compile(r"[.!?\n…。]+")


def features(word: str) -> list[str]:
    """A lower-case word, without marks at its ends, as itself (=word) and its prefixes."""
    s, e = 0, len(word)
    while s < e and not word[s].isalnum():
        s += 1
    while e > s and not word[e - 1].isalnum():
        e -= 1
    word = word[s:e]
    return ["=" + word, *(word[:n] for n in PREFIXES if len(word) >= n)] if word else []


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences that have a word."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        if not text[at : m.start()].isspace() and at < m.start():
            out.append((at, m.end()))
        at = m.end()
    if at < len(text) and not text[at:].isspace():
        out.append((at, len(text)))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, learn: Column, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, toxic) of at most ``size`` labelled documents, equal texts once. The ids are chosen
    from the labels by hash and broadcast; texts are not shuffled. An id with several labels counts
    as toxic if one of them does."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).where(learn)
        .groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    )
    # A hash first thins the ids to little more than ``size``, so that the ordering below sees few
    # rows at any input size; the limit makes the bound of the broadcast exact.
    order = F.xxhash64(F.col(id_col).cast("string"))
    share = min(1.0, 1.2 * size / max(1, known.count()))
    chosen = known.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(order, id_col).limit(size)
    chosen = landed(chosen.select(F.col(id_col).alias("_id"), F.col("toxic").alias("_toxic")))
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), docs[id_col] == F.col("_id"))
    return rows.groupBy(F.coalesce(F.col(text_col), F.lit("")).alias("text")).agg(F.max("_toxic").alias("toxic"))


def vocabulary(sample: DataFrame, size: int = VOCABULARY) -> list[str]:
    """The features that speak most for toxic documents (G-test on document counts). Any that is
    more frequent in them than in the others can be chosen, whatever the share of toxic labels."""

    def run(batches):
        toxic, every = Counter(), Counter()
        n = [0, 0]
        for batch in batches:
            for text, label in zip(texts(batch), batch.column("toxic").to_pylist()):
                found = set()
                for word in set(text.lower().split()):
                    found.update(features(word))
                every.update(found)
                if label:
                    toxic.update(found)
                n[bool(label)] += 1
        every[""], toxic[""] = sum(n), n[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(every), pa.string()), pa.array([toxic[f] for f in every], pa.int64()), pa.array(list(every.values()), pa.int64())], ["f", "t", "n"]
        )

    counts = landed(map_partitions(sample, run, "f string, t long, n long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).where(f"t >= {MIN_TOXIC} or f = ''"))
    whole = counts.where("f = ''").first()
    if whole is None or not whole.t or whole.t == whole.n:  # no label to tell from the other
        return []
    share = whole.t / whole.n
    t, n = F.col("t"), F.col("n")
    g = 2 * (t * F.log(t / (n * share)) + F.when(n > t, (n - t) * F.log((n - t) / (n * (1 - share)))).otherwise(0.0))
    best = counts.where("f <> ''").where(t > n * share).withColumn("g", g).where(F.col("g") >= MIN_EVIDENCE)
    return [r.f for r in best.orderBy(F.desc("g"), "f").limit(size).collect()]  # at most ``size`` rows


def bags(sample: DataFrame, vocab: list[str]) -> DataFrame:
    """(toxic, n_sentences, sent, feat): the vocabulary's features by sentence of each document."""
    number = {f: i for i, f in enumerate(vocab)}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, sent, feat = [], [], []
        for text in texts(batch):
            parts = sentences(text.lower())
            low = text.lower()
            s, f = [], []
            for i, (a, b) in enumerate(parts):
                hit = {number[x] for w in set(low[a:b].split()) for x in features(w) if x in number}
                s += [i] * len(hit)
                f += sorted(hit)
            total.append(len(parts)), sent.append(s), feat.append(f)
        return pa.RecordBatch.from_arrays(
            [batch.column("toxic").cast(pa.int32()), pa.array(total, pa.int32()), pa.array(sent, pa.list_(pa.int32())), pa.array(feat, pa.list_(pa.int32()))],
            ["toxic", "n_sentences", "sent", "feat"],
        )

    return map_batches(sample, run, "toxic int, n_sentences int, sent array<int>, feat array<int>")


def fit(found: pa.Table, n_features: int, steps: int = 400, rate: float = 0.1, l2: float = 0.1) -> tuple[float, np.ndarray]:
    """(bias, weights >= 0) that maximise the likelihood of the bags' labels, by Adam.

    Each step sees a fixed-seed random part of a toxic bag's weighted sentences, so that a bag
    with many telling sentences teaches that any one of them is enough."""
    if not found.num_rows:
        return -6.0, np.zeros(n_features)
    n = found.num_rows
    y = (found.column("toxic").to_numpy() > 0).astype(float)
    lists = found.column("sent").combine_chunks()
    of = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    place = of * (1 << 32) + lists.flatten().to_numpy().astype(np.int64)
    seen_at, sent = np.unique(place, return_inverse=True)  # the sentences that have a feature
    feat = found.column("feat").combine_chunks().flatten().to_numpy().astype(np.int64)
    bag, base = seen_at >> 32, len(seen_at)
    hits = np.bincount(bag, minlength=n)
    plain = found.column("n_sentences").to_numpy() - hits.astype(float)
    p = np.zeros(n_features + 1)
    p[-1] = -6.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    rng = np.random.default_rng(0)
    sure = y[bag] == 0
    first = (np.cumsum(hits) - hits)[hits > 0]
    for step in range(1, steps + 1):
        z = p[-1] + np.bincount(sent, weights=p[feat], minlength=base)
        prob, prob0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-p[-1]))
        draw = rng.random(base)
        seen = sure | (draw < KEPT_SENTENCES)
        if base:
            seen |= draw == np.repeat(np.minimum.reduceat(draw, first), hits[hits > 0])  # at least one
        log_none = -np.bincount(bag, weights=np.logaddexp(0, z) * seen, minlength=n) - plain * np.logaddexp(0, p[-1])
        none = np.minimum(np.exp(log_none), 1 - 1e-9)
        slope = y * none / (1 - none) - (1 - y)  # d loss / d log_none
        dz = -slope[bag] * prob * seen
        grad = np.r_[np.bincount(feat, weights=dz[sent], minlength=n_features) if len(sent) else np.zeros(n_features), dz.sum() - (slope * plain).sum() * prob0]
        grad = (grad + l2 * np.r_[p[:-1], 0.0]) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        np.maximum(p[:-1], 0, out=p[:-1])
        p[-1] = min(p[-1], -2.0)
    return float(p[-1]), p[:-1]


def train(docs: DataFrame, labels: DataFrame, learn: Column, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[float, dict[str, float]]:
    """(bias, weight by feature). What reaches the driver is bounded by ``size`` documents and the
    vocabulary. Without labels, or with one label only, no feature has weight."""
    sample = landed(training_sample(docs, labels, learn, size, id_col, text_col))
    vocab = vocabulary(sample)
    if not vocab:
        return NO_EVIDENCE, {}
    bias, weights = fit(bags(sample.sort(F.xxhash64("text")), vocab).toArrow(), len(vocab))  # at most ``size`` rows, always in one order
    return bias, {f: float(w) for f, w in zip(vocab, weights) if w > 1e-3}


def score(docs: DataFrame, model: tuple[float, dict[str, float]], threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, offending): the noisy-or over all sentences of the whole text, and (start,
    end, score) of the sentences that reach ``threshold`` by themselves.

    Null, blank and wordless texts have no sentence and score 0. One row per row; a null id stays
    null; equal texts score equally; an empty table gives an empty result; other columns aren't
    read.
    """
    spans = "array<struct<start:int,end:int,score:double>>"
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most VOCABULARY weights

    def run(batches):
        bias, weight = shared.value
        known: dict[str, tuple] = {}
        quiet = np.logaddexp(0, bias)  # -log(1 - p) of a sentence without weighted features

        def hits(word: str) -> tuple:
            got = known.get(word)
            if got is None:
                got = tuple(f for f in features(word) if f in weight)
                if len(known) < CACHE:
                    known[word] = got
            return got

        for batch in batches:
            scores, places = [], []
            for text in texts(batch):
                low, found, total = text.lower(), [], 0.0
                if not any(map(hits, set(low.split()))):
                    total = quiet * len(sentences(low))
                else:
                    same = len(low) == len(text)  # else offsets in the lower-case text are not the text's
                    for a, b in sentences(text):
                        got = {f for w in set((low[a:b] if same else text[a:b].lower()).split()) for f in hits(w)}
                        z = bias + sum(weight[f] for f in sorted(got))
                        total += np.logaddexp(0, z) if got else quiet
                        if got and (p := 1 / (1 + np.exp(-z))) >= threshold:
                            found.append({"start": a, "end": b, "score": float(p)})
                scores.append(float(-np.expm1(-total)))
                places.append(found)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(places, arrow)], ["doc_id", "score", "offending"])

    ids = docs.schema[id_col].dataType.simpleString()
    return map_partitions(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {ids}, score double, offending {spans}")
