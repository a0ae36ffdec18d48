"""Personal data: fixed patterns, and terms that give protected entities away.

The entities are the e-mail addresses, IP addresses, card and phone numbers found in the corpus.
For an entity c and a term t beside it (no other entity between them), the corpus estimates what
share of c's information t discloses: PMI(c, t) / IC(c) = log(n(c,t) N / (n(c) n(t))) / log(N / n(c)),
counting documents. A term that only ever occurs with c discloses all of it. Evidence must come from
at least ``MIN_CONTEXTS`` different surroundings of c, so copies of one text prove nothing: of a term
near c each of them counts, of a term further away one a document. On that scale a rare entity is
mostly disclosed by any rare word that met it a few times, so two more things are asked: the term
must tell c in at least ``SURE`` of its own documents, and so many together must be beyond chance,
whatever the number of pairs that were looked at (``CHANCE`` over all of them, by Chernoff's bound on
the binomial tail). Terms over the upper threshold are removed, those over the lower one generalised
to their class, wherever they stand: in the texts that name c and in those that don't.

Texts are read by three passes, the last two only if some pair has the evidence: the first emits
the entities, the words around them and the terms of texts with entities, the second pre-summed
document frequencies, the third marks. Pairs are counted by (entity, term) with map-side sums.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, landed, map_batches, map_partitions, texts

KINDS = ("email", "ip", "card", "phone")
REACH, MIN_CONTEXTS, GENERALISE, REMOVE = 5, 3, 0.6, 0.9
SURE, CHANCE = 0.5, 0.01
MAX_BROADCAST = 100_000  # disclosing terms, or entities, that are broadcast; more are joined by shuffle
FLUSH = 300_000  # distinct terms a task holds before it emits their counts
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, found from each @ (a plain search would try every
    start inside a long word)."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m.group().split("."))):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return out


def written(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def term_of(word: str) -> str:
    """A word as a term: lower case, without marks at its ends; empty unless it has a letter and at
    least three characters."""
    s, e = 0, len(word)
    while s < e and not word[s].isalnum():
        s += 1
    while e > s and not word[e - 1].isalnum():
        e -= 1
    term = word[s:e].lower()
    return term if len(term) >= 3 and any(map(str.isalpha, term)) else ""


def _entity(kind: str, value: str) -> int:
    value = value.lower() if kind == "email" else "".join(c for c in value if c.isdigit() or kind == "ip")
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}") - (1 << 63)


def surroundings(text: str, spans) -> tuple[dict[int, int], list[tuple[int, str, int]]]:
    """The entities, each with the lowest hash of its surroundings, and (entity, term, hash of the
    surroundings) of the terms near each span."""
    first, out = {}, []
    for kind, start, end in spans:
        entity = _entity(kind, text[start:end])
        lo = start
        for _ in range(REACH + 1):  # the words before, a partial word included
            lo = _back(text, lo)
        around = []
        for m in _WORD.finditer(text, lo, start):
            around.append(m.span())
        around, after = around[-REACH:], []
        for m in _WORD.finditer(text, end):
            after.append(m.span())
            if len(after) == REACH:
                break
        around += after
        words = [text[s:e] for s, e in around]
        where = xxhash.xxh3_64_intdigest("\x1f".join(words).lower()) - (1 << 63)
        first[entity] = min(where, first.get(entity, where))
        for (s, e), word in zip(around, words):
            if (t := term_of(word)) and not any(s < b and a < e for _, a, b in spans):
                out.append((entity, t, where))
    return first, out


def _back(text: str, at: int) -> int:
    """Where the word before ``at`` starts."""
    blanks = " \t\n\x0b\x0c\r"
    while at > 0 and text[at - 1] in blanks:
        at -= 1
    while at > 0 and text[at - 1] not in blanks:
        at -= 1
    return at


def outside(text: str, spans) -> list[tuple[int, int]]:
    """(start, end) of the text between spans: what is left of a word beside a span is a word."""
    out, at = [], 0
    for s, e in sorted((s, e) for _, s, e in spans):
        if s > at:
            out.append((at, s))
        at = max(at, e)
    return [*out, (at, len(text))]


def marked(text: str, spans, action: dict[str, str], known: dict[str, str]) -> list[tuple[int, int, str]]:
    """(start, end, action) of every word outside ``spans`` whose term has an action. ``known``
    keeps the terms of words."""
    out = []
    for a, b in outside(text, spans):
        hit = {}
        for word in set(_WORD.findall(text, a, b)):
            term = known.get(word)
            if term is None:
                term = term_of(word)
                if len(known) < FLUSH:
                    known[word] = term
            if term in action:
                hit[word] = action[term]
        if hit:
            out += [(*m.span(), hit[m.group()]) for m in _WORD.finditer(text, a, b) if m.group() in hit]
    return out


def beside(text: str, spans) -> dict[int, set[str]]:
    """By entity, the terms between its spans and the next ones before and after: each word is
    counted for two entities at most, however many a text has."""
    ordered = sorted((s, e, k) for k, s, e in spans)
    out: dict[int, set[str]] = {}
    for i, (a, b) in enumerate(zip([0, *(e for _, e, _ in ordered)], [*(s for s, _, _ in ordered), len(text)])):
        found = {t for m in _WORD.finditer(text, a, b) if (t := term_of(m.group()))} if a < b else set()
        for s, e, k in ordered[max(0, i - 1) : i + 1]:
            out.setdefault(_entity(k, text[s:e]), set()).update(found)
    return out


_NEAR = "array<struct<entity:bigint,term:string,context:bigint>>"
_NEAR_ARROW = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string()), ("context", pa.int64())]))
_ENTITIES = "array<struct<entity:bigint,context:bigint,terms:array<string>>>"
_ENTITIES_ARROW = pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("terms", pa.list_(pa.string()))]))
_TERMS = "array<struct<start:int,end:int,action:string>>"
_TERMS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("action", pa.string())]))
_HITS = "array<struct<term:string,action:string>>"


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, entities, near) of every row; an entity has
    the lowest hash of its surroundings and the terms beside it."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, base, entities, near = [[] for _ in KINDS], [], [], []
        for text in texts(batch):
            spans = base_spans(text)
            n = Counter(k for k, *_ in spans)
            for c, k in zip(counts, KINDS):
                c.append(n[k])
            base.append(written(spans))
            first, around = surroundings(text, spans) if spans else ({}, [])
            terms = beside(text, spans) if spans else {}
            entities.append([{"entity": c, "context": w, "terms": sorted(terms[c])} for c, w in first.items()])
            near.append([dict(zip(("entity", "term", "context"), x)) for x in around])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(entities, _ENTITIES_ARROW), pa.array(near, _NEAR_ARROW)],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base", "entities", "near"],
        )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ids = docs.schema[id_col].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {ids}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, entities {_ENTITIES}, near {_NEAR}")


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): the number of rows whose text has the term."""

    def run(batches):
        known: dict[bytes, str] = {}
        counts: Counter[str] = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
            counts.clear()
            known.clear()
            return batch

        for batch in batches:
            for text in texts(batch):
                terms = set()
                for word in set(text.encode("utf-8", "surrogatepass").split()):  # bytes: ASCII blanks only
                    term = known.get(word)
                    if term is None:
                        known[word] = term = term_of(word.decode("utf-8", "surrogatepass"))
                    terms.add(term)
                terms.discard("")
                counts.update(terms)
                if len(counts) > FLUSH or len(known) > 2 * FLUSH:
                    yield out()
        if counts:
            yield out()

    return map_partitions(docs.select(F.col(text_col).alias("text")), run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing(
    seen: DataFrame, docs: DataFrame, min_contexts: int = MIN_CONTEXTS, lower: float = GENERALISE, text_col: str = "text", sure: float = SURE, chance: float = CHANCE
) -> DataFrame:
    """(entity, term, share): pairs in which the term discloses at least ``lower`` of the entity, in at
    least ``sure`` of the term's documents, beyond ``chance``."""
    pair = ["entity", "term"]
    near = seen.select(F.explode(F.array_distinct("near")).alias("x")).select("x.*").distinct()
    near = landed(near.groupBy(*pair).agg(F.count("*").alias("contexts")).where(F.col("contexts") >= min_contexts).select(*pair))
    own = seen.select(F.inline("entities")).groupBy("entity", "context").agg(F.count("*").alias("n"))
    own = landed(own.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("contexts")))
    able = landed(own.where(F.col("contexts") >= min_contexts).select("entity").union(near.select("entity")).distinct())
    n_able = able.count()
    if not n_able:
        return near.select(*pair, F.lit(0.0).alias("share"))
    able = F.broadcast(able) if n_able <= MAX_BROADCAST else able
    both = seen.select(F.inline("entities")).join(able, "entity", "left_semi").select("entity", "context", F.explode("terms").alias("term"))
    both = both.groupBy(*pair, "context").agg(F.count("*").alias("n")).groupBy(*pair).agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts"))
    both = landed(both)
    tested = both.count()
    pairs = landed(both.join(near.withColumn("near", F.lit(True)), pair, "left").where((F.col("contexts") >= min_contexts) | F.col("near")).select(*pair, "n_both"))
    if pairs.isEmpty():
        return pairs.select(*pair, F.lit(0.0).alias("share"))
    # Frequencies of the wanted terms only, written before a frequent term's pairs are joined to its row.
    wanted = landed(pairs.select("term").distinct())
    terms = landed(document_frequencies(docs, text_col).join(wanted, "term").withColumnRenamed("n", "n_whole"))
    n = float(seen.count())
    scored = pairs.join(own, "entity").join(terms, "term", "left").where("n_entity < %r" % n)
    n_term = F.greatest("n_whole", "n_both")  # beside a span, what is left of a word is a term too
    told, base = F.col("n_both") / n_term, F.col("n_entity") / n
    pmi, ic = F.log(told / base), -F.log(base)
    miss = F.when(told < 1, (1 - told) * F.log((1 - told) / (1 - base))).otherwise(0.0)
    beyond = (told > base) & (n_term * (told * pmi + miss) >= math.log(max(1, tested) / chance))
    scored = scored.where((told >= sure) & beyond) if sure > 0 else scored
    return landed(scored.select(*pair, (pmi / ic).alias("share")).where(F.col("share") >= lower))


def with_actions(docs: DataFrame, shares: DataFrame, name: str, id_col: str, text_col: str, upper: float = REMOVE):
    """(``docs`` plus the column ``name``, broadcast {term: action}). Up to ``MAX_BROADCAST`` terms
    are broadcast and ``name`` is null; of more, ``name`` has the (term, action) of the row's own
    terms, joined by shuffle."""
    action = F.when(F.max("share") >= upper, "remove").otherwise("generalise")
    actions = landed(shares.groupBy("term").agg(action.alias("action")))
    sc = docs.sparkSession.sparkContext
    if actions.count() <= MAX_BROADCAST:
        return docs.withColumn(name, F.lit(None).cast(_HITS)), sc.broadcast({r.term: r.action for r in actions.collect()})

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = []
        for text in texts(batch):
            words = {w for a, b in outside(text, base_spans(text)) for w in _WORD.findall(text, a, b)}
            terms.append(sorted({t for w in words if (t := term_of(w))}))
        return pa.RecordBatch.from_arrays([batch.column("d"), batch.column("h"), pa.array(terms, pa.list_(pa.string()))], ["d", "h", "terms"])

    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    terms = map_batches(rows, run, f"d {docs.schema[id_col].dataType.simpleString()}, h long, terms array<string>")
    hits = terms.select("d", "h", F.explode("terms").alias("term")).join(actions, "term")
    hits = hits.groupBy("d", "h").agg(F.collect_set(F.struct("term", "action")).alias(name))  # equal rows have one set
    columns = [docs[c] for c in docs.columns]
    return docs.join(hits, docs[id_col].eqNullSafe(hits["d"]) & (F.xxhash64(docs[text_col]) == hits["h"]), "left").select(*columns, hits[name]), sc.broadcast({})


def _actions(shared: dict[str, str], hits) -> dict[str, str]:
    return {x["term"]: x["action"] for x in hits} if hits else shared


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, terms): one row per row of ``docs``.

    ``base`` has the pattern spans as kind:start:end, ``terms`` all disclosing words of the text
    with their action. A null text counts as empty: no spans. Repeated ids and rows are judged row
    by row (rows with the same id and text get the same result); a null id stays null. An empty
    table gives an empty result; other columns aren't read.
    """
    seen = landed(found(docs, id_col, text_col))
    shares = disclosing(seen, docs, text_col=text_col)
    if shares.isEmpty():
        return seen.select("doc_id", *(f"n_{k}" for k in KINDS), "base", F.array().cast(_TERMS).alias("terms"))
    rows, shared = with_actions(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shares, "hits", "doc_id", "text")

    def run(batches):
        known: dict[str, str] = {}
        for batch in batches:
            counts, base, terms = [[] for _ in KINDS], [], []
            for text, hits in zip(texts(batch), batch.column("hits").to_pylist()):
                spans = base_spans(text)
                n = Counter(k for k, *_ in spans)
                for c, k in zip(counts, KINDS):
                    c.append(n[k])
                base.append(written(spans))
                action = _actions(shared.value, hits)
                terms.append([dict(zip(("start", "end", "action"), m)) for m in marked(text, spans, action, known)] if action else [])
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(terms, _TERMS_ARROW)],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base", "terms"],
                )

    ids = docs.schema[id_col].dataType.simpleString()
    return map_partitions(rows, run, f"doc_id {ids}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, terms {_TERMS}")


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns of ``detect``: the hash of the pattern spans, and all spans."""
    terms = F.array_join(F.transform("terms", lambda t: F.concat(F.lit("term:"), t.start.cast("string"), F.lit(":"), t.end.cast("string"))), ",")
    base = F.when(F.col("base") != "", F.col("base"))
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.col("base"), 256).alias("base_sha256"),
                       F.concat_ws(",", base, F.when(terms != "", terms)).alias("spans"))


def redact(text: str, terms) -> str:
    """``text`` with its pattern spans and the given (start, end, action) words replaced.
    Overlapping spans are replaced as one, by the mark of the first (of those, the longest)."""
    marks = [(s, e, f"<{k.upper()}>") for k, s, e in base_spans(text)]
    marks += [(s, e, "" if a == "remove" else "<TERM>") for s, e, a in terms]
    out, at, done = [], 0, 0
    for s, e, mark in sorted(marks, key=lambda m: (m[0], -m[1])):
        if s < done:
            done = at = max(done, e)
            continue
        out += [text[at:s], mark]
        at = done = e
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced: pattern spans by their kind in angle
    brackets, disclosing words removed or generalised to <TERM>. Null texts stay null; rows and
    other columns stay as they are."""
    seen = landed(found(docs, id_col, text_col))
    columns, h = docs.columns, fresh(docs, "_hits")
    rows, shared = with_actions(docs, disclosing(seen, docs, text_col=text_col), h, id_col, text_col)

    def run(batches):
        known: dict[str, str] = {}
        for batch in batches:
            clean = []
            for x, hits in zip(batch.column(text_col).to_pylist(), batch.column(h).to_pylist()):
                action = _actions(shared.value, hits)
                clean.append(None if x is None else redact(x, marked(x, base_spans(x), action, known) if action else ()))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(clean, pa.string()) if c == text_col else batch.column(c) for c in columns], columns)

    return map_partitions(rows, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
