"""Document fingerprints from content-defined chunks.

A rolling gear hash over 16 bytes puts chunk boundaries where the content says so, with normalised
chunking: a strict mask up to the usual chunk length, a lax one beyond it. An insertion moves the
boundaries near it only, so most chunks survive edits and shifts. The fingerprint is the set of
chunk digests with their lengths; containment is the share of a document's distinct chunk bytes
that another document's fingerprint also has.

Neighbours in id order are found without one global order: ids are cut into ranges at approximate
quantiles, and each range also gets a copy of the next range's first document.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerlake.llm.common import map_batches, map_partitions, texts

WINDOW, LEAST, USUAL, MOST = 16, 16, 32, 128
STRICT, LAX = 7, 4  # leading zero bits before and after the usual length
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
_BLOCK = 4 << 20


def _candidates(data: bytes) -> tuple[list[int], list[int]]:
    """Positions whose hash passes the strict and the lax mask, in blocks that overlap a window."""
    strict, lax = [], []
    for at in range(0, len(data), _BLOCK):
        lead = min(at, WINDOW - 1)
        h = _GEAR[np.frombuffer(data, np.uint8, min(_BLOCK, len(data) - at) + lead, at - lead)]
        k = 1
        while k < WINDOW:
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
            k *= 2
        found = np.flatnonzero(h < np.uint32(1 << (32 - LAX)))
        found = found[found >= lead]
        lax.append(found + (at - lead))
        strict.append(found[h[found] < np.uint32(1 << (32 - STRICT))] + (at - lead))
    join = lambda x: np.concatenate(x).tolist() if x else []
    return join(strict), join(lax)


def boundaries(datas: list[bytes]) -> list[list[int]]:
    """The chunk ends of each of ``datas``; none for an empty one."""
    out, group, size = [], [], 0
    for data in [*datas, None]:
        if data is not None:
            group.append(data)
            size += len(data)
        if data is None or size >= _BLOCK:
            strict, lax = _candidates(b"".join(group))
            base = 0
            for x in group:
                out.append(_cuts(base, base + len(x), strict, lax))
                base += len(x)
            group, size = [], 0
    return out


def _cuts(start: int, end: int, strict: list[int], lax: list[int]) -> list[int]:
    """Chunk ends, relative to ``start``. A window never reaches back over a chunk's start, as
    chunks are at least a window long."""
    ends, s = [], start
    while s < end:
        e = end
        if end - s > LEAST:
            i = bisect_left(strict, s + LEAST - 1)
            if i < len(strict) and strict[i] < s + USUAL - 1:
                e = strict[i] + 1
            else:
                i = bisect_left(lax, s + USUAL - 1)
                e = lax[i] + 1 if i < len(lax) and lax[i] < s + MOST - 1 else s + MOST
            e = min(e, end)
        ends.append(e - start)
        s = e
    return ends


def _digests(data: bytes, ends: list[int], start: int = 0) -> dict[int, int]:
    """Length by digest of the chunks of ``data`` from ``start``."""
    out, digest = {}, xxhash.xxh32_intdigest
    for e in ends:
        out[digest(data[start:e])] = e - start
        start = e
    return out


def written(chunks: dict[int, int]) -> str:
    """Ten hexadecimal digits a chunk, by digest: eight of the digest, two of the length."""
    return "".join([f"{d:08x}{n:02x}" for d, n in sorted(chunks.items())])


def read(fingerprint: str) -> dict[int, int]:
    return {int(fingerprint[i : i + 8], 16): int(fingerprint[i + 8 : i + 10], 16) for i in range(0, len(fingerprint), 10)}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's chunk bytes that b has; of two empty ones 1, of one empty one 0."""
    total = sum(a.values())
    if not total:
        return float(not b)
    return sum([n for d, n in a.items() if d in b]) / total


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    return written(_digests(data, boundaries([data])[0]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; the fingerprint of a null or empty text is empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        datas = [t.encode("utf-8", "surrogatepass") for t in texts(batch)]
        prints = [written(_digests(x, e)) for x, e in zip(datas, boundaries(datas))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    ids = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {ids}, fingerprint string")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (sorted) up to ``value``, looked up in two steps; null counts as last."""
    step = max(1, int(len(bounds) ** 0.5))
    heads = F.array(*[F.lit(b) for b in bounds[::step]])
    parts = F.array(*[F.array(*[F.lit(b) for b in bounds[i : i + step]]) for i in range(0, len(bounds), step)])
    head = F.size(F.filter(heads, lambda b: b <= value))
    inner = F.size(F.filter(F.element_at(parts, F.greatest(head, F.lit(1))), lambda b: b <= value))
    found = F.when(head == 0, F.lit(0)).otherwise((head - 1) * step + inner)
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(found).cast("int")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, last, doc_id, text): rows range-partitioned and ordered by (id, text), nulls last.

    Each range ends with a row marked ``last``: a copy of the first row of the next range that has
    rows (after the last: of the first). Ids are read once for the quantiles and once for each
    range's first id, one row a range; the texts are moved once. Ids must be integers, a TypeError says so.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer column, since ids are ranged as 64-bit numbers")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = rows.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], max(10_000, 20 * n))).first()[0] or []
    bounds = sorted(set(cuts)) if n > 1 else []
    part = _range_of(F.col("doc_id"), bounds) if bounds else F.lit(0)
    firsts = ids.groupBy(part.alias("part")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("id")).orderBy("part").collect()  # a row a range
    if not firsts:
        return rows.select(F.lit(0).alias("part"), F.lit(False).alias("last"), "doc_id", "text")
    after = [(firsts[(i + 1) % len(firsts)].id, r.part) for i, r in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(after, "head long, before int"))  # a row a range
    both = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("head")), "left")
    places = F.array_compact(F.array(
        F.struct(part.alias("part"), F.lit(False).alias("last")),
        F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("part"), F.lit(True).alias("last"))),
    ))
    dealt = both.select(F.inline(places), "doc_id", "text").repartitionById(len(bounds) + 1, F.col("part"))
    return dealt.sortWithinPartitions("part", "last", F.col("doc_id").asc_nulls_last(), "text")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last quarter (rounded down, in code points) replaced by as many first
    code points of the next document, or all of them if it has fewer. Documents are ordered by id,
    equal ids by text, null ids last; the first follows the last, and a single document follows
    itself. ``near_*`` is the containment of the fingerprint in the other one. A null text counts
    as empty: its fingerprint is empty and lies in empty ones only. One row per row of ``docs``; an
    empty table gives an empty result; other columns aren't read.
    """

    def run(batches):
        held = None  # (part, id, text, data, chunk ends, chunks) of the row whose next isn't known yet
        for batch in batches:
            rows = list(zip(batch.column("part").to_pylist(), batch.column("last").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch)))
            datas = [t.encode("utf-8", "surrogatepass") for *_, t in rows]
            pairs = []
            for (part, last, doc_id, text), data, ends in zip(rows, datas, boundaries(datas)):
                this = (part, doc_id, text, data, ends, _digests(data, ends))
                if held is not None and held[0] == part:
                    pairs.append((held, this))
                    held = None
                if not last:
                    held = this
            if pairs:
                yield _compared(pairs)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_partitions(with_next(docs, id_col, text_col), run, schema)


def _compared(pairs) -> pa.RecordBatch:
    heads, tails = [], []
    for (_, _, text, data, ends, _), (_, _, after, *_) in pairs:
        k = len(text) // 4
        kept = len(text[: len(text) - k].encode("utf-8", "surrogatepass")) if k else len(data)
        whole = bisect_left(ends, kept + 1) if k else len(ends)  # chunks that end before the edit
        if k and whole and whole == len(ends):
            whole -= 1
        from_ = ends[whole - 1] if whole else 0
        heads.append((whole, from_))
        tails.append(data[from_:kept] + after[:k].encode("utf-8", "surrogatepass") if k else b"")
    out = [[] for _ in range(7)]
    for ((_, doc_id, text, data, ends, chunks), (*_, other)), (whole, from_), tail, cuts in zip(pairs, heads, tails, boundaries(tails)):
        edited = dict(_digests(data, ends[:whole]))
        edited.update(_digests(tail, cuts))
        sha = hashlib.sha256(data[:from_])
        sha.update(tail)
        values = (doc_id, len(text), sha.hexdigest(), written(chunks), written(edited), containment(chunks, edited), containment(chunks, other))
        for column, value in zip(out, values):
            column.append(value)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
