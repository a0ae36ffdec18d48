"""Exact substring removal by distributed suffix sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier. The suffixes of a
text, cut to that length, can't all be shuffled, so they travel in runs: the leading token of a
suffix is the ``TOKEN``-byte gram with the lowest hash in it, and consecutive suffixes with the
same token occurrence form one run (its bytes hold them all). Equal suffixes have equal tokens, and
equal positions within their runs' tokens, so only runs with the same token need comparing:

1. Runs are range-partitioned by token with sampled splitters, as two hashes (token, whole run)
   and a position. Ranges grow in number with the bytes of the texts, so one stays small enough to
   be sorted in a task's memory. Within a range, runs are sorted; a run that also occurs earlier goes whole.
   Each task first does the same with its own rows, so a passage or a group of copies that fills a
   third of the corpus reaches a range as one row a task. Tokens that fill more than a range are
   spread over several by run, and count as unsettled across the boundaries.
2. A run that is the first of its kind, but whose token has other kinds too (the edges of copied
   passages), is cut out of its text, and its suffixes are sorted by multikey quicksort on 8-byte
   characters; equal neighbours keep the earliest. Where a token has very many kinds, or is spread
   over ranges, its suffixes are sorted so in the task that cuts them out, which settles all but one
   of each kind; what is left is range-partitioned by sampled splitters, whole suffixes that may
   differ in any byte, and sorted again in each range. Equal suffixes always share a range.
3. The removed windows of each document are merged and cut out of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerlake.llm.common import map_partitions, texts, written

LENGTH, TOKEN = 100, 32
SPLITTER_DOCS, SPLITTER_RUNS = 1000, 2000  # documents sampled for splitters, and runs of each
RANGE = 16 << 20  # bytes of text whose runs a range is meant to hold, and half the bytes of suffixes sorted in one
CROWDED = 4096  # kinds of run of one token beyond which their suffixes are range-partitioned one by one
_FLUSH = 1 << 19  # runs a task gathers before it sends them
_BLOCK = 1 << 20
_LAST = (1 << 63) - 1  # stands for a null id: null ids come last
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _hashes(flat: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``TOKEN``-byte gram, by doubling."""
    h = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    n, power = 1, 0xFF51AFD7ED558CCD
    while n < TOKEN:
        h = h[:-n] * np.uint64(power) + h[n:]
        power = power * power % (1 << 64)
        n *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


def runs(datas: list[bytes], length: int = LENGTH):
    """(document number, start, suffixes, token hash, run hash) of the runs of ``datas``, in order."""
    lens = np.array([len(x) for x in datas], np.int64)
    flat = np.frombuffer(b"".join(datas), np.uint8)
    if len(flat) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    starts = np.cumsum(lens) - lens
    h = _hashes(flat)
    low = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
    width, n = length - TOKEN + 1, 1
    while 2 * n <= width:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if n < width:
        low = np.minimum(low[: len(low) - (width - n)], low[width - n :])
    at = (low & ~_HIGH).astype(np.int64)
    edge = np.zeros(len(flat) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + np.maximum(lens - length + 1, 0), -1)
    first = np.flatnonzero(np.cumsum(edge[: len(at)]) > 0)
    if not len(first):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    doc = np.searchsorted(starts, first, side="right") - 1
    # an empty document shares its start with the next one; the last of them holds the bytes
    token = at[first]
    cut = np.flatnonzero((token[1:] != token[:-1]) | (doc[1:] != doc[:-1])) + 1
    s = np.r_[0, cut]
    count = np.diff(np.r_[s, len(first)])
    begin = first[s]
    view = memoryview(flat)
    digest = xxhash.xxh3_64_intdigest
    whole = np.fromiter((digest(view[a : a + n + length - 1]) for a, n in zip(begin.tolist(), count.tolist())), np.uint64, len(s))
    return doc[s], begin - starts[doc[s]], count, h[token[s]], whole


def _pieces(batch: pa.RecordBatch):
    """The batch in pieces whose texts have about ``_BLOCK`` bytes, so that what is made of them stays small beside it."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(sizes) - sizes) // _BLOCK
    cuts = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)]
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        if a < b:
            yield batch.slice(a, b - a)


def _lists(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(where each row's entries begin and the last ones end, the entries' fields) of a column of lists of structs; null has no entries."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.r_[0, np.cumsum(counts, dtype=np.int64)], [x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten()]


def _order(g, s, doc, h, lo) -> np.ndarray:
    return np.lexsort((lo, h, doc, s, g))


def _settle(g, s, doc, h, lo):
    """(order, first of its kind, later than the first) of runs; a run at the same place as its
    predecessor (a repeated row) is neither."""
    o = _order(g, s, doc, h, lo)
    g, s, doc, h, lo = g[o], s[o], doc[o], h[o], lo[o]
    kind = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])] if len(o) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(kind, np.arange(len(o)), 0))
    later = (doc != doc[lead]) | (h != h[lead]) | (lo != lo[lead])
    return o, kind, later


_PACKED = "part int, g binary, s binary, doc binary, h binary, lo binary, n binary"
_COLUMNS = (("g", np.uint64), ("s", np.uint64), ("doc", np.int64), ("h", np.int64), ("lo", np.int32), ("n", np.int32))


def _packed(part: list[int], rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([np.ascontiguousarray(r[i], kind).tobytes() for r in rows], pa.binary()) for i, (_, kind) in enumerate(_COLUMNS)]
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *columns], ["part", *(n for n, _ in _COLUMNS)])


def _merged(doc, h, lo, n):
    """Windows that follow each other without a gap, as one."""
    o = np.lexsort((lo, h, doc))
    doc, h, lo, n = doc[o], h[o], lo[o], n[o]
    if not len(o):
        return doc, h, lo, n
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (lo[1:] > lo[:-1] + n[:-1])]
    at = np.flatnonzero(new)
    end = np.maximum.reduceat(lo + n, at)
    return doc[at], h[at], lo[at], end - lo[at]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, h, text): the place of a document in the order is its id, then its text's hash."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer column, since ids are sorted as 64-bit numbers")
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text_col).alias("h"),
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
    )


def _ranges(rows: DataFrame) -> tuple[int, int]:
    """(documents, ranges of their runs): as many as the session's shuffles have, and more where these would hold over ``RANGE`` bytes."""
    total, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    return total, max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // RANGE))


def _splitters(rows: DataFrame, total: int, n: int, length: int) -> np.ndarray:
    """``n`` - 1 token hashes that cut the runs of a bounded sample of the ``total`` documents into equal parts."""
    if n < 2 or not total:
        return np.zeros(0, np.uint64)

    def run(batches):
        for batch in batches:
            for text in texts(batch):
                _, _, _, g, _ = runs([text.encode("utf-8", "surrogatepass")], length)
                if len(g):
                    yield pa.RecordBatch.from_arrays([pa.array([g[:: len(g) // SPLITTER_RUNS + 1].tobytes()], pa.binary())], ["g"])

    some = rows.select("text").sample(min(1.0, SPLITTER_DOCS / total), 7)
    found = [np.frombuffer(r.g, np.uint64) for r in map_partitions(some, run, "g binary").collect()]  # about SPLITTER_DOCS rows
    if not found:
        return np.zeros(0, np.uint64)
    g = np.sort(np.concatenate(found))
    return g[[len(g) * i // n for i in range(1, n)]]


def _part_of(g: np.ndarray, s: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range of each run. A token that is several splitters, so fills a range, is spread over the ranges it touches."""
    lo, hi = np.searchsorted(splitters, g, "left"), np.searchsorted(splitters, g, "right")
    wide = np.where(hi - lo > 1, hi - lo + 1, 1)
    return lo + (s % wide.astype(np.uint64)).astype(np.int64)


def _runs_by_token(rows: DataFrame, splitters: np.ndarray, length: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(splitters)  # a token a range

    def run(batches):
        splitters, held, size, turn, task = shared.value, [], 0, 0, TaskContext.get().partitionId()

        def out():
            g, s, doc, h, lo, n = (np.concatenate(x) for x in zip(*held))
            o, kind, later = _settle(g, s, doc, h, lo)
            g, s, doc, h, lo, n = (x[o] for x in (g, s, doc, h, lo, n))
            part = _part_of(g[kind], s[kind], splitters)
            by = np.argsort(part, kind="stable")
            first = [x[kind][by] for x in (g, s, doc, h, lo, n)]
            part = part[by]
            cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]
            where = [int(part[a]) for a in cuts[:-1]]
            sent = [tuple(x[a:b] for x in first) for a, b in zip(cuts, cuts[1:])]
            if later.any():  # settled here; empty hashes mark them
                none = np.zeros(0, np.uint64)
                sent.append((none, none, *_merged(doc[later], h[later], lo[later], n[later])))
                where.append((task + turn) % (len(splitters) + 1))  # any range passes them on
            return _packed(where, sent)

        for batch in batches:
            for piece in _pieces(batch):
                docs, hs = piece.column("doc").to_numpy(), piece.column("h").to_numpy()
                i, lo, n, g, s = runs([t.encode("utf-8", "surrogatepass") for t in texts(piece)], length)
                if len(i):
                    held.append((g, s, docs[i], hs[i], lo, n))
                    size += len(i)
                if size >= _FLUSH:
                    yield out()
                    held, size, turn = [], 0, turn + 1
        if held:
            yield out()

    return map_partitions(rows.select("doc", "h", "text"), run, _PACKED)


def _settled(packed: DataFrame, splitters: np.ndarray) -> DataFrame:
    """(doc, h, lo, n, kind, g): kind 0 removed windows, 1 first runs of an unsettled token, 2 the
    same of a crowded token."""
    tokens, times = np.unique(splitters, return_counts=True)
    shared = packed.sparkSession.sparkContext.broadcast(tokens[times > 1])  # those spread over ranges

    def rows(doc, h, lo, n, kind, g):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(x, t)) for x, t in ((doc, np.int64), (h, np.int64), (lo, np.int32), (n, np.int32), (kind, np.int32), (g.view(np.int64), np.int64))],
            ["doc", "h", "lo", "n", "kind", "g"],
        )

    def run(batches):
        held = []
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name, _ in _COLUMNS)):
                g, s, doc, h, lo, n = (np.frombuffer(x, kind) for x, (_, kind) in zip(row, _COLUMNS))
                if len(g):
                    held.append((g, s, doc, h, lo, n))
                else:
                    yield rows(doc, h, lo, n, np.zeros(len(doc)), np.zeros(len(doc), np.uint64))
        if not held:
            return
        g, s, doc, h, lo, n = (np.concatenate(x) for x in zip(*held))
        held.clear()
        o, first, later = _settle(g, s, doc, h, lo)
        g, s, doc, h, lo, n = (x[o] for x in (g, s, doc, h, lo, n))
        if later.any():
            gone = _merged(doc[later], h[later], lo[later].astype(np.int64), n[later].astype(np.int64))
            yield rows(*gone, np.zeros(len(gone[0])), np.zeros(len(gone[0]), np.uint64))
        at = np.flatnonzero(first)
        token, inverse, kinds = np.unique(g[at], return_inverse=True, return_counts=True)
        spread = np.isin(token, shared.value)
        keep = ((kinds > 1) | spread)[inverse]
        crowded = (kinds > CROWDED) | spread | (np.bincount(inverse, n[at], len(token)) > _FLUSH)  # long runs are as many suffixes
        at = at[keep]
        if len(at):
            yield rows(doc[at], h[at], lo[at], n[at], np.where(crowded[inverse][keep], 2, 1), g[at])

    return map_partitions(packed.repartitionById(len(splitters) + 1, F.col("part")), run, "doc long, h long, lo int, n int, kind int, g long")


def equal_suffixes(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``at``, group): the suffixes of ``data`` whose first ``length`` bytes occur more
    than once. Multikey quicksort with 8-byte characters: one character sorts the whole lot, and
    only suffixes that are still tied go on to the next."""
    live, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    if not len(at):
        return live, group
    word = np.lib.stride_tricks.sliding_window_view(data, 8)
    for off in [*range(0, length - 8, 8), length - 8]:
        key = np.ascontiguousarray(word[at[live] + off]).view(">u8").ravel().astype(np.uint64)
        o = np.lexsort((key, group))
        live, group, key = live[o], group[o], key[o]
        new = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])] if len(o) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        tied = np.bincount(number, minlength=1)[number] > 1 if len(o) else new
        live, group = live[tied], number[tied]
        if not len(live):
            break
    return live, group


def _dealt(df: DataFrame, n_ranges: int) -> DataFrame:
    """``df`` dealt by document, over as many tasks as there are ranges, since the texts are dealt so too."""
    return df.repartition(n_ranges, "doc", "h")


def _with_texts(checks: DataFrame, rows: DataFrame, n_ranges: int = 0) -> DataFrame:
    """(doc, h, text, runs): the texts that have runs in ``checks``, with them. Without ``n_ranges`` these
    are a bounded sample, to be broadcast."""

    def wanted(checks):
        return checks.groupBy("doc", "h").agg(F.collect_list(F.struct("lo", "n", "g")).alias("runs"))  # within one document

    found = rows.select("doc", "h", "text")
    if not n_ranges:
        return found.join(F.broadcast(wanted(checks)), ["doc", "h"])
    return _dealt(found, n_ranges).join(wanted(_dealt(checks, n_ranges)), ["doc", "h"])


def _cut(batch: pa.RecordBatch, length: int):
    """(token, doc, h, start, bytes) of the runs that come with the texts."""
    ends, fields = _lists(batch.column("runs"))
    lo, n, g = (x.tolist() for x in fields)
    for i, (doc, h, text) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("h").to_pylist(), texts(batch))):
        data = text.encode("utf-8", "surrogatepass")
        for k in range(ends[i], ends[i + 1]):
            yield g[k], doc, h, lo[k], data[lo[k] : lo[k] + n[k] + length - 1]


def _cut_out(checks: DataFrame, rows: DataFrame, length: int, n_ranges: int) -> DataFrame:
    """The unsettled runs with their bytes."""

    def run(batches):
        for piece in (p for batch in batches for p in _pieces(batch)):
            cut = list(zip(*_cut(piece, length)))
            if cut:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cut, kinds)], ["g", "doc", "h", "lo", "data"])

    return map_partitions(_with_texts(checks, rows, n_ranges), run, "g long, doc long, h long, lo int, data binary")


def _suffixes(cut: list[tuple], length: int):
    """(bytes of all runs, where each suffix starts in them, doc, h, start in the text)."""
    lens = np.array([len(r[4]) for r in cut])
    starts, counts = np.cumsum(lens) - lens, lens - length + 1
    which = np.repeat(np.arange(len(cut)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    doc, h, lo = (np.array([r[i] for r in cut], np.int64)[which] for i in (1, 2, 3))
    return np.frombuffer(b"".join([r[4] for r in cut]), np.uint8), starts[which] + inside, doc, h, lo + inside


def _later(data, at, doc, h, lo, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes: (later ones of equal suffixes, all that aren't the first of theirs)."""
    live, group = equal_suffixes(data, at, length)
    if not len(live):
        return live, live
    o = np.lexsort((lo[live], h[live], doc[live], group))
    live, group = live[o], group[o]
    new = np.r_[True, group[1:] != group[:-1]]
    lead = live[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
    elsewhere = (doc[live] != doc[lead]) | (h[live] != h[lead]) | (lo[live] != lo[lead])  # a repeated row is no later place
    return live[elsewhere], live[~new]


def _spans(doc, h, lo) -> pa.RecordBatch:
    out = _merged(doc, h, lo, np.ones(len(doc), np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(out, (np.int64, np.int64, np.int32, np.int32))], ["doc", "h", "lo", "n"])


def _by_range(checks: DataFrame, rows: DataFrame, length: int, n_ranges: int) -> DataFrame:
    """(doc, h, lo, n): the later ones of equal suffixes of crowded runs, whose first ones meet in
    ranges of sorted suffixes: ``n_ranges``, and more where these would hold over 2 ``RANGE`` bytes."""
    both = _with_texts(checks, rows, n_ranges)
    kind = f"S{length}"
    total, suffixes = checks.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_ranges = max(n_ranges, -(-suffixes * (length + 24) // (2 * RANGE)))

    def sample(batches):
        for piece in (p for batch in batches for p in _pieces(batch)):
            for _, _, _, _, data in _cut(piece, length):
                yield pa.RecordBatch.from_arrays([pa.array([data[i : i + length] for i in range(0, len(data) - length + 1, 16)], pa.binary())], ["s"])

    some = checks.sample(min(1.0, max(4 * SPLITTER_DOCS, 4 * n_ranges) / total), 7)  # about 4,000 runs of 5 suffixes, and 4 of them a range
    # Each once: of equal suffixes, however many, little more than one a task is sent.
    found = np.unique(np.array([r["s"] for r in map_partitions(_with_texts(some, rows), sample, "s binary").collect()], kind))
    splitters = found[[len(found) * i // n_ranges for i in range(1, n_ranges)]] if len(found) else found
    shared = rows.sparkSession.sparkContext.broadcast(splitters)
    columns = ("keys", "doc", "h", "lo")

    def packed(part: list[int], arrays: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array([a[i].tobytes() for a in arrays], pa.binary()) for i in range(4))], ["part", *columns])

    def first(batches):
        held, size, turn, task = [], 0, 0, TaskContext.get().partitionId()

        def out():
            data, at, doc, h, lo = _suffixes(held, length)
            gone, not_first = _later(data, at, doc, h, lo, length)
            keep = np.ones(len(at), bool)
            keep[not_first] = False
            keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[at[keep]])
            by = np.argsort(keys.view(kind).ravel(), kind="stable")  # neighbours share their first bytes, which packs them well
            part = np.searchsorted(shared.value, keys.view(kind).ravel(), "right")
            cuts = np.r_[0, np.flatnonzero(np.diff(part[by])) + 1, len(by)]
            places = [x[keep][by] for x in (doc, h, lo)]
            sent = [(keys[by[a:b]], *(x[a:b] for x in places)) for a, b in zip(cuts, cuts[1:])]
            where = [int(part[by[a]]) for a in cuts[:-1]]
            if len(gone):  # settled here; without keys any range passes them on
                sent.append((np.zeros(0, np.uint8), doc[gone], h[gone], lo[gone]))
                where.append((task + turn) % (len(shared.value) + 1))
            return packed(where, sent)

        for piece in (p for batch in batches for p in _pieces(batch)):
            for r in _cut(piece, length):
                held.append(r)
                size += len(r[4]) - length + 1
                if size >= _FLUSH // 2:
                    yield out()
                    held, size, turn = [], 0, turn + 1
        if held:
            yield out()

    def last(batches):
        held = []
        for batch in batches:
            for keys, *places in zip(*(batch.column(c).to_pylist() for c in columns)):
                doc, h, lo = (np.frombuffer(x, np.int64) for x in places)
                if keys:
                    held.append((np.frombuffer(keys, np.uint8), doc, h, lo))
                else:
                    yield _spans(doc, h, lo)
        if held:
            data, doc, h, lo = (np.concatenate(x) for x in zip(*held))
            gone, _ = _later(data, np.arange(len(doc)) * length, doc, h, lo, length)
            if len(gone):
                yield _spans(doc[gone], h[gone], lo[gone])

    sent = map_partitions(both, first, "part int, keys binary, doc binary, h binary, lo binary")
    return map_partitions(sent.repartitionById(len(splitters) + 1, F.col("part")), last, "doc long, h long, lo int, n int")


def _by_sorting(cut: DataFrame, length: int, n_ranges: int) -> DataFrame:
    """(doc, h, lo, n): the later ones of equal suffixes, sorted in batches of whole tokens."""

    def gone(rows) -> pa.RecordBatch | None:
        data, at, doc, h, lo = _suffixes(rows, length)
        later, _ = _later(data, at, doc, h, lo, length)
        return _spans(doc[later], h[later], lo[later]) if len(later) else None

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= _BLOCK and row[0] != held[-1][0]:
                    if (out := gone(held)) is not None:
                        yield out
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held and (out := gone(held)) is not None:
            yield out

    return map_partitions(cut.repartition(n_ranges, "g").sortWithinPartitions("g"), run, "doc long, h long, lo int, n int")


def repeated(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, h, lo, n): runs of start positions whose ``length`` bytes also start earlier."""
    rows = _rows(docs, id_col, text_col)
    return _repeated(rows, *_ranges(rows), length)


def _repeated(rows: DataFrame, total: int, n: int, length: int) -> DataFrame:
    splitters = _splitters(rows, total, n, length)
    found = written(_settled(_runs_by_token(rows, splitters, length), splitters))
    spans = found.where("kind = 0").select("doc", "h", "lo", "n")
    sorted_ = _by_sorting(_cut_out(found.where("kind = 1"), rows, length, n), length, n)
    out = spans.union(sorted_)
    crowded = found.where("kind = 2")
    return out if crowded.isEmpty() else out.union(_by_range(crowded, rows, length, n))


def deduplicate(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): what is cut out of each text, and the bytes that remain.

    Texts are UTF-8 bytes, matches never cross documents and are judged on the input. A byte goes
    if a ``length``-byte string over it also starts at a smaller id, or earlier in the same
    document. ``spans`` are the maximal removed runs of bytes, (start, end).

    A null text is empty. Rows with one id but different texts are ordered by the text's hash;
    equal rows stand at one place, so neither removes the other and they get equal results. Null
    ids come last; ids must be integers, a TypeError says so. An empty table gives an empty result;
    other columns aren't read.
    """
    rows = _rows(docs, id_col, text_col)
    total, n = _ranges(rows)
    spans = _dealt(_repeated(rows, total, n, length), n)
    gone = spans.groupBy("doc", "h").agg(F.collect_list(F.struct("lo", "n")).alias("gone"))  # within one document
    both = _dealt(rows, n).join(gone, ["doc", "h"], "left").select("doc_id", "text", "gone")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for piece in (p for batch in batches for p in _pieces(batch)):
            sizes, removed, kept = [], [], []
            ends, (lo, n) = _lists(piece.column("gone"))
            for i, text in enumerate(texts(piece)):
                data, merged = text.encode("utf-8", "surrogatepass"), []
                gone = slice(ends[i], ends[i + 1])
                for s, e in sorted(zip(lo[gone].tolist(), (lo[gone] + n[gone] + (length - 1)).tolist())):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                at, left = 0, []
                for s, e in merged:
                    left.append(data[at:s])
                    at = e
                sizes.append(len(data))
                removed.append([{"start": s, "end": e} for s, e in merged])
                kept.append(b"".join([*left, data[at:]]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
            )

    ids = docs.schema[id_col].dataType.simpleString()
    return map_partitions(both, run, f"doc_id {ids}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s.end - s.start))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
