"""Best-fit packing: best-fit decreasing with a segment tree over remaining capacities.

Longest pieces first, each goes into the open sequence with the least room that still takes it. What
best-fit decreasing does depends only on how many pieces there are of each length, and lengths end
at ``max_length``. So Spark counts the pieces by length, and the packing itself is planned once for
the whole corpus on that histogram (``max_length`` numbers, however many documents there are):

1. Documents are tokenised once; the pieces are written as a table, each numbered among the pieces
   of its length in its task. Counts by (task, length) become offsets, so that number plus offset
   is a dense rank among all pieces of one length.
2. The plan places the pieces of a length in order of rank. The tightest sequence is found in a
   segment tree over remaining capacities; as the sequence just used stays the tightest while it
   has room, equal pieces are placed a run of equal sequences at a time, with the result that
   placing them one by one would give (tested).
3. Every piece reads its sequence and offset off the plan by length and rank.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_batches, map_partitions, texts, written
from ledgerlake.llm.packing import END_ID, encoder

MAX_LENGTH = 2048


class Capacities:
    """Segment tree over the capacities 0 .. ``most``: which of them open sequences have."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.open = [0] * (2 * self.width)

    def add(self, capacity: int, n: int) -> None:
        at = self.width + capacity
        while at:
            self.open[at] += n
            at >>= 1

    def tightest(self, size: int) -> int | None:
        """The smallest open capacity of at least ``size``."""
        at = self.width + size
        while not self.open[at]:
            while at & 1:  # a right child: on to the parent's right neighbour
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.width:
            at *= 2
            at += not self.open[at]
        return at - self.width


def plan(counts: dict[int, int], most: int = MAX_LENGTH) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Best-fit decreasing of ``counts`` (length -> pieces) into sequences of ``most`` ids.

    Returns, by length, rows (first rank, pieces a sequence, first sequence, offset there): the
    pieces from that rank on fill sequences with consecutive numbers, so many each, from the offset
    on. Also the number of sequences. The rows are at most a few for each pair of lengths.
    """
    tree, runs = Capacities(most), defaultdict(list)  # capacity -> [(first sequence, sequences)]
    out, opened = {}, 0

    def keep(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            runs[capacity].append((first, n))
            tree.add(capacity, n)

    for size in sorted(counts, reverse=True):
        left, rank, rows = counts[size], 0, out.setdefault(size, [])
        while left:
            room = tree.tightest(size)
            if room is None:
                n = -(-left // (most // size))
                keep(most, opened, n)
                opened, room = opened + n, most
            each = room // size
            first, n = runs[room].pop()
            tree.add(room, -n)
            full = min(n, left // each)
            if full:
                rows.append((rank, each, first, most - room))
                keep(room - each * size, first, full)
                rank, left = rank + full * each, left - full * each
            rest = left if full < n and left < each else 0
            if rest:
                rows.append((rank, rest, first + full, most - room))
                keep(room - rest * size, first + full, 1)
                rank, left = rank + rest, 0
            keep(room, first + full + (rest > 0), n - full - (rest > 0))
    return out, opened


def cut(n: int, most: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: the first takes the rest, all others are full."""
    return [n % most] * (n % most > 0) + [most] * (n // most)


def _pieces(docs: DataFrame, tokenizer: str, most: int, keep_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """The pieces of every document, numbered by task and length."""

    def run(batches):
        encode, task, turn = encoder(tokenizer).encode, TaskContext.get().partitionId(), array("q", [0]) * (most + 1)
        for batch in batches:
            ids_of, rows = batch.column(0), []

            def out():
                cols = list(zip(*rows))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * keep_ids]
                names = ["piece", "start", "length", "ids_crc32", "turn", *["ids"] * keep_ids]
                return pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(cols[0], pa.int64())), *(pa.array(c, k) for c, k in zip(cols[1:], kinds)), pa.array([task] * len(rows), pa.int32())],
                    ["doc_id", *names, "task"],
                )

            held = 0
            for i, text in enumerate(texts(batch)):
                data, start = encode(text) + END_ID.to_bytes(4, "little"), 0
                for piece, n in enumerate(cut(len(data) // 4, most)):
                    part = data[4 * start : 4 * (start + n)]
                    rows.append((i, piece, start, n, zlib.crc32(part), turn[n], *[part] * keep_ids))
                    turn[n] += 1
                    start += n
                held += len(data)
                if held > 16 << 20:
                    yield out()
                    rows, held = [], 0
            if rows:
                yield out()

    kind = docs.schema[id_col].dataType.simpleString()
    return map_partitions(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, turn long, {'ids binary, ' * keep_ids}task int",
    )


def pack(
    docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset).

    A document is its ids and the end id 0. One of more than ``max_length`` ids is cut into pieces
    of that length, of which only the first may be shorter; any other stays whole. Pieces share
    sequences as best-fit decreasing over the whole corpus puts them; a sequence has no gap.
    ``ids`` are little-endian uint32 bytes, left out unless ``keep_ids``. The same table in the
    same splits is packed alike.

    A null text counts as empty: one piece with the end id. Repeated ids or rows are packed once
    per row; a null id stays null. An empty table gives no rows; other columns are not read.
    """
    if max_length < 1:
        raise ValueError("max_length must be positive")
    pieces = written(_pieces(docs, tokenizer, max_length, keep_ids, id_col, text_col))
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rows, _ = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, max_length)  # max_length rows at most
    shared = docs.sparkSession.sparkContext.broadcast({n: np.array(x, np.int64).T for n, x in rows.items()})
    # A merge join: the offsets are many at scale, and their files are so compressed that they look small enough to broadcast.
    ranked = pieces.join(offsets.hint("merge"), ["length", "task"]).withColumn("rank", F.col("turn") + F.col("earlier"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            n = int(length[same[0]])
            ranks, each, first, base = shared.value[n]
            at = np.searchsorted(ranks, rank[same], "right") - 1
            inside = rank[same] - ranks[at]
            sequence[same] = first[at] + inside // each[at]
            offset[same] = base[at] + inside % each[at] * n
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*keep).schema)
    return map_batches(ranked.select(*keep, "rank"), place, f"{fields}, sequence_id long, offset long")
