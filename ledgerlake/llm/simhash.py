"""SimHash near-duplicate detection with covering locality-sensitive hashing.

Radius r uses 2^(r+1)-1 bit masks. Bit i of a fingerprint gets a code m(i) of r+1 bits, and the
mask of table v keeps the bits whose code has an odd inner product with v. The codes of at most r
differing bits span at most r dimensions, so some non-zero v is orthogonal to all of them: the two
fingerprints agree on the whole mask of v and meet in that table. No pair within the radius is
missed, whatever the data.

Identical fingerprints are one node. A bucket with more than ``SPLIT`` different fingerprints is
split by a second covering family over the bits its mask left free; such a sub-bucket agrees on
about 50 of 64 bits, so it can't hold more than about 2^15 fingerprints whatever the input size.
Buckets yield a spanning forest of their links (at most one row per member), never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, landed, map_batches, map_partitions
from ledgerlake.llm.components import components

SHINGLE, RADIUS, SEED = 3, 3, 42
SPLIT = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of ``text``; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, SEED) for g in grams), dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, fp): one row per row of ``docs``; h is a hash of the text, fp its SimHash as a signed long."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        f = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.array(f, np.uint64).view(np.int64))], ["doc_id", "h", "fp"])

    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return map_batches(rows, score, f"doc_id {ids}, h long, fp long")


def _grouped(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """``fingerprints`` with the root fingerprint of each row's component."""
    fps = landed(fingerprints(docs, shingle, id_col, text_col))
    comp = components(links(fps.select("fp").distinct(), radius))
    return fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("doc_id", "h", "fp", F.coalesce("root", "fp").alias("root"))


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over ``bits`` such that any ``radius`` of them are all absent from some mask."""
    tables = (1 << (radius + 1)) - 1
    return [sum(1 << b for i, b in enumerate(bits) if ((i % tables + 1) & v).bit_count() & 1) for v in range(1, tables + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(group: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among different fingerprints: breadth first, each member
    compared only with members no tree has reached yet."""
    edges, rest = [], group
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                hit, rest = rest[near], rest[~near]
                edges.append((np.full(len(hit), x), hit))
                queue.extend(hit)
    return edges


def _linker(radius: int, n_keys: int):
    """Reads rows sorted by the first ``n_keys`` columns, fp last; gives (a, b) links."""

    def run(batches):
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch | None:
            keys, fps = rows[:, :n_keys], rows[:, n_keys]
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(rows)]
            edges = [e for s, t in zip(starts[ends - starts > 1], ends[ends - starts > 1]) for e in _forest(np.unique(fps[s:t]), radius)]
            if not edges:
                return None
            a, b = (np.concatenate([e[i] for e in edges]).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in batch.columns])
            if held:
                rows = np.concatenate([*held, rows])
            if not len(rows):
                continue
            last = np.flatnonzero(np.any(rows[:, :n_keys] != rows[-1, :n_keys], axis=1))
            cut = last[-1] + 1 if len(last) else 0  # the last key may go on in the next batch
            if cut and (out := links(rows[:cut])) is not None:
                yield out
            held = [rows[cut:]]
        if held and len(held[0]) and (out := links(held[0])) is not None:
            yield out

    return run


def links(nodes: DataFrame, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """``nodes`` (fp long, distinct) -> (a, b): links that connect exactly the fingerprints which
    chains of steps of at most ``radius`` differing bits connect."""
    masks = covering_masks(list(range(64)), radius)
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for v, m in enumerate(masks)])
    rows = nodes.select("fp", F.inline(tables)).select("v", "k", "fp")
    sizes = landed(rows.groupBy("v", "k").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))

    pairs = sizes.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
    keys = ["v", "k"]
    middle = rows.join(sizes.where(f"n > 2 and n <= {split}").select(*keys), keys).select(*keys, "fp")
    found = pairs.union(map_partitions(middle.repartition(*keys).sortWithinPartitions(*keys), _linker(radius, 2), "a long, b long"))
    if sizes.where(f"n > {split}").isEmpty():
        return found

    free = [covering_masks([b for b in range(64) if not m >> b & 1], radius) for m in masks]
    sub = F.array(*[
        F.struct(F.lit(u).alias("u"), F.element_at(F.array(*[F.lit(_signed(free[v][u])) for v in range(len(masks))]), F.col("v") + 1).bitwiseAND(F.col("fp")).alias("s"))
        for u in range(len(masks))
    ])
    keys = ["v", "k", "u", "s"]
    hot = rows.join(sizes.where(f"n > {split}").select("v", "k"), ["v", "k"]).select("v", "k", "fp", F.inline(sub)).select(*keys, "fp")
    shared = hot.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    leaves = hot.join(shared, keys).select(*keys, "fp")
    return found.union(map_partitions(leaves.repartition(*keys).sortWithinPartitions(*keys), _linker(radius, 4), "a long, b long"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id): the group of each document.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is
    the smallest id reachable over links. Null and blank texts have fingerprint zero and are linked
    like any other. One row per input row: repeated ids and rows stay repeated. A row without id
    belongs to its group, whose id is the smallest id that is not null (null if there is none). An
    empty table gives an empty result; other columns are not read.
    """
    tagged = _grouped(docs, shingle, radius, id_col, text_col)
    # landed, so that the join below reads two plain shuffles and a large group can be split
    least = landed(tagged.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return tagged.join(least, "root").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: of those with the group's smallest id (null if none has
    an id), the smallest by all columns. An id may stand in several groups: each keeps a row."""
    tagged = landed(_grouped(docs, shingle, radius, id_col, text_col).select("doc_id", "h", "root").distinct())
    least = landed(tagged.groupBy("root").agg(F.min("doc_id").alias("least")))
    first = tagged.join(least, "root").where(F.col("doc_id").eqNullSafe(F.col("least")))
    wid, wh, root = (fresh(docs, x) for x in ("_winner", "_text", "_root"))
    first = first.select(F.col("doc_id").alias(wid), F.col("h").alias(wh), F.col("root").alias(root))
    rows = docs.join(first, docs[id_col].eqNullSafe(F.col(wid)) & (F.xxhash64(docs[text_col]) == F.col(wh)))  # an id and text have one root
    one = rows.groupBy(root).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(wid))
    return one.select(f"{wid}.*")
