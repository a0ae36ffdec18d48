"""Packing by power-of-two decomposition.

A document of n ids is cut into as many pieces of the longest length as fit and one piece for each
set bit of the rest, longest first. A piece is a sequence of its own: its length is a power of two,
so it needs no padding, and no sequence holds two documents. Sequences of one length form a bucket;
within a bucket they are grouped into batches of a fixed number of ids.

Everything is decided inside the task that reads the document: no shuffle, no ordering, no key.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_partitions, texts

MAX_LENGTH, BATCH_IDS, END_ID = 1024, 1 << 20, 0
CACHE_ENTRIES = 400_000  # words per Python worker; only speed depends on it
LONG_WORD = 500
_CUT = re.compile(r"(?<=\S)(?= \S)")
_UNEVEN = re.compile(r"\s\s|\A\s|\s\Z")
_encoders: dict[str, "Encoder"] = {}


class Encoder(dict):
    """Byte-level BPE of a ``tokenizers`` file: text -> little-endian uint32 ids.

    The pattern before the merges never joins a non-blank character with a following blank, and
    takes a single blank together with the non-blank after it. So a text may be cut before each
    such blank, and the ids of each blank and word, kept by the word, are joined. Words not seen yet
    are merged by tiktoken with the ranks of the same file (equal ids, faster); very long ones, files
    of another kind, and texts that hold the string of an added token go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.added = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = self._ranks(path)

    @staticmethod
    def _ranks(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            return None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, part: str) -> bytes:
        if self.fast is None or len(part) > LONG_WORD:
            found = self.slow.encode(part, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(part)
        return np.array(found, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        out = self.ids(" " + word)
        if len(self) < CACHE_ENTRIES and len(word) < 40:
            self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.fast is None or any(t in text for t in self.added):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if uneven(text):
            first, *words = _CUT.split(text)
            words = [w[1:] for w in words]
        else:
            first, *words = text.split(" ")
        return self.ids(first) + b"".join(map(self.__getitem__, words))


def uneven(text: str) -> bool:
    """Whether blanks begin or end ``text`` or follow each other. Only texts with blanks other than
    spaces and line ends, which are not printable, need the search."""
    line = text.replace("\n", " ") if "\n" in text else text
    if "  " in line or line[0] == " " or line[-1] == " ":
        return True
    return not line.isprintable() and _UNEVEN.search(text) is not None


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def piece_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Lengths that add up to ``n``: longest pieces first, then the binary digits of the rest."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, batch_ids: int = BATCH_IDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset, batch_id).

    ``ids`` holds the piece's ids as little-endian uint32 bytes; the last id of a document is the
    end id 0. ``start`` counts its document's ids before the piece. Each piece is a sequence, so
    ``offset`` is 0; ``sequence_id`` and ``batch_id`` hold the task's number in their upper bits
    and are the same for the same input splits. ``max_length`` must be a power of two.

    A null text counts as empty: one piece with the end id. Repeated ids or rows are packed once
    per row; a null id stays null. An empty table gives no rows; other columns are not read.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def run(batches):
        encode, task = encoder(tokenizer).encode, TaskContext.get().partitionId() << 33
        sequences, members, open_batch, n_batches = 0, {}, {}, 0
        for batch in batches:
            at, start, length, ids, total, seq, group, held = array("q"), array("q"), array("q"), [], array("q"), array("q"), array("q"), 0
            cols = batch.column(0)

            def out():
                take = cols.take(pa.array(np.frombuffer(at, np.int64)))
                longs = [pa.array(np.frombuffer(x, np.int64)) for x in (start, length, total, seq, group)]
                zeros = pa.array(np.zeros(len(at), np.int64))
                return pa.RecordBatch.from_arrays(
                    [take, *longs[:2], pa.array(ids, pa.binary()), *longs[2:4], zeros, longs[4]],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "batch_id"],
                )

            for i, text in enumerate(texts(batch)):
                data = encode(text) + END_ID.to_bytes(4, "little")
                s, n = 0, len(data) // 4
                for size in piece_lengths(n, max_length):
                    if members.get(size, 0) == 0:
                        open_batch[size], n_batches = n_batches, n_batches + 1
                    members[size] = (members.get(size, 0) + 1) % max(1, batch_ids // size)
                    at.append(i), start.append(s), length.append(size), total.append(n)
                    seq.append(task + sequences), group.append(task + open_batch[size])
                    ids.append(data[4 * s : 4 * (s + size)])
                    s, sequences = s + size, sequences + 1
                held += len(data)
                if held > 16 << 20:
                    yield out()
                    at, start, length, ids, total, seq, group, held = array("q"), array("q"), array("q"), [], array("q"), array("q"), array("q"), 0
            if len(at):
                yield out()

    ids_type = docs.schema[id_col].dataType.simpleString()
    return map_partitions(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
        f"doc_id {ids_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, batch_id long",
    )


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "batch_id")
