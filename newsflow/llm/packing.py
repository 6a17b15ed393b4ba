"""Packing by minimum bin slack.

Texts are encoded once, in tasks, and cut into whole windows and one rest each; only ids, lengths and
checksums go on. The rests are counted by length, at most one row per length whatever the corpus, and
the plan is made from these counts: the longest length left opens a window, a bitset of the reachable
sums picks the multiset of other lengths that fills it closest, and that pattern is used as often as
the counts allow. Rests are numbered within their length without a global sort and find their window
by arithmetic.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import Remembered, byte_letters
from newsflow.llm.sharding import BLOCKS, number_within
from newsflow.llm.text import small_batches
from newsflow.session import written

# Fixed value: how the byte-level vocabulary parts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteCodec:
    """A byte-level BPE vocabulary, read from a tokenizers file whose ids are in merge order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.model = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks,
                                       special_tokens=self.special)
        self.marks = set(self.special)
        self.parts = Remembered(lambda p: self._ids(" " + p))

    def _ids(self, text: str) -> bytes:
        ids = self.model.encode(text, allowed_special=self.marks, disallowed_special=())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of `text` as little-endian unsigned 32-bit integers.

        Between a visible character and a blank there is always a border, so a text is encoded by
        parts that are remembered. Where white space precedes a blank it is encoded as a whole.
        """
        parts = text.split(" ")
        if any(not p or p[-1].isspace() for p in parts[:-1]):
            return self._ids(text)
        found = [self.parts[p] for p in parts[1:]]
        return self._ids(parts[0]) + b"".join(found)


def cut_texts(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: whole windows and one rest each.

    Columns: the id, `start`, `length`, `ids_crc32`, `doc_tokens`. A text's ids are followed by
    `end_id`, so an empty or null text has one piece of one token. Repeated rows are pieces like any
    other.
    """
    small_batches(docs.sparkSession)
    schema = docs.select(doc_id).schema
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, "long", False)
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteCodec(path)
        for batch in batches:
            rows, values = [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                ids = codec.encode(value or "") + end
                for first in range(0, len(ids), 4 * capacity):
                    piece = ids[first:first + 4 * capacity]
                    rows.append(row)
                    values.append((first // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            columns = np.array(values, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *map(pa.array, columns)],
                names=schema.names)

    return docs.select(doc_id, text).mapInArrow(cut, schema)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of `lengths` (ascending) within `counts` whose sum is nearest to `room`."""
    reachable, steps, mask = 1, [], (2 << room) - 1
    for at in range(bisect_left(lengths, room + 1) - 1, -1, -1):
        length = lengths[at]
        left, some = min(counts[length], room // length), 1
        while left:
            some = min(some, left)
            steps.append((length, some, reachable))
            reachable |= (reachable << length * some) & mask
            left, some = left - some, some * 2
        if reachable >> room:
            break
    total, chosen = reachable.bit_length() - 1, {}
    for length, some, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + some
            total -= length * some
    return chosen


def plan(counts: dict[int, int], capacity: int = 2048) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> pieces in a window) and how many windows follow each; uses up `counts`."""
    counts = {n: c for n, c in counts.items() if c}
    lengths, out = [], []
    for n in counts:
        insort(lengths, n)
    while lengths:
        first = lengths[-1]
        counts[first] -= 1
        pattern = fullest(lengths, counts, capacity - first)
        counts[first] += 1
        pattern[first] = pattern.get(first, 0) + 1
        times = min(counts[n] // k for n, k in pattern.items())
        out.append((pattern, times))
        for n, k in pattern.items():
            counts[n] -= k * times
            if not counts[n]:
                lengths.pop(bisect_left(lengths, n))
    return out


def _places(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first number, pieces in a window, first window, first offset), sorted."""
    used: dict[int, int] = {}
    rows, window = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, pieces in sorted(pattern.items(), reverse=True):
            rows.append((length, used.get(length, 0), pieces, window, offset))
            used[length] = used.get(length, 0) + pieces * times
            offset += length * pieces
        window += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """The pieces of `cut_texts` with `sequence_id` and `offset`, in windows of `capacity` tokens.

    The plan that travels to the tasks has a row per length and pattern: its size depends on
    `capacity`, not on the corpus. An empty table gives no pieces.
    """
    pieces = written(cut_texts(docs, path, end_id, capacity, doc_id, text), "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(plan(counts, capacity))
    block = F.pmod(F.xxhash64(doc_id, "start"), F.lit(BLOCKS)).cast("int")
    numbered = number_within(pieces, "length", [doc_id, "start", "ids_crc32"], block, "number")
    keep = pieces.columns
    schema = pieces.select(keep).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << 40
        firsts = places[:, 0] * wide + places[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            row = places[np.searchsorted(firsts, length * wide + number, "right") - 1]
            nth = number - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(row[:, 3] + nth // row[:, 2]),
                 pa.array(row[:, 4] + nth % row[:, 2] * length)], names=schema.names)

    return numbered.select(*keep, "number").mapInArrow(place, schema)
