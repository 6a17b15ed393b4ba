"""BPE encoding and decoding of whole texts.

Encoding: an Aho-Corasick automaton over the vocabulary finds all tokens of a word in one pass; from
the left, the longest token that may stand after the one before it is taken, and where none may, the
last choice is undone. Two tokens may stand side by side when the merges, replayed by rank along their
common border, never join across it; the answers are kept in a table. Tokens that are pairwise
compatible are exactly what the merges give, and a place without a way on is never tried twice, so a
word takes linear time. Decoding cuts the tokens out of one buffer by a table of offsets.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from newsflow.llm.text import small_batches

#: Words and pairs that a task remembers before it starts afresh.
REMEMBERED = 400_000
END = " "  # closes a word; no byte is written as a blank


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Remembered(dict):
    """A dict that computes what it lacks and starts afresh when full."""

    def __init__(self, compute, size: int = REMEMBERED):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.size:
            self.clear()
        self[key] = value
        return value


class WordCodec:
    """A BPE vocabulary with word ends, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        if model["type"] != "BPE" or not suffix or split["behavior"] != "Removed":
            raise ValueError(f"{path}: not a BPE vocabulary with word ends")
        steps = {s["type"] for s in spec["normalizer"]["normalizers"]}
        self.compose, self.lower = "NFC" in steps, "Lowercase" in steps
        self.letters = byte_letters()
        # white space here is the Unicode property, as in the file's own pattern language
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if not all(mark.startswith("<|") for mark in self.special):
            raise ValueError(f"{path}: special tokens must start with <|")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        names = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        raw = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.buffer, self.offsets = b"".join(raw), np.cumsum([0, *map(len, raw)]).tolist()
        self._read_merges(vocab, model["merges"], suffix)
        self.compatible = Remembered(self._compatible, 1_000_000)
        self.words, self.parts = Remembered(self._word), Remembered(self._part)
        self.parts[""] = (b"", "")

    def _read_merges(self, vocab, merges, suffix) -> None:
        surface = {vocab[c]: c for c in self.letters} | {vocab[c + suffix]: c + END for c in self.letters}
        self.halves, self.rank, self.pair = {}, {}, {}
        for rank, (a, b) in enumerate(merges):
            left, right, token = vocab[a], vocab[b], vocab[a + b]
            surface[token] = surface[left] + surface[right]
            self.pair[left, right] = rank
            if token not in self.rank:
                self.halves[token], self.rank[token] = (left, right), rank
        self.width = {t: len(s) for t, s in surface.items()}
        self.automaton = ahocorasick.Automaton()
        for token, text in surface.items():
            # a token that the merges never leave whole cannot be part of an encoding
            if token not in self.rank or self._meet(*self.halves[token], before=self.rank[token]):
                self.automaton.add_word(text, token)
        self.automaton.make_automaton()

    def _border(self, token: int, side: int) -> list[tuple[float, int]]:
        """(rank at which it ends, part) of what stands at one side of `token`, in order of merging."""
        out, until = [], float("inf")
        while True:
            out.append((until, token))
            if token not in self.halves:
                return out[::-1]
            until, token = self.rank[token], self.halves[token][side]

    def _meet(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether no merge of a rank below `before` joins across the border of the two tokens."""
        a, b, i, j = self._border(left, 1), self._border(right, 0), 0, 0
        while True:
            (left_until, x), (right_until, y) = a[i], b[j]
            rank = self.pair.get((x, y))
            # equal ranks go from left to right: what ends on the left comes first
            if rank is not None and rank < before and rank < left_until and rank <= right_until:
                return False
            if min(left_until, right_until) == float("inf"):
                return True
            if left_until <= right_until:
                i += 1
            else:
                j += 1

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self._meet(*pair)

    def merge(self, word: str) -> list[int]:
        """The tokens of a word written in byte letters and closed by END."""
        size, width, compatible = len(word), self.width, self.compatible
        tokens = [token for _, token in self.automaton.iter_long(word)]
        if all(map(compatible.__getitem__, zip(tokens, tokens[1:]))) and size == sum(
                map(width.__getitem__, tokens)):
            return tokens  # always the longest: nothing to undo
        starts: list[list[int]] = [[] for _ in word]
        for last, token in self.automaton.iter(word):
            starts[last + 1 - width[token]].append(token)  # at each start from short to long
        tokens, dead, at = [], set(), 0
        before = None
        while at < size:
            options = starts[at]
            while options:
                token = options.pop()
                to = at + width[token]
                if to not in dead and (before is None or compatible[before, token]):
                    tokens.append(token)
                    before, at = token, to
                    break
            else:
                dead.add(at)
                at -= width[tokens.pop()]
                before = tokens[-1] if tokens else None
        return tokens

    def decode(self, ids: list[int]) -> str:
        """The tokens as they are written in the vocabulary, parted by blanks."""
        buffer, offsets = self.buffer, self.offsets
        return b" ".join([buffer[offsets[i]:offsets[i + 1]] for i in ids]).decode()

    def _word(self, word: str) -> tuple[bytes, str]:
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        elif not word.isprintable():
            word = "".join([self.letters[ord(c)] for c in word])
        return self._written(self.merge(word + END))

    def _written(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def _part(self, part: str) -> tuple[bytes, str]:
        found = []
        for piece in self.marks.split(part) if "<|" in part else (part,):
            if piece in self.special:
                found.append(self._written([self.special[piece]]))
                continue
            if piece.isascii():
                piece = piece.lower() if self.lower else piece
            else:
                piece = unicodedata.normalize("NFC", piece) if self.compose else piece
                # one by one, as a sigma is lowered without a look at what follows
                piece = "".join([c.lower() for c in piece]) if self.lower else piece
            found += [self.words[w] for w in self.pattern.findall(piece)]
        if len(found) == 1:
            return found[0]
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found])

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids of `text` as little-endian unsigned 32-bit integers, and their decoded text.

        No token reaches over a blank, so what stands between blanks is encoded once and remembered.
        """
        found = [self.parts[p] for p in text.split(" ")]
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])


def encode_texts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its id, `ids` (binary, little-endian unsigned 32-bit) and `decoded` (string).

    `path` is a tokenizers file that every executor can read. A null text is an empty one, which has no
    ids; rows are encoded one by one, so repeated rows get equal results.
    """
    small_batches(docs.sparkSession)
    schema = docs.select(doc_id).schema.add("ids", "binary").add("decoded", "string")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = WordCodec(path)
        for batch in batches:
            done = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d[0] for d in done], pa.binary()),
                 pa.array([d[1] for d in done], pa.string())], names=[doc_id, "ids", "decoded"])

    return docs.select(doc_id, text).mapInArrow(encode, schema)
