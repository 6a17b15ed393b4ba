"""Token counts of whole texts by two compiled finite-state transducers, without encoding the texts.

The first transducer reads classes of characters and emits the borders between the pieces that are merged on
their own. Its state maps are closed under composition when it is compiled, so the map of a chunk of text
is one small number and two maps are composed by a look into a table: all chunks of a batch are
summed up side by side, a parallel prefix scan gives the state in which each chunk starts, and a second
pass over all chunks side by side reads the borders off the transitions.

The second transducer reads the bytes of a piece. Its transitions are annotated with the change in the number
of tokens emitted so far, so a piece has as many tokens as its transitions add up to. A state is what later
bytes can depend on: the bytes that may still grow into a token, and for each place where such a token could
begin the token that ends there and the number of tokens up to there. It is made deterministic lazily:
states and transitions come into being when a text first needs them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from newsflow.llm.bpe import Remembered, byte_letters
from newsflow.llm.text import small_batches

#: States that a task keeps before it compiles afresh, and code points of a chunk.
STATES = 500_000
CHUNK = 64

# Classes of characters; contractions need some letters by name.
(BEGIN, BLANK, WHITE, LETTER, SHORT, R, V, L, E, NUMBER, QUOTE, OTHER) = range(12)
LETTERS = (LETTER, SHORT, R, V, L, E)
# States: what has been read since the last border.
(START, WORD, DIGITS, SIGNS, MARK, MARK_R, MARK_V, MARK_L, DONE, ONE_BLANK, ONE_WHITE, BLANKS,
 WHITES) = range(13)
#: Emitted by a transition: a border before the character read, and one before the character before it.
HERE, LATE = 1, 2


def _fresh(c: int) -> int:
    """The state after the first character of a piece."""
    return {BLANK: ONE_BLANK, WHITE: ONE_WHITE, NUMBER: DIGITS, QUOTE: MARK, OTHER: SIGNS}.get(c, WORD)


def _step(state: int, c: int) -> tuple[int, int]:
    """Next state and borders for a character of class `c`."""
    if state in (MARK_R, MARK_V, MARK_L):  # a quote and a letter that may begin 're, 've or 'll
        if c == (L if state == MARK_L else E):
            return DONE, 0
        to, out = _step(WORD, c)
        return to, out | LATE
    if c == BEGIN:
        return START, 0
    space, sign = c in (BLANK, WHITE), c in (QUOTE, OTHER)
    if state == WORD and c in LETTERS or state == DIGITS and c == NUMBER or state == SIGNS and sign:
        return state, 0
    if state == MARK:
        contraction = {SHORT: DONE, R: MARK_R, V: MARK_V, L: MARK_L}
        if c in contraction:
            return contraction[c], 0
        if sign:
            return SIGNS, 0
    if state in (ONE_BLANK, ONE_WHITE, BLANKS, WHITES):
        if space:
            return BLANKS if c == BLANK else WHITES, 0
        # the last blank of several starts a piece, and goes with what follows if it is a plain one
        late = LATE if state in (BLANKS, WHITES) else 0
        if state in (ONE_BLANK, BLANKS):
            return SIGNS if sign else _fresh(c), late
        return _fresh(c), late | HERE
    return _fresh(c), HERE


class Splitter:
    """The compiled transducer of borders and the table that composes its state maps."""

    def __init__(self):
        steps = [[_step(s, c) for c in range(12)] for s in range(13)]
        self.next = np.array([[to for to, _ in row] for row in steps], dtype=np.intp)
        self.emits = np.array([[out for _, out in row] for row in steps], dtype=np.uint8)
        identity = tuple(range(13))
        letters = [tuple(int(t) for t in self.next[:, c]) for c in range(12)]
        ids, todo = {identity: 0}, [identity]
        for known in todo:
            for letter in letters:
                after = tuple(letter[s] for s in known)
                if after not in ids:
                    ids[after] = len(ids)
                    todo.append(after)
        self.maps = np.array(todo, dtype=np.intp)  # one row per state map
        self.read = np.array([[ids[tuple(letter[s] for s in known)] for letter in letters]
                              for known in todo], dtype=np.intp)
        self.compose = np.array([[ids[tuple(second[s] for s in first)] for second in todo]
                                 for first in todo], dtype=np.intp)
        self.classes = self._classes()

    @staticmethod
    def _classes() -> np.ndarray:
        every = "".join(map(chr, [*range(0xD800), *([0xFFFD] * 0x800), *range(0xE000, 0x110000)]))
        out = np.full(0x110000, OTHER, dtype=np.intp)
        for pattern, c in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
            for found in regex.finditer(pattern, every):
                out[found.start():found.end()] = c
        for char, c in ((" ", BLANK), ("'", QUOTE), ("r", R), ("v", V), ("l", L), ("e", E)):
            out[ord(char)] = c
        for char in "stmd":
            out[ord(char)] = SHORT
        return out

    def starts(self, chunk_maps: np.ndarray) -> np.ndarray:
        """The state in which each chunk starts: a scan that doubles its reach in every round."""
        sums, reach = chunk_maps.copy(), 1
        while reach < len(sums):
            sums[reach:] = self.compose[sums[:-reach], sums[reach:]]
            reach *= 2
        return np.concatenate([[START], self.maps[sums[:-1], START]])

    def borders(self, classes: np.ndarray) -> np.ndarray:
        """Positions before which a piece begins, ascending."""
        size = len(classes)
        rows = -(-(size + 1) // CHUNK)
        padded = np.full(rows * CHUNK, BEGIN, dtype=np.intp)
        padded[:size] = classes
        columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
        maps = np.zeros(rows, dtype=np.intp)
        for column in columns:
            maps = self.read[maps, column]
        state = self.starts(maps)
        emitted = np.empty((CHUNK, rows), dtype=np.uint8)
        for i, column in enumerate(columns):
            emitted[i] = self.emits[state, column]
            state = self.next[state, column]
        flags = emitted.T.ravel()
        begins = flags & HERE > 0
        begins[:-1] |= flags[1:] & LATE > 0
        return np.flatnonzero(begins[:size])


class TokenCounter:
    """The lazily compiled transducer of a byte-level BPE vocabulary in a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"]
                or spec["normalizer"] or model.get("ignore_merges")):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        byte = {c: b for b, c in enumerate(byte_letters())}
        raw = {t: bytes(byte[c] for c in t) for t in model["vocab"]}
        self.halves = [(raw[a], raw[b]) for a, b in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(self.halves)}
        self.never = len(self.halves)
        self.made: dict[bytes, int] = {}
        for rank, (a, b) in enumerate(self.halves):
            self.made.setdefault(a + b, rank)
        self.tokens = set(raw.values())
        #: What a token may still grow out of.
        self.beginnings = {t[:n] for t in self.tokens for n in range(1, len(t))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.edges = Remembered(lambda edge: self._edge(*edge))
        self.adjacent = Remembered(self._adjacent, 1_000_000)
        self.pieces = Remembered(self._count)
        self._clear()

    def _clear(self) -> None:
        start = (b"", ((0, None, 0),))
        self.states, self.known = [start], {start: 0}
        self.transitions: dict[int, tuple[int, int]] = {}

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at one side of `token` while it is merged, and the merge that takes each away."""
        out, taken = [], self.never
        while True:
            out.append((token, taken))
            if token not in self.made:
                return out[::-1]
            taken = self.made[token]
            token = self.halves[taken][side]

    def _apart(self, left: bytes, right: bytes, before: int) -> bool:
        """Whether no merge below `before` joins what stands left and right of the border of two tokens."""
        lefts, rights = self.edges[left, 1], self.edges[right, 0]
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = lefts[i], rights[j]
            rank = self.ranks.get((a, b), self.never)
            # of equal merges the one further to the left comes first
            if rank < before and rank < a_taken and rank <= b_taken:
                return False
            if a_taken == b_taken == self.never:
                return True
            if a_taken <= b_taken:
                i += 1
            else:
                j += 1

    def _adjacent(self, pair: tuple[bytes | None, bytes]) -> bool:
        """Whether the merges leave these tokens side by side; with None, whether they make the second."""
        left, right = pair
        if left is not None:
            return self._apart(left, right, self.never)
        return right not in self.made or self._apart(*self.halves[self.made[right]], self.made[right])

    def _transition(self, state: int, byte: int) -> tuple[int, int]:
        """Next state, and by how much the number of tokens changes."""
        window, places = self.states[state]
        window += bytes([byte])
        for at, token, count in places:  # from the longest last token to the shortest; one is right
            last = window[at:]
            if last in self.tokens and self.adjacent[token, last]:
                break
        change = count + 1
        kept = [(at, token, n - change) for at, token, n in places if window[at:] in self.beginnings]
        kept.append((len(window), last, 0))
        cut = kept[0][0]
        new = (window[cut:], tuple((at - cut, token, n) for at, token, n in kept))
        to = self.known.setdefault(new, len(self.states))
        if to == len(self.states):
            self.states.append(new)
        return to, change

    def _count(self, piece: str) -> int:
        if len(self.states) > STATES:
            self._clear()
        state = total = 0
        transitions = self.transitions
        for byte in piece.encode():
            arc = state << 8 | byte
            found = transitions.get(arc)
            if found is None:
                found = transitions[arc] = self._transition(state, byte)
            state = found[0]
            total += found[1]
        return total

    def count(self, texts: list[str], splitter: Splitter) -> np.ndarray:
        """The number of tokens of each text; a special token's string in a text is one token."""
        parts, owner = [], []
        totals = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            found = [text]
            for mark in self.special:
                if mark in text:
                    found = [p for f in found for p in f.split(mark)]
            totals[i] = len(found) - 1
            parts += found
            owner += [i] * len(found)
        # one character between two parts, which the splitter reads as a new beginning
        joined = "\n".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        classes = splitter.classes[codes]
        classes[ends[:-1] - 1] = BEGIN
        begins = splitter.borders(classes)
        part = np.searchsorted(ends, begins, "right")
        stops = np.minimum(np.append(begins[1:], len(joined)), ends[part] - 1)
        pieces = [joined[a:b] for a, b in zip(begins.tolist(), stops.tolist())]
        counts = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        np.add.at(totals, np.asarray(owner, dtype=np.intp)[part], counts)
        return totals


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per document its id, `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens).

    `path` is a tokenizers file that every executor can read. A null text is an empty one and has no
    tokens; rows are counted one by one, so repeated rows and null ids get results of their own; an empty
    table gives no rows. Columns other than the two named are not looked at.
    """
    small_batches(docs.sparkSession)
    schema = (docs.select(doc_id).schema.add("n_bytes", "long", False).add("n_tokens", "long", False)
              .add("over_limit", "boolean", False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, splitter = TokenCounter(path), Splitter()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = counter.count(texts, splitter) if texts else np.zeros(0, dtype=np.int64)
            size = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)],
                names=schema.names)

    return docs.select(doc_id, text).mapInArrow(count, schema)
