"""Phrases whose words keep company: n-grams counted by Misra-Gries summaries, then exactly.

First pass: tasks turn n-grams into 64-bit hashes and send, per hash partition, summaries of counts. A partition
knows the mass of all its summaries before it merges them, and merges them with a capacity above
mass / threshold (ROOM times that), so what it takes off a count stays below the threshold and every n-gram that is frequent
enough survives. Two n-grams with one hash only add survivors. What survives is a bitmap of fixed size, of which
every partition fills its own stretch.

Second pass: n-grams whose bit is set are counted by their words, by tasks and then per hash partition of the
phrases, so counts are exact and n-grams that came along by chance drop out. Where a corpus has more survivors than the bitmap has room for, more
n-grams pass it and the second pass shuffles more; its result stays the same.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.bpe import Remembered
from newsflow.llm.text import lower_ascii, small_batches
from newsflow.session import written

#: Bits of the hash that the bitmap of survivors has a place for (16 MB), whatever the corpus.
BITMAP_BITS = 27
#: n-grams that a hash partition is planned for, and that a task holds before it sends a summary.
PARTITION_MASS, BUFFER = 1 << 24, 4_000_000
#: How many times mass / threshold a summary may hold: more than once leaves fewer rare n-grams among the survivors.
ROOM = 4
#: Different phrases that a task counts before it sends them on, and words that it looks at together.
COUNTED, WORDS = 700_000, 100_000
LONGEST = 3

# What ends a piece, and what words consist of.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
TOKEN = re.compile(r"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit values that spreads over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(values: np.ndarray | bytes) -> bytes:
    """Bytes for the shuffle: the first bytes of all values, then the second ones and so on, compressed."""
    if isinstance(values, np.ndarray):
        values = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(values, codec="zstd", asbytes=True)


def _unpack(data: bytes, dtype: type | None = None) -> np.ndarray | bytes:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    if dtype is None:
        return raw
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


class Reader:
    """Words of a task's texts and the hashes of their n-grams."""

    def __init__(self):
        self.codes = Remembered(lambda w: 0 if w in PIECE_ENDS else xxhash.xxh3_64_intdigest(w) | 1, 250_000)

    def by_lang(self, batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
        """Words of whole texts of a language, some texts at a time; a piece end stands after every piece."""
        words: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            some = words.setdefault(lang, [])
            some += TOKEN.findall(text.as_py())
            some.append(".")
            if len(some) > WORDS:
                yield lang, words.pop(lang)
        yield from words.items()

    def hashes(self, lang: str, words: list[str]) -> list[np.ndarray]:
        """For 1 to LONGEST words: the hash of the n-gram that begins at each place, 0 where none does."""
        codes = np.fromiter(map(self.codes.__getitem__, words), np.uint64, len(words))
        inside = codes != 0
        one = _mixed(codes ^ np.uint64(xxhash.xxh3_64_intdigest(lang, seed=1)))
        out, now, valid = [], one, inside
        for n in range(1, LONGEST + 1):
            if n > 1:
                valid = valid[:-1] & inside[n - 1:]
                now = _mixed(now[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[n - 1:])
            out.append(np.where(valid, now | np.uint64(1), np.uint64(0)))
        return out


class Summary:
    """A Misra-Gries summary of at most `capacity` counters; `lost` is the most a count may lack."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.pending.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(self.capacity, BUFFER):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.pending)])
        counts = np.concatenate([self.counts, *(c for _, c in self.pending)])
        self.pending, self.waiting = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        over = len(keys) - self.capacity
        if over > 0:
            cut = int(np.partition(counts, over - 1)[over - 1])
            kept = counts > cut
            keys, counts, self.lost = keys[kept], counts[kept] - cut, self.lost + cut
        self.keys, self.counts = keys, counts

    def may_reach(self, threshold: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.lost >= threshold]


def _read(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       lower_ascii(F.coalesce(F.col(text), F.lit(""))).alias("text"))


def summaries(texts: DataFrame, partition_bits: int) -> DataFrame:
    """Rows (part, kind, mass, keys, counts) of all tasks: per hash partition masses (0) and summaries (1)."""
    schema = "part int, kind int, mass long, keys binary, counts binary"
    shift = np.uint64(32 - partition_bits)
    edges = np.arange(1 << partition_bits, dtype=np.uint64) << np.uint64(64 - partition_bits) \
        if partition_bits else np.zeros(1, np.uint64)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        ends = np.append(np.searchsorted(keys, edges[1:]), len(keys))
        short, counts = ((keys >> shift) & np.uint64(0xFFFFFFFF)).astype(np.uint32), counts.astype(np.uint32)
        rows, begin = [], 0
        for part, end in enumerate(ends.tolist()):
            if end > begin:
                mass = int(counts[begin:end].sum(dtype=np.int64))
                rows.append((part, 0, mass, None, None))
                steps = np.diff(short[begin:end], prepend=np.uint32(0))  # keys ascend: small steps
                rows.append((part, 1, mass, _pack(steps), _pack(counts[begin:end])))
            begin = end
        columns = list(zip(*rows))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["part", "kind", "mass", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = Reader(), [], 0
        for batch in batches:
            for lang, words in reader.by_lang(batch):
                for hashes in reader.hashes(lang, words):
                    hashes = hashes[hashes != 0]
                    held.append(hashes)
                    size += len(hashes)
                if size > BUFFER:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return texts.mapInArrow(run, schema)


def survivors(sent: DataFrame, partition_bits: int, threshold: int) -> np.ndarray:
    """The bitmap of the hashes that may occur `threshold` times; BITMAP_BITS of the hash are the place."""
    stretch = BITMAP_BITS - partition_bits

    def close(part: int, summary: Summary) -> tuple[int, bytes]:
        bits = np.zeros(1 << stretch, dtype=bool)
        bits[summary.may_reach(threshold) >> np.uint32(32 - stretch)] = True
        return part, np.packbits(bits).tobytes()

    def rows(done: list[tuple[int, bytes]]) -> pa.RecordBatch:
        parts, bits = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(bits, pa.binary())],
                                          names=["part", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary, out = None, 0, None, []
        for batch in batches:
            for part, kind, some, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    if now is not None:
                        out.append(close(now, summary))
                    now, mass, summary = part, 0, None
                if kind == 0:
                    mass += some
                    continue
                if summary is None:  # all masses of the partition come first
                    summary = Summary(ROOM * mass // threshold + 1)
                summary.add(np.cumsum(_unpack(keys, np.uint32), dtype=np.uint32),
                            _unpack(counts, np.uint32).astype(np.int64))
            if out:
                yield rows(out)
                out = []
        if now is not None:
            yield rows([close(now, summary)])

    found = (sent.repartition("part").sortWithinPartitions("part", "kind")
            .mapInArrow(run, "part int, bits binary"))
    bitmap = np.zeros((1 << partition_bits, 1 << stretch - 3), dtype=np.uint8)
    for row in found.collect():  # BITMAP_BITS in all, whatever the corpus
        bitmap[row.part] = np.frombuffer(row.bits, np.uint8)
    return bitmap.ravel()


def counted(texts: DataFrame, bitmap: np.ndarray, partition_bits: int) -> DataFrame:
    """Counts of n-grams in `bitmap` by all tasks: per hash partition of the phrases, lists of them.

    A row (part, langs, phrases, of, counts) has phrases on lines, as no word contains a line break, and for each
    the place of its language in `langs`. An empty phrase counts all words.
    """
    schema = "part int, langs array<string>, phrases binary, of binary, counts binary"

    def rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        langs, parts = list(counts), {}
        for of, some in enumerate(counts.values()):
            for phrase, n in some.items():
                part = xxhash.xxh3_64_intdigest(phrase) >> 32 & (1 << partition_bits) - 1
                held = parts.setdefault(part, ([], [], []))
                held[0].append(phrase)
                held[1].append(of)
                held[2].append(n)
        if not parts:
            return
        columns = [(_pack("\n".join(p).encode()), _pack(np.array(o, np.int32)), _pack(np.array(n, np.int64)))
                   for p, o, n in parts.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int32()), pa.array([langs] * len(parts), pa.list_(pa.string())),
             *[pa.array(c, pa.binary()) for c in zip(*columns)]],
            names=["part", "langs", "phrases", "of", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts, bits = Reader(), {}, bitmap
        for batch in batches:
            for lang, words in reader.by_lang(batch):
                some = counts.setdefault(lang, Counter())
                for n, hashes in enumerate(reader.hashes(lang, words), 1):
                    if n == 1:
                        some[""] += int(np.count_nonzero(hashes))
                    slot = hashes >> np.uint64(64 - BITMAP_BITS)
                    hit = bits[slot >> np.uint64(3)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8)) & 1
                    at = np.flatnonzero((hit != 0) & (hashes != 0)).tolist()
                    if n == 1:
                        some.update([words[i] for i in at])
                    elif n == 2:
                        some.update([f"{words[i]} {words[i + 1]}" for i in at])
                    else:
                        some.update([" ".join(words[i:i + n]) for i in at])
                if sum(map(len, counts.values())) > COUNTED:
                    yield from rows(counts)
                    counts = {}
        yield from rows(counts)

    return texts.mapInArrow(run, schema)


def summed(sent: DataFrame, threshold: int) -> DataFrame:
    """(lang, words, phrase, n) of the phrases that reach `threshold`, and of the empty one.

    A task holds the phrases of one hash partition at a time.
    """
    schema = "lang string, words int, phrase string, n long"

    def close(counts: dict[tuple[str, str], int]) -> pa.RecordBatch:
        kept = [(lang, phrase.count(" ") + 1 if phrase else 0, phrase, n)
                for (lang, phrase), n in counts.items() if n >= threshold or not phrase]
        types = (pa.string(), pa.int32(), pa.string(), pa.int64())
        columns = list(zip(*kept)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["lang", "words", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, Counter()
        for batch in batches:
            for part, langs, phrases, of, n in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    yield close(counts)
                    now, counts = part, Counter()
                names = [langs[i] for i in _unpack(of, np.int32).tolist()]
                for key, some in zip(zip(names, _unpack(phrases).decode().split("\n")), _unpack(n, np.int64).tolist()):
                    counts[key] += some
        yield close(counts)

    return sent.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


def frequent_phrases(docs: DataFrame, threshold: int = 10, lang: str = "lang", text: str = "text") -> DataFrame:
    """Per language (lang, words, phrase, n): n-grams of 1 to 3 words that occur `threshold` times or more.

    A row with `words` 0 and an empty phrase has the number of all words of the language.
    """
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    most = LONGEST * (size + 1) // 2  # a word takes a byte and a separator
    bits = min(max((most // PARTITION_MASS).bit_length(), 0), 20)
    texts = _read(docs, lang, text)
    bitmap = survivors(summaries(texts, bits), bits, threshold)
    return summed(counted(texts, bitmap, bits), threshold)


def _score(a: str, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in decimals of 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (F.col(a), l, r)]
    top = (F.lit(1000000).cast("decimal(7,0)") * wide[0]).cast("decimal(38,0)") * wide[0]
    return F.call_function("div", top.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))


def collocations(docs: DataFrame, threshold: int = 10, top: int = 2000, share: int = 50, lang: str = "lang",
                 text: str = "text") -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null language is `und`, a null text has no words, and rows that repeat count as often as they occur.
    Phrases inside a longer one with `share` percent of their occurrences are left out. Equal scores are ordered
    by occurrences and then by the bytes of the phrase. No documents, or none with frequent phrases, give no rows;
    columns other than the two named are not looked at.
    """
    found = written(frequent_phrases(docs, threshold, lang, text), "phrases")
    word = F.split("phrase", " ")
    a, b, c = word[0], word[1], word[2]

    def part(k: int, side: str, value: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), value.alias("part"))

    two = F.array(part(1, "l", a), part(1, "r", b))
    three = F.array(part(1, "l", a), part(1, "r", F.concat_ws(" ", b, c)),
                    part(2, "l", F.concat_ws(" ", a, b)), part(2, "r", c))
    phrases = found.filter("words >= 2").withColumnRenamed("n", "a")
    longer = (phrases.filter("words = 3")
              .select("lang", "a", F.explode(F.array_distinct(F.array(F.concat_ws(" ", a, b), F.concat_ws(" ", b, c))))
                      .alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longest")))
    kept = (phrases.join(longer, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("longest") < share * F.col("a"), F.lit(True)) | (F.col("words") == 3)))
    parts = found.filter("words IN (1, 2)").select("lang", F.col("phrase").alias("part"), "n")
    cuts = (kept.select("lang", "phrase", "a", F.explode(F.when(F.col("words") == 2, two).otherwise(three)).alias("x"))
            .select("lang", "phrase", "a", "x.*").join(parts, ["lang", "part"])
            .groupBy("lang", "phrase", "a").agg(*[
                F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("n"))).alias(f"{side}{k}")
                for k in (1, 2) for side in ("l", "r")]))
    best = F.array_min(F.filter(F.array(*[
        F.struct(_score("a", F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                 F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]),
        lambda x: x["score"].isNotNull()))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    totals = found.filter("words = 0").select("lang", "n")
    return (cuts.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
            .withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
            .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
