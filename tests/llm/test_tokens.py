"""BPE and packing against the tokenizers library."""

import random
import struct
import zlib
from collections import Counter
from itertools import combinations_with_replacement

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsflow.llm import bpe, packing
from tests.llm import plain

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_codec():
    return bpe.WordCodec(WORDS)


def _texts(n=3000, seed=5):
    r = random.Random(seed)
    bits = [" ", "  ", "\n", " \n", "\t", "\x85", "\xa0", "\x1c", "'s", "'LL", "é", "é", "Σ", "ΑΣ", "İ",
            "ß", "123", "½", "#", "***", "🙂", "日本", "<|endoftext|>", "<|startoftext|>", "</w>", "the",
            "Hello", "world", "aaa", "a" * 11, "ing", "̀", "\x00", "ǅ", "l'", "…", "٣", "﻿"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(n)]


def test_words_are_encoded_and_decoded_as_by_the_library(word_codec):
    library = Tokenizer.from_file(WORDS)
    for text in ["", " ", *_texts()]:
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = word_codec.encode(text)
        assert ids == struct.pack(f"<{len(want)}I", *want), text
        assert decoded == library.decode(want, skip_special_tokens=False)
        assert word_codec.decode(want) == decoded


def test_long_words(word_codec):
    library, r = Tokenizer.from_file(WORDS), random.Random(2)
    for size in (50, 400, 3000):
        word = "".join(r.choice("abeinst") for _ in range(size))
        assert word_codec.merge(word + bpe.END) == library.encode(word, add_special_tokens=False).ids


def test_what_is_remembered_stays_bounded():
    squares = bpe.Remembered(lambda x: x * x, 10)
    assert [squares[i] for i in range(25)] == [i * i for i in range(25)] and len(squares) <= 10


def test_bytes_are_encoded_as_by_the_library():
    library, codec = Tokenizer.from_file(BYTES), packing.ByteCodec(BYTES)
    for text in ["", " ", *_texts()]:
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == struct.pack(f"<{len(want)}I", *want), text


def test_encode_texts(spark):
    texts = [None, "", "Hello  World", "x" * 5000, "Hello  World"]
    docs = plain.documents(spark, list(enumerate(texts)) + [(2, texts[2]), (None, "a")])
    got = bpe.encode_texts(docs.withColumnRenamed("lang", "ids"), WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    assert len(got) == 7
    for row in got:
        text = "a" if row.doc_id is None else texts[row.doc_id] or ""
        want = library.encode(text, add_special_tokens=False).ids
        assert row.ids == struct.pack(f"<{len(want)}I", *want)
    assert bpe.encode_texts(plain.documents(spark, []), WORDS).collect() == []


def _fullest_by_hand(counts, room):
    best = 0
    for size in range(6):
        for chosen in combinations_with_replacement(sorted(counts), size):
            if sum(chosen) <= room and all(chosen.count(c) <= counts[c] for c in set(chosen)):
                best = max(best, sum(chosen))
    return best


def test_fullest_fills_as_well_as_any_choice():
    r = random.Random(4)
    for _ in range(200):
        counts = {r.randint(1, 20): 1 for _ in range(4)}
        room = r.randint(0, 40)
        chosen = packing.fullest(sorted(counts), counts, room)
        assert all(counts[n] >= k for n, k in chosen.items())
        assert sum(n * k for n, k in chosen.items()) == _fullest_by_hand(counts, room)


def test_plan_uses_every_piece_once():
    r = random.Random(9)
    counts = Counter(min(2048, int(r.paretovariate(0.6) * 5)) for _ in range(5000))
    patterns = packing.plan(dict(counts))
    used = Counter()
    for pattern, times in patterns:
        assert sum(n * k for n, k in pattern.items()) <= 2048
        used.update({n: k * times for n, k in pattern.items()})
    assert used == counts
    windows = sum(t for _, t in patterns)
    assert sum(n * c for n, c in counts.items()) > 0.98 * 2048 * windows
    assert packing.plan({}) == []


def _check_pieces(rows, texts, library, capacity=2048):
    windows, documents = {}, {}
    for p in rows:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
        documents.setdefault(p.doc_id, []).append(p)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(documents.pop(i), key=lambda p: p.start):
            part = ids[p.start:p.start + p.length]
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += p.length
        assert at == len(ids)
    assert not documents


def test_pack(spark):
    r = random.Random(7)
    texts = dict(enumerate([None, "", "a", "word " * 9000, *_texts(60),
                            *["some text " * r.randint(1, 900) for _ in range(60)]]))
    docs = plain.documents(spark, list(texts.items())).withColumnRenamed("source", "offset")
    _check_pieces(packing.pack(docs.repartition(3), BYTES).collect(), texts, Tokenizer.from_file(BYTES))


def test_pack_repeated_rows_and_no_rows(spark):
    rows = packing.pack(plain.documents(spark, [(1, "same text")] * 700 + [(None, "x")]), BYTES).collect()
    assert len(rows) == 701 and len({(p.sequence_id, p.offset) for p in rows}) == 701
    assert packing.pack(plain.documents(spark, []), BYTES).collect() == []
