"""Token counts by transducers against the tokenizers library."""

import random

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from newsflow.llm import tokencounts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'r", "'ll", "'l", "a", "the", "ing", "e", "9", "42", "!", "..",
         "é", "ü", "中", "文", "\x85", "\x1c", "<|endoftext|>", "<|endo", "🙂", "́", "²", "Ⅷ", "S", "'S",
         "​", "\xa0"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return tokencounts.TokenCounter(PATH)


@pytest.fixture(scope="module")
def splitter():
    return tokencounts.Splitter()


def test_random_texts(library, counter, splitter):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 3000 + "x", "\n" * 300, "'r", "'", "don't 'r're", "<|endoftext|>" * 3]
    assert counter.count(texts, splitter).tolist() == library(texts)


def test_every_kind_of_character(library, counter, splitter):
    rnd = random.Random(2)
    codes = [i for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    chars = [chr(i) for i in rnd.sample(codes, 8000)]
    texts = ["".join(f"a{x} 1{x}!{x}{x}" for x in chars[i:i + 40]) for i in range(0, len(chars), 40)]
    assert counter.count(texts, splitter).tolist() == library(texts)


def test_chunks_compose_at_any_place(splitter):
    """The scan over state maps gives what one walk from the start gives."""
    rnd = np.random.default_rng(3)
    for size in (0, 1, 63, 64, 65, 1000, 5000):
        classes = rnd.integers(0, 12, size)
        state, found = tokencounts.START, set()
        for i, c in enumerate([*classes, tokencounts.BEGIN]):
            out = splitter.emits[state, c]
            found |= {i} if out & tokencounts.HERE else set()
            found |= {i - 1} if out & tokencounts.LATE else set()
            state = splitter.next[state, c]
        assert splitter.borders(classes).tolist() == sorted(b for b in found if b < size)


def test_forgetting_states_changes_nothing(library, splitter, monkeypatch):
    monkeypatch.setattr(tokencounts, "STATES", 50)
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abcdeghinorst'  ", k=60)) for _ in range(200)]
    assert tokencounts.TokenCounter(PATH).count(texts, splitter).tolist() == library(texts)


def test_table(spark, library):
    rows = [(1, "Hello world's end", "x"), (None, None, "y"), (2, "", "z"), (2, "", "z"), (3, "é" * 1500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    done = tokencounts.count_tokens(docs, PATH, limit=3).collect()
    assert done[0].asDict() == {"doc_id": 1, "n_bytes": 17, "n_tokens": 4, "over_limit": True}
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in done[1:]) == [
        (0, 0, 0, False), (2, 0, 0, False), (2, 0, 0, False), (3, 3000, library(["é" * 1500])[0], True)]
    assert tokencounts.count_tokens(docs.limit(0), PATH).count() == 0


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    done = tokencounts.count_tokens(docs, PATH).collect()
    assert {r.doc_id: r.n_tokens for r in done} == want
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in done)
