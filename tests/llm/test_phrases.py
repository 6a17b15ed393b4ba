"""Collocations against plain Python, and the guarantee of the summaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from newsflow.llm import phrases


def plain_collocations(rows, threshold, top=2000):
    counts, out = {}, []
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for lang, text in rows:
        some = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            for n in (1, 2, 3):
                some.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    for lang, f in counts.items():
        n, found = sum(c for g, c in f.items() if len(g) == 1), []
        cands = {g: c for g, c in f.items() if len(g) > 1 and c >= threshold}
        for g, a in cands.items():
            if len(g) == 2 and any(100 * c >= 50 * a for t, c in cands.items() if len(t) == 3 and g in (t[:2], t[1:])):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def random_docs(seed, size=300):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "times", "é", "Été", "x1", "\x85", "a\xa0b", "rare", "the"]
    ends = [" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\x0b", "!? "]
    return [(rnd.choice(["en", "en", "de", None, "und"]), rnd.choice(
        [None, "", ".", *["".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(1, 60)))] * 9]))
        for _ in range(size)]


@pytest.mark.parametrize("partition_mass, buffer", [(1 << 24, 4_000_000), (512, 1000)])
def test_random_documents(spark, monkeypatch, partition_mass, buffer):
    monkeypatch.setattr(phrases, "PARTITION_MASS", partition_mass)
    monkeypatch.setattr(phrases, "BUFFER", buffer)
    monkeypatch.setattr(phrases, "WORDS", 30 if buffer == 1000 else 100_000)
    monkeypatch.setattr(phrases, "COUNTED", 50 if buffer == 1000 else 1_000_000)
    rows = random_docs(buffer)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, n string").repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(docs, 10).collect())
    assert got == plain_collocations(rows, 10)
    assert len(got) > 40


def test_top_and_ties(spark):
    rows = [("en", "b a. a b. c d")] * 12
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, 10, top=2).orderBy("rank").collect()
    assert [(r.rank, r.phrase, r.score) for r in got] == [(1, "c d", 1000000), (2, "a b", 250000)]


def test_products_beyond_64_bits(spark):
    huge = 3 * 10 ** 12
    df = spark.createDataFrame([(huge, huge + 1, huge + 2)], "a long, l long, r long")
    score = df.select(phrases._score("a", df.l, df.r)).first()[0]
    assert score == 1000000 * huge * huge // ((huge + 1) * (huge + 2))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


def test_summaries_keep_whatever_is_frequent(monkeypatch):
    """Merged in any order and cut to their capacity, summaries lose no key that reaches the threshold."""
    monkeypatch.setattr(phrases, "BUFFER", 0)
    rnd = np.random.default_rng(3)
    for threshold in (5, 10, 40):
        keys = np.concatenate([rnd.integers(0, 4000, 20000), np.repeat(np.arange(5000, 5040), threshold)]).astype(np.uint32)
        rnd.shuffle(keys)
        summary = phrases.Summary(len(keys) // threshold + 1)
        for some in np.array_split(keys, 60):
            key, count = np.unique(some, return_counts=True)
            summary.add(key, count)
        found = set(summary.may_reach(threshold).tolist())
        key, count = np.unique(keys, return_counts=True)
        assert set(key[count >= threshold].tolist()) <= found
        assert summary.lost < threshold and len(summary.keys) <= summary.capacity
