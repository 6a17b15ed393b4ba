"""Near duplicates, components and fingerprints against brute force."""

import hashlib
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from newsflow.llm import fingerprints, jaccard, queries
from newsflow.llm.components import components
from tests.llm import plain


def _sets(rows):
    out = []
    for i, text in rows:
        words = (text or "").encode().lower().split()
        out.append((i, {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
    return out


def _groups(rows):
    sets = [(i, s) for i, s in _sets(rows)]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b in range(a):
            both = len(s & sets[b][1])
            if s and 100 * both >= 80 * (len(s) + len(sets[b][1]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return {i: (len(s), low[find(k)]) for k, (i, s) in enumerate(sets)}


def _edited(words, share, r):
    words = list(words)
    for _ in range(max(1, int(len(words) * share))):
        words[r.randrange(len(words))] = f"new{r.randrange(10 ** 6)}"
    return words


@pytest.fixture(scope="module")
def near_rows():
    r = random.Random(11)
    texts = [None, "", " \n", "one two", "ONE  two", "one two three", "a b c d e", "a b c d e f"]
    for size in (5, 6, 8, 9, 12, 20, 45, 110, 300, 900):
        for _ in range(4):
            words = [f"w{r.randrange(3000)}" for _ in range(size)]
            texts.append(" ".join(words))
            for share in (0.005, 0.01, 0.02, 0.03, 0.045):
                texts.append(" ".join(_edited(words, share, r)))
                texts.append(" ".join(words[:max(1, int(size * (1 - 4 * share)))]))
            texts.append(" ".join(words).upper())
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [f"{passage} " + " ".join(f"v{r.randrange(10 ** 6)}" for _ in range(8)) for _ in range(60)]
    return [(1000 - i, t) for i, t in enumerate(texts)]


def test_near_duplicates(spark, near_rows):
    docs = plain.documents(spark, near_rows).withColumnRenamed("lang", "node").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == _groups(near_rows)


def test_near_duplicates_in_chunks_of_a_few(spark, near_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    rows = near_rows[-90:]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard.near_duplicates(plain.documents(spark, rows)).collect()}
    assert got == _groups(rows)


def test_rows_with_one_id_and_without_id(spark):
    text = "some words that are in both of the texts"
    rows = [(5, text), (5, "other words " * 9), (3, "other words " * 9), (None, text), (None, "a lone text"),
            (7, text), (7, text)]
    got = jaccard.near_duplicates(plain.documents(spark, rows)).collect()
    assert len(got) == 7
    assert {r.component_id for r in got if r.doc_id == 7} == {5}
    assert jaccard.near_duplicates(plain.documents(spark, [])).collect() == []


def test_linked_sets_share_a_key():
    r = np.random.default_rng(5)
    for _ in range(3000):
        n = int(r.integers(4, 400))
        base = r.integers(0, 2 ** 64, n + 100, dtype=np.uint64)
        a = np.unique(base[:n])
        gone = int(r.integers(0, n // 9 + 1))
        b = np.unique(np.concatenate([a[gone:], base[n:n + int(r.integers(0, n // 9 + 1))]]))
        both = len(np.intersect1d(a, b))
        if 9 * both >= 4 * (len(a) + len(b)) and len(a) != both:
            assert np.intersect1d(jaccard.block_keys(a), jaccard.block_keys(b)).size


def test_all_blocks_find_every_link_of_large_sets():
    """By all blocks even pairs at exactly 0.8 share a key for certain; by BLOCKS nearly all do."""
    r = np.random.default_rng(8)
    for n in (900, 5000, 40_000):
        base = r.integers(0, 2 ** 64, n + n // 9, dtype=np.uint64)
        a, b = np.unique(base[:n]), np.unique(base[n // 9:])
        assert 9 * len(np.intersect1d(a, b)) in range(4 * (len(a) + len(b)), 4 * (len(a) + len(b)) + 20)
        for blocks in (None, jaccard.BLOCKS):
            assert np.intersect1d(jaccard.block_keys(a, blocks), jaccard.block_keys(b, blocks)).size


def test_functions_travel_to_workers_without_the_package():
    """Sent by value, the operator needs no import of the package where it arrives."""
    import subprocess
    import sys

    import newsflow
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(newsflow)
    try:
        sent = cloudpickle.dumps(lambda: len(jaccard.block_keys(np.arange(1, 300, dtype=np.uint64) << np.uint64(50))))
    finally:
        cloudpickle.unregister_pickle_by_value(newsflow)
    code = "import sys, pickle; print(pickle.loads(sys.stdin.buffer.read())())"
    done = subprocess.run([sys.executable, "-c", code], input=sent, capture_output=True, cwd="/")
    assert done.returncode == 0, done.stderr.decode()
    assert int(done.stdout) > 0


def test_tree_finds_all_within_the_bound():
    r = np.random.default_rng(6)
    points = r.poisson(3, (500, jaccard.GROUPS)).astype(np.int64)
    points[:200] = points[0] + r.binomial(1, 0.1, (200, jaccard.GROUPS))
    sizes = points.sum(axis=1)
    tree = jaccard.CountTree(points, sizes)
    for row in range(0, 500, 7):
        shared = np.minimum(points, points[row]).sum(axis=1)
        want = np.flatnonzero(9 * shared >= 4 * (sizes + sizes[row]))
        assert sorted(tree.near(points[row], int(sizes[row]))) == list(want)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    loops = [(200, 200), (201, 200), (202, 201), (200, 202)]
    pairs = spark.createDataFrame(chain + star + loops, "a long, b long").repartition(3)
    got = {r.node: r.label for r in components(pairs).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)}
    assert got == want
    assert components(pairs.limit(0)).collect() == []


def _parts(text):
    out = set()
    for line in text.split("\n"):
        size = fingerprints.LONG if len(line) > fingerprints.LONG else fingerprints.SHORT
        out |= {line[i:i + size] for i in range(0, len(line), size)}
    return out


def _likeness(a, b):
    a, b = _parts(a), _parts(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    r = random.Random(8)
    lines = ["".join(r.choice("abc é") for _ in range(r.randint(0, 300))) for _ in range(300)]
    texts = [None, "", "a", "ab", "abc\r\x85d", "\n\n", "x" * 5000, "\n".join(lines)]
    texts += ["\n".join(r.choices(lines, k=r.randint(1, 40))) for _ in range(60)]
    texts += [texts[-1], "\n".join(lines[:200]), "\n".join(lines[:150])]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    docs = plain.documents(spark, rows + [rows[9]]).withColumnRenamed("source", "fingerprint").repartition(3)
    got = fingerprints.fingerprint_documents(docs).collect()
    assert len(got) == len(rows) + 1
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    after = {i: order[(k + 1) % len(order)][1] for k, (i, _) in enumerate(order)}
    prints = {}
    for x in got:
        text = dict(rows)[x.doc_id] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[x.doc_id][:cut]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(x.near_edited - _likeness(text, edited)) < 1e-9
        assert abs(x.near_next - _likeness(text, after[x.doc_id])) < 1e-9
        prints.setdefault(x.fingerprint, set()).add(frozenset(_parts(text)))
    assert all(len(p) == 1 for p in prints.values())


def test_peeling_gives_the_hashes_of_both_sides(spark):
    one = spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.xxhash64(i).bitwiseAND(F.lit(-2))).alias("a"))
    one = one.select("a", F.concat(F.slice("a", 3, 28), F.array(F.xxhash64(F.lit(99)).bitwiseAND(
        F.lit(-2)))).alias("b"))
    found = one.select("a", "b", fingerprints.peel(fingerprints.subtract(
        fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b")))).alias("found")).first()
    want = {(k, 1) for k in set(found.a) - set(found.b)} | {(k, -1) for k in set(found.b) - set(found.a)}
    assert {(x.key, x.side) for x in found.found} == want and len(want) == 3


def test_fingerprints_of_one_row_and_of_none(spark):
    (row,) = fingerprints.fingerprint_documents(plain.documents(spark, [(None, "abcdef")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0
    assert fingerprints.fingerprint_documents(plain.documents(spark, [])).collect() == []


def _content_parts(text):
    return {piece for line in text.split("\n") for piece in regex.findall(
        fingerprints.LONG_PIECE if len(line) > fingerprints.LONG else fingerprints.SHORT_PIECE, line)}


def test_fingerprints_of_pieces_that_the_content_chooses(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(1, 9)))
    prose = " ".join(word() + r.choice(["", "", "", "", ".", "!"]) for _ in range(900))
    plain_words = " ".join(word() for _ in range(900))
    packed = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(6000))
    rows = []
    for text in (prose, plain_words, packed, "\n".join(prose[i:i + 120] for i in range(0, 2400, 120))):
        rows += [text, "x" + text, text[:700] + "some new words " + text[700:]]
    rows = list(enumerate([*rows, None, "", "abc\r\x85d\n\né. ü 。"], 1))
    docs = plain.documents(spark, rows).repartition(3)
    got = {x.doc_id: x for x in fingerprints.fingerprint_documents(docs, pieces=fingerprints.content_digests)
           .collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        a, b = _content_parts(text or ""), _content_parts(rows[k - 1][1] or "")
        want = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(got[i].near_next - want) < 1e-9
    for i in (2, 3, 5, 6, 8, 9, 11, 12):  # next to their text, or to another edit of it
        assert got[i].near_next > 0.8


def test_the_query_cuts_where_the_content_says(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = fingerprints.fingerprint_documents(docs, pieces=fingerprints.content_digests)
    got = queries.QUERIES["op5_fingerprints"](spark, "/root/testdata/sf0.001")
    assert sorted(got.collect()) == sorted(want.collect())


def test_near_texts_of_null_and_repeated_ids(spark):
    r = random.Random(2)
    words = [[f"t{k}w{r.randrange(2000)}" for _ in range(120)] for k in range(5)]
    near = lambda k: " ".join(_edited(words[k], 0.01, r))
    rows = [(None, near(0)), (None, near(0)), (8, near(0)), (None, near(1)), (None, near(1)), (4, near(2)),
            (4, near(3)), (9, near(3)), (4, near(4)), (6, near(2)), (7, near(4))]
    rows += [rows[0]] * 3
    got = jaccard.near_duplicates(plain.documents(spark, rows).repartition(3)).collect()
    # brute force over rows: each has a number of its own, ids come after
    lone = _groups([(k, t) for k, (_, t) in enumerate(rows)])
    want = []
    for k, (i, _) in enumerate(rows):
        n, label = lone[k]
        ids = [rows[m][0] for m in lone if lone[m][1] == label and rows[m][0] is not None]
        want.append((i, n, min(ids, default=None)))
    assert sorted(map(str, want)) == sorted(str((x.doc_id, x.n_shingles, x.component_id)) for x in got)
    assert {w[2] for w in want} == {None, 4, 8}
