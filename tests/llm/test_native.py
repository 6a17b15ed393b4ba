"""Line dedup, quality rules and sharding against plain Python."""

import random
import zlib

import pytest

from newsflow.llm import lines, rules, sharding
from tests.llm import plain

LONG = "a line that is repeated and has more than forty characters"
ROWS = [(1, None), (2, ""), (3, "\n\n"), (4, LONG), (5, f"  {LONG.upper()}\t\nown line"),
        (6, f"{LONG}\n{LONG}\nx"), (7, f"{LONG}\r\n short\n short"), (8, f"x\n{LONG}\n{LONG}"),
        (8, f"x\n{LONG}\n{LONG}"), (8, "y"), (None, LONG), (9, "é" * 39), (10, "ü " * 2000)]


def _random_texts(n, seed=3):
    r = random.Random(seed)
    bits = [" ", "  ", "\n", "\t", "\x0b", "the", "of", "a", "b", "é", "Ab", "#", "***", "x|y", "\x1c",
            " ", LONG, LONG.title()]
    return ["".join(r.choice(bits) + r.choice(["", " ", "\n"]) for _ in range(r.randint(0, 120)))
            for _ in range(n)]


@pytest.mark.parametrize("rows", [ROWS, [], list(enumerate(_random_texts(60)))])
def test_dedup_lines(spark, rows):
    docs = plain.documents(spark, rows).withColumnRenamed("n_chars", "N_LINES")
    got = lines.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_lines", "n_dropped"]
    found = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
    order = lambda x: (str(x[0]), x[1])
    assert sorted(found, key=order) == sorted(plain.dedup_lines(rows), key=order)


def test_dedup_lines_keeps_a_line_below_the_threshold(spark):
    rows = [(i, LONG) for i in range(4)]
    assert {r.n_dropped for r in lines.dedup_lines(plain.documents(spark, rows)).collect()} == {0}


def test_rule_counts(spark):
    texts = [None, "", " \n ", "a b", "a b c a b c", "a b c d a b c", "b a\nb a\n\nb a", LONG * 50,
             " ".join(["w"] * 70000), *_random_texts(80)]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    docs = plain.documents(spark, rows).withColumnRenamed("source", "kept")
    got = rules.apply_rules(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain.counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        base = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == base and r.kept == (not base and not r.failed_rules)


def test_rules_part_prose_from_junk(spark):
    r = random.Random(1)
    vocabulary = ["the", "of", "and", "to"] + ["".join(r.choices("abcdefgh", k=6)) for _ in range(400)]
    prose = " ".join(r.choices(vocabulary, weights=[40] * 4 + [1] * 400, k=200))
    junk = {"symbols": prose.replace(" ", "*** "), "exclamations": prose.replace(" ", "!! "),
            "capitals": prose.upper(), "table_lines": prose.replace(" ", " | ")}
    rows = [(0, prose), *enumerate(junk.values(), 1)]
    got = {x.doc_id: x for x in rules.apply_rules(plain.documents(spark, rows)).collect()}
    assert got[0].kept and got[0].failed_rules == []
    for i, name in enumerate(junk, 1):
        assert not got[i].kept and name in got[i].failed_rules


def test_shards(spark):
    rows = [(i, "x" * (i % 7)) for i in range(3000)] + [(5, "again"), (None, None), (None, "")]
    got = sharding.shard_documents(plain.documents(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    places = {}
    for r in got:
        places.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert sorted(places) == list(range(24))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert 60 < sum(r.grown_shard == 24 for r in got) < 190
    assert all(70 < len(p) < 190 for p in places.values())
    want = {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows}
    assert {(r.doc_id, r.text_crc32, r.size) for r in got} == want
    assert len({r.shard for r in got if r.doc_id == 5}) == 1


def test_shards_of_no_rows(spark):
    assert sharding.shard_documents(plain.documents(spark, [])).collect() == []


def test_only_subtrees_with_new_weights_move(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = sharding.layout(24)
    heavier = tuple(sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree)
    both = sharding.assign(sharding.assign(ids, ids.doc_id, tree, "a"), ids.doc_id, heavier, "b")
    moved = [(r.a, r.b) for r in both.collect() if r.a != r.b]
    assert moved and all(sharding.layout(24)[b].region == 0 for _, b in moved)
    inside = [(a, b) for a, b in moved if a // 8 == 0]
    assert all(b == 5 or b // 4 == 1 for _, b in inside)


def test_growing_further_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    both = sharding.assign(sharding.assign(ids, ids.doc_id, sharding.layout(27), "a"), ids.doc_id,
                           sharding.layout(28), "b")
    assert all(r.b in (r.a, 27) for r in both.collect())


def plain_draws(key, tree):
    """The shard of a key by the draws of `sharding`, in plain Python."""
    import math

    import xxhash

    def draw(level, child, weight):
        first = xxhash.xxh64_intdigest(str(key).encode(), seed=42)
        bits = xxhash.xxh64_intdigest(f"{level}:{child}".encode(), seed=first) >> 11
        return math.log((bits + 0.5) / (1 << 53)) / weight, child

    def winner(level, children):
        return max(draw(level, c, w) for c, w in children.items())[1]

    def below(leaves, name):
        out = {}
        for leaf in leaves:
            out[getattr(leaf, name)] = out.get(getattr(leaf, name), 0) + leaf.weight
        return out

    leaves = list(tree)
    for level in ("region", "rack", "shard"):
        chosen = winner(level, below(leaves, level))
        leaves = [leaf for leaf in leaves if getattr(leaf, level) == chosen]
    return leaves[0].shard


def test_draws_equal_plain_python(spark):
    tree = tuple(sharding.Leaf(s // 8, s // 4, s, 1.0 + s % 3) for s in range(19))
    ids = spark.range(-200, 1500).withColumnRenamed("id", "doc_id")
    for leaves in (tree, sharding.layout(24), sharding.layout(26)):
        got = sharding.assign(ids, ids.doc_id, leaves, "shard").collect()
        assert all(r.shard == plain_draws(r.doc_id, leaves) for r in got)


def test_growing_moves_rows_into_the_new_shard_only(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    for planned, shards in ((9, 9), (9, 10), (1, 1), (1, 5), (24, 24), (24, 31)):
        both = sharding.assign(ids, ids.doc_id, sharding.layout(shards, planned=planned), "a")
        both = sharding.assign(both, ids.doc_id, sharding.layout(shards + 1, planned=planned), "b")
        moved = both.filter("a <> b")
        assert not moved.isEmpty() and moved.filter(f"b <> {shards}").isEmpty()
    with pytest.raises(ValueError):
        sharding.layout(23)
