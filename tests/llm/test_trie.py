"""The conversation trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from newsflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """(conv_id, depth) -> the other columns, without hashes of sequences or a decomposition."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    nodes = defaultdict(lambda: {"members": [], "ends": [], "children": set()})
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            nodes[turns[:d]]["members"].append(c)
            if d:
                nodes[turns[:d - 1]]["children"].add(turns[:d])
        nodes[turns]["ends"].append(c)
    sums = {}
    for key in sorted(nodes, key=len, reverse=True):
        node = nodes[key]
        size = len(key[-1][1].encode()) if key else 0
        below = [sums[k] for k in node["children"]]
        sums[key] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(node["members"]) - 1) * size)
    return {(n["members"][0], len(k)): (
        nodes[k[:-1]]["members"][0] if k else None, len(n["members"]), len(n["children"]), *sums[k],
        hashlib.sha256(",".join(map(str, n["ends"])).encode()).hexdigest()) for k, n in nodes.items()}


def spark_trie(spark, rows, local_rows):
    done = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), local_rows)
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in done.collect()}
    assert done.count() == len(out)
    return out


def random_rows(seed, convs=40, most=14):
    rnd = random.Random(seed)
    return [(c, turn if rnd.random() > 0.05 else None, rnd.choice(["user", "user", "bot", None]), rnd.choice(["a", "é", "", None]))
            for c in rnd.sample(range(-20, 60), convs) for turn in range(rnd.randint(1, most))]


@pytest.mark.parametrize("local_rows", [3, 60, 100_000])
def test_random_conversations(spark, local_rows):
    # equal turn numbers would be ordered by hashes here and by texts in plain Python
    rows = [r for r in random_rows(local_rows) if r[1] is not None]
    assert spark_trie(spark, rows, local_rows) == plain_trie(rows)


def test_nulls_repeats_and_conversations_left_empty(spark):
    rows = [(None, 1, "user", "x"), (0, 1, "user", "a"), (0, None, None, None), (7, 0, "user", "z"), (-3, 2, "user", "a"),
            (11, 0, "user", "a"), (11, 0, "user", "a"), (11, 0, "user", "a"), (12, 0, "bot", "b")]
    assert spark_trie(spark, rows, 2) == plain_trie(rows)


def test_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_TURNS", 16)
    monkeypatch.setattr(trie, "BLOCK_BITS", 1)
    rows = [(c, t, "user", "a" if t < 40 else f"{c}{t}") for c in (0, 5, 10, 15) for t in range(150 + c)]
    rows += [(20 + 5 * c, t, "user", "a") for c in range(30) for t in range(3)]
    assert spark_trie(spark, rows, 50) == plain_trie(rows)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.conversation_trie(empty).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a", 5, "x"), (1, 1, "bot", "b", 6, "y")],
                               SCHEMA + ", depth long, c string")
    assert trie.conversation_trie(df).count() == len(plain_trie([(1, 0, "user", "a"), (1, 1, "bot", "b")]))


@pytest.mark.parametrize("shape", ["random", "path", "star", "forest"])
def test_decomposition_adds_up_what_is_below(shape):
    rnd = np.random.default_rng(5)
    size = 700
    parent = np.array([{"random": lambda: rnd.integers(0, i), "path": lambda: i - 1, "star": lambda: 0,
                        "forest": lambda: rnd.integers(max(0, i - 9), i) if i % 50 else -1}[shape]() if i else -1
                       for i in range(size)])
    depth, own = np.zeros(size, np.int64), rnd.integers(1, 9, size)
    for i in range(1, size):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
    values = rnd.integers(0, 10 ** 15, (size, 2))
    weight, want = own.copy(), values.copy()
    for i in range(size - 1, 0, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    order = rnd.permutation(size)
    at = np.empty(size, np.int64)
    at[order] = np.arange(size)
    moved = np.where(parent[order] >= 0, at[parent[order]], -1)
    assert np.array_equal(trie.decompose(moved, depth[order], weight[order], values[order]), want[order])


def test_a_path_is_halved_in_every_round(monkeypatch):
    """A path of n nodes takes about log2(n) rounds."""
    rounds = []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: rounds.append(1) or lexsort(keys))
    size = 4096
    trie.decompose(np.arange(size) - 1, np.arange(size), np.arange(size, 0, -1), np.ones((size, 1), np.int64))
    assert len(rounds) <= 13
