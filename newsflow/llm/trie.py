"""The prefix trie of conversations, with totals below every node by centroid decomposition.

A node is a distinct sequence of first turns. It is known by its depth and two 64-bit sums (exclusive or) of
hashes of its turns and their places, so that long conversations are cut into blocks that tasks
sum up on their own.

Totals below nodes are not added up along the edges, as a path may be as long as a conversation. Every
component of the forest of parent edges is split at its centroid: the nodes that hold more than half of
the component below them form a path from the top, and the last of them is the centroid. What is below the
centroid is added once to every node of that path; then the components under the centroid and the rest are
split in the same way. Sizes count members of nodes, which are known before any total is. Components
beyond `local_rows` are split by joins; those within it are gathered, many to a task, and split there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.sharding import number_within
from newsflow.session import written

#: Turns of a block of a conversation, and bits of a conversation's id within a block of ids.
BLOCK_TURNS, BLOCK_BITS = 1024, 12
NODE = ["depth", "k1", "k2"]
TOP = ["top_depth", "t1", "t2"]
VALUES = ["leaf", "saved"]
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def numbered_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Turns as (c, pos, h1, h2, size): place from 0, two hashes of role and text, bytes of the text.

    A null role or text is an empty one. Turns are ordered by `turn`, null first; equal ones by their hashes, and
    repeated rows are turns of their own. Rows without an id belong to no conversation and are left out.
    """
    said = [F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))]
    slim = written(df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("c"), F.col(turn).cast("long").alias("t"),
        F.xxhash64(*said).alias("h1"), F.xxhash64(F.lit("second"), *reversed(said)).alias("h2"),
        F.octet_length(said[1]).cast("long").alias("size")), "turns")
    block = F.coalesce(F.floor(F.col("t") / BLOCK_TURNS), F.lit(-1 << 62)).cast("long")
    return number_within(slim, "c", ["t", "h1", "h2"], block, "pos")


def rebuild_turns(turns: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin like the first of their family, as (c, pos, h1, h2, size, turns).

    Conversation c takes the first h turns of c - c % `family` (all if there are fewer, none if there are none) and
    then its own turns after the first h, with h = crc32(c as text) % `heads`. A conversation left without
    turns keeps one row with a null `pos`. `turns` is the number of rebuilt turns.
    """
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % heads).cast("long")
    own = turns.groupBy("c").agg(F.count("*").alias("own"))
    first = (turns.filter(F.col("pos") < heads - 1).groupBy(F.col("c").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "h1", "h2", "size"))).alias("head")))
    convs = (own.withColumn("h", h).withColumn("base", F.col("c") - F.col("c") % family)
             .join(first, "base", "left")
             .withColumn("head", F.slice(F.coalesce("head", F.array().cast(first.schema["head"].dataType)),
                                         F.lit(1), F.col("h").cast("int")))
             .withColumn("taken", F.size("head").cast("long"))
             .withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
             .select("c", "h", "head", "taken", "turns"))
    heads_of = convs.filter("taken > 0 OR turns = 0").select(
        "c", "turns", F.explode_outer("head").alias("x")).select("c", "x.*", "turns")
    rest = (turns.withColumn("h", h).filter("pos >= h")
            .join(convs.select("c", "taken", "turns"), "c")
            .select("c", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "h1", "h2", "size", "turns"))
    return heads_of.unionByName(rest)


def _xor(column: str, window) -> Column:
    return F.coalesce(F.bit_xor(column).over(window), F.lit(0).cast("long"))


def memberships(rebuilt: DataFrame) -> DataFrame:
    """A row per conversation and depth, from 0 on: the node (k1, k2) and its parent (p1, p2)."""
    rows = (rebuilt.filter("pos IS NOT NULL").withColumn("block", F.floor(F.col("pos") / BLOCK_TURNS))
            .withColumn("g1", F.xxhash64("pos", "h1")).withColumn("g2", F.xxhash64("h2", "pos")))
    inside = Window.partitionBy("c", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.filter(F.col("turns") > BLOCK_TURNS).groupBy("c", "block")
              .agg(F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"))
              .select("c", "block", _xor("b1", before).alias("o1"), _xor("b2", before).alias("o2")))
    none = F.lit(0).cast("long")
    deep = (rows.withColumn("k1", _xor("g1", inside)).withColumn("k2", _xor("g2", inside))
            .join(blocks, ["c", "block"], "left")
            .withColumn("k1", F.col("k1").bitwiseXOR(F.coalesce("o1", none)))
            .withColumn("k2", F.col("k2").bitwiseXOR(F.coalesce("o2", none)))
            .select("c", (F.col("pos") + 1).alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("g1")).alias("p1"),
                    F.col("k2").bitwiseXOR(F.col("g2")).alias("p2"), "size", "turns"))
    top = rebuilt.filter("pos IS NULL OR pos = 0").select(
        "c", none.alias("depth"), none.alias("k1"), none.alias("k2"), F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), none.alias("size"), "turns")
    return deep.unionByName(top)


def trie_nodes(members: DataFrame) -> DataFrame:
    """A row per node: its members, parent, children, own values, and the memberships below it (`weight`)."""
    nodes = members.groupBy(*NODE).agg(
        F.min("c").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.count("*").alias("n_convs"), F.sum(F.col("turns") - F.col("depth") + 1).alias("weight"),
        F.max("size").alias("size"))
    nodes = written(nodes, "nodes")
    children = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                                                  F.col("p2").alias("k2")).agg(F.count("*").alias("n_children")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(children, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
            .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
            .withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
            .select(*NODE, "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "n_children", "weight", *VALUES))


def _split(big: DataFrame, members: DataFrame) -> DataFrame:
    """Split every component of `big` at its centroid; the centroid gets a null component and is done."""
    path = F.col("weight") * 2 > F.col("total")
    centroids = big.filter(path).groupBy(*TOP).agg(
        F.max_by(F.struct("depth", "k1", "k2", "weight"), "depth").alias("x")).select(
        *TOP, F.col("x.depth").alias("c_depth"), F.col("x.k1").alias("c1"), F.col("x.k2").alias("c2"),
        F.col("x.weight").alias("c_weight"))
    # the node under the centroid's depth on the way to a node tells whether the centroid is above it
    step = members.select(F.col("c").alias("conv_id"), (F.col("depth") - 1).alias("c_depth"), F.col("k1").alias("s1"),
                          F.col("k2").alias("s2"), F.col("p1").alias("c1"), F.col("p2").alias("c2"),
                          F.lit(True).alias("below"))
    rows = big.join(centroids, TOP).join(step, ["conv_id", "c_depth", "c1", "c2"], "left")
    below = F.coalesce(F.col("below") & (F.col("depth") > F.col("c_depth")), F.lit(False))
    centre = (F.col("depth") == F.col("c_depth")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    placed = written(rows.withColumn("below", below).withColumn("centre", centre).withColumn("path", path),
                     "placed")
    gains = placed.filter("below OR centre").groupBy(*TOP).agg(
        *[F.sum(v).alias(f"gain_{v}") for v in VALUES])
    tops = placed.filter("below AND depth = c_depth + 1").select(
        *TOP, F.col("k1").alias("s1"), F.col("k2").alias("s2"), F.col("weight").alias("new_total"))
    placed = placed.join(gains, TOP).join(tops, [*TOP, "s1", "s2"], "left")
    gained = {f"sum_{v}": F.when(F.col("path"), F.col(f"sum_{v}") + F.col(f"gain_{v}")).otherwise(F.col(f"sum_{v}"))
              for v in VALUES}
    kept = F.when(F.col("centre"), None)
    return placed.select(*[c for c in big.columns if c not in {"weight", "total", *TOP, *gained}],
                         *[c.alias(n) for n, c in gained.items()],
                         F.when(F.col("path") & ~F.col("centre"), F.col("weight") - F.col("c_weight"))
                         .otherwise(F.col("weight")).alias("weight"),
                         kept.when(F.col("below"), F.col("new_total"))
                         .otherwise(F.col("total") - F.col("c_weight")).alias("total"),
                         kept.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
                         kept.when(F.col("below"), F.col("s1")).otherwise(F.col("t1")).alias("t1"),
                         kept.when(F.col("below"), F.col("s2")).otherwise(F.col("t2")).alias("t2"))


def decompose(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of `values` (a row per node) over all that is below each node, itself included.

    `parent` is the place of a node's parent or -1 for a top; `weight` is what a node and all below it weigh,
    every node more than nothing. All components are split side by side, one centroid each in a round.
    """
    size = len(parent)
    sums, weight = np.zeros_like(values), weight.copy()
    place = np.arange(size)
    linked = parent >= 0
    root = np.where(linked, parent, place)
    while not np.array_equal(root, further := root[root]):
        root = further
    alive = np.ones(size, dtype=bool)
    while alive.any():
        live = np.flatnonzero(alive)
        path = live[2 * weight[live] > weight[root[live]]]
        path = path[np.lexsort((depth[path], root[path]))]
        last = np.flatnonzero(np.append(root[path][1:] != root[path][:-1], True))
        centre = np.full(size, -1)  # by the top of a component
        centre[root[path[last]]] = path[last]
        mine = centre[root]
        cut = alive & linked & (parent == mine)
        to = np.where(alive & linked & ~cut & (place != mine), parent, place)
        while not np.array_equal(to, further := to[to]):
            to = further
        # what is at or under a centroid now leads to it or to one of its children
        under = live[cut[to[live]] | (to[live] == mine[live])]
        gain = np.zeros_like(values)
        np.add.at(gain, mine[under], values[under])
        sums[path] += gain[mine[path]]
        lighter = path[path != mine[path]]
        weight[lighter] -= weight[mine[lighter]]
        linked &= ~cut
        alive[path[last]] = False
        linked[path[last]] = False
        root = np.where(alive, to, place)
    return sums


def _finish(small: DataFrame) -> DataFrame:
    """Totals in components of at most `local_rows` memberships, whole components at a time."""
    kept = [*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", *[f"sum_{v}" for v in VALUES]]
    schema = small.select(*kept).schema
    sorted_ = small.repartition(*TOP).sortWithinPartitions(*TOP)

    def solve(rows: pa.Table) -> pa.RecordBatch:
        col = {c: rows.column(c).to_numpy() for c in rows.column_names if c not in ("p1", "p2", "parent_conv_id")}
        keys = list(zip(*(col[c].tolist() for c in (*TOP, *NODE))))
        at = {key: i for i, key in enumerate(keys)}
        up = zip(keys, *(rows.column(c).to_pylist() for c in ("p1", "p2")))
        parent = np.fromiter((at.get((*key[:3], key[3] - 1, p1, p2), -1) for key, p1, p2 in up), np.int64, len(keys))
        values = np.stack([col[v] for v in VALUES], axis=1)
        sums = decompose(parent, col["depth"], col["weight"], values)
        arrays = {c: rows.column(c).combine_chunks() for c in kept}
        for i, v in enumerate(VALUES):
            arrays[f"sum_{v}"] = pa.array(sums[:, i] + col[f"sum_{v}"])
        return pa.RecordBatch.from_arrays([arrays[c] for c in kept], names=kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if left is None else pa.concat_tables([left, rows])
            tops = np.stack([rows.column(c).to_numpy() for c in TOP])
            borders = np.flatnonzero((tops[:, 1:] != tops[:, :-1]).any(axis=0))
            if not len(borders):
                left = rows
                continue
            end = int(borders[-1]) + 1
            yield solve(rows.slice(0, end))
            left = rows.slice(end)
        if left is not None:
            yield solve(left)

    return sorted_.mapInArrow(run, schema)


def roll_up(nodes: DataFrame, members: DataFrame, local_rows: int = 100_000) -> DataFrame:
    """`nodes` with `sum_leaf` and `sum_saved`, the sums of `leaf` and `saved` over all below a node."""
    none = F.lit(0).cast("long")
    total = nodes.filter("depth = 0").agg(F.max("weight").alias("total"))  # one row: the root's
    state = nodes.crossJoin(F.broadcast(total)).withColumns(
        {**{t: none for t in TOP}, **{f"sum_{v}": none for v in VALUES}})
    kept = [*NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", *[f"sum_{v}" for v in VALUES]]
    done, small = [], []
    while True:
        state = written(state, "components")
        done.append(state.filter("total IS NULL").select(*kept))
        small.append(state.filter(F.col("total") <= local_rows))
        big = state.filter(F.col("total") > local_rows)
        if big.isEmpty():
            break
        state = _split(big, members)
    out = _finish(_union(small))
    return _union([out, *done])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ends_of_nodes(members: DataFrame) -> DataFrame:
    """NODE and `ends_sha256` of the nodes where conversations end.

    Ids are joined by commas in blocks of neighbouring ids first; a task then reads the blocks of a node in
    order and keeps nothing but the state of the hash.
    """
    blocks = (members.filter("depth = turns").groupBy(*NODE, F.shiftright("c", BLOCK_BITS).alias("block"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",")
                   .alias("ids")))
    schema = blocks.select(*NODE).schema.add("ends_sha256", "string")
    sorted_ = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=schema.names)
        if now is not None:
            last = (*now, state.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in last], names=schema.names)

    return sorted_.mapInArrow(run, schema)


def prefix_trie(rebuilt: DataFrame, local_rows: int = 100_000) -> DataFrame:
    """The trie of conversations given as by `rebuild_turns`: a row per node.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. No conversations make no nodes, not even a root.
    """
    members = written(memberships(rebuilt), "memberships")
    nodes = written(trie_nodes(members), "trie")
    return (roll_up(nodes, members, local_rows).join(ends_of_nodes(members), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    F.col("sum_leaf").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


def conversation_trie(df: DataFrame, local_rows: int = 100_000, **columns: str) -> DataFrame:
    """`prefix_trie` of the rebuilt conversations of a table of turns.

    Nulls, equal turns and repeated rows are treated as in `numbered_turns`; columns beyond the four are
    not looked at, whatever their names; an empty table gives no rows.
    """
    return prefix_trie(rebuild_turns(numbered_turns(df, **columns)), local_rows)
