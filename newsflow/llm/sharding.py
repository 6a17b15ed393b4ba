"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level every child draws ln(u) / weight, with u a hash of the key and the child's name, and the
largest draw wins: children win in proportion to their weights, and changing one child's weight moves
keys only to or from that child. A node's weight is the sum below it, so movement stays inside the
subtrees whose weights change. One more shard opens a region of its own, so that keys move only there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.text import names

#: Blocks that the keys of a shard are numbered in; the table of their counts has shards x BLOCKS rows.
BLOCKS = 256


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, racks: int = 4, per_rack: int = 4, planned: int = 24) -> tuple[Leaf, ...]:
    """The tree of `shards` shards: `planned` ones in regions of racks, each later one on its own.

    A region holds 2 racks of `per_rack` shards. A shard beyond the planned ones is a new region, so
    growing by one moves keys only into the new shard; plan anew to fold such shards into regions. Fewer shards than
    planned are an error: a shard that joins a region draws keys into its neighbours as well.
    """
    if shards < planned:
        raise ValueError(f"{shards} shards, but {planned} are planned: plan for the smallest number")
    per_region = per_rack * max(1, racks // 2)
    base = [Leaf(s // per_region, s // per_rack, s) for s in range(planned)]
    regions = -(-planned // per_region)
    racks_planned = -(-planned // per_rack)
    return tuple(base + [Leaf(regions + i, racks_planned + i, planned + i)
                         for i in range(shards - planned)])


def _draw(key: Column, level: str, child: int, weight: float) -> Column:
    bits = F.call_function("shiftrightunsigned", F.xxhash64(key, F.lit(f"{level}:{child}")), F.lit(11))
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return F.struct((F.log(uniform) / weight).alias("draw"), F.lit(child).alias("child"))


def _winner(key: Column, level: str, children: dict[int, float]) -> Column:
    if len(children) == 1:
        return F.lit(next(iter(children)))
    return F.greatest(*[_draw(key, level, c, w) for c, w in sorted(children.items())])["child"]


def _descend(key: Column, chosen: Column, level: str, below: dict[int, dict[int, float]]) -> Column:
    """The winning child under the chosen node; only that node's children draw."""
    cases = reduce(lambda c, node: c.when(chosen == node, _winner(key, level, below[node])),
                   sorted(below), F)
    return cases


def assign(df: DataFrame, key: Column, tree: tuple[Leaf, ...], out: str) -> DataFrame:
    """`df` with the shard of `key` in `tree`; a null key is a key like any other."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    shards: dict[int, dict[int, float]] = {}
    for leaf in tree:
        regions[leaf.region] = regions.get(leaf.region, 0) + leaf.weight
        rack = racks.setdefault(leaf.region, {})
        rack[leaf.rack] = rack.get(leaf.rack, 0) + leaf.weight
        shards.setdefault(leaf.rack, {})[leaf.shard] = leaf.weight
    region, rack = names([*df.columns, out], "region", "rack")
    df = df.withColumn(region, _winner(key, "region", regions))
    df = df.withColumn(rack, _descend(key, F.col(region), "rack", racks))
    return df.withColumn(out, _descend(key, F.col(rack), "shard", shards)).drop(region, rack)


def number_within(df: DataFrame, group: str, order: list[str], block: Column, out: str) -> DataFrame:
    """`df` with a gapless number from 0 within each `group`, by block and then `order`.

    `block` splits a group into parts that tasks sort on their own; the counts of the parts, one row
    each, give the first number of a part.
    """
    b, n, first = names([*df.columns, out], "block", "n", "first")
    parts = df.select(group, block.alias(b)).groupBy(group, b).agg(F.count("*").alias(n))
    running = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(group, b, F.coalesce(F.sum(n).over(running), F.lit(0)).alias(first))
    place = F.row_number().over(Window.partitionBy(group, b).orderBy(*order)) - 1
    ranked = df.withColumn(b, block).withColumn(out, place)
    return (ranked.join(starts, [group, b])
            .withColumn(out, (F.col(out) + F.col(first)).cast("long")).drop(b, first))


def shard_documents(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id",
                    text: str = "text", planned: int = 24) -> DataFrame:
    """Per document: its id, size, text_crc32, law, shard, slot and grown_shard.

    `size` is the bytes of the text in UTF-8 plus 8, `grown_shard` the place with one more shard,
    `slot` the place in the shard. A null text has no bytes. The id alone decides, so repeated rows
    share a shard and have slots of their own; a null id is one more key. `planned` is the smallest number of
    shards that a corpus will ever have.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    base = docs.select(doc_id, (F.octet_length(raw) + 8).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"))
    base = assign(base, F.col(doc_id), layout(shards, planned=planned), "shard")
    base = assign(base, F.col(doc_id), layout(shards + 1, planned=planned), "grown_shard")
    block = F.pmod(F.xxhash64(doc_id, F.lit("block")), F.lit(BLOCKS)).cast("int")
    done = number_within(base, "shard", [doc_id, "size", "text_crc32"], block, "slot")
    return done.select(doc_id, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
