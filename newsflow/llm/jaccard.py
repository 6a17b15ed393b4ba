"""N-gram Jaccard join by a hash partition of the sets, and count vectors for what it leaves.

A document's set holds the hashes of its distinct five-word shingles. The hashes are dealt into groups,
and the counts of the groups are the document's point. What two sets share is at most the sum of the
smaller counts over all groups, so documents at a Jaccard coefficient of 0.8 or more differ by at most a
ninth of both sizes, summed over all coordinates.

The top level of the index uses this across the cluster: coordinates are cut into more blocks than such
documents may differ by, so that some block, that is not empty, has the same counts in both. Documents
meet in buckets keyed by the sum of the hashes in a block: two meet where they hold the same shingles of a
block, not only as many. Most candidates come from this partition of the sets. In each bucket the documents are first compared with one
of them, which settles groups of near copies without their pairs. Where a bucket then still holds more
than one component, an R-tree over the points of its documents gives the pairs whose bound allows a link.
All pairs are verified on the sets themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import Remembered
from newsflow.llm.components import components
from newsflow.llm.text import small_batches
from newsflow.session import written

WORDS = 5
GROUPS = 64  # coordinates of a point
FINE = 1024  # finer groups, of which GROUPS are made: their bound is tried where that of a point holds
#: Blocks that a document is looked up by, at most; None looks it up by all, which is exact. Two sets that need more have about 0.4 of them in
#: common at a coefficient of 0.8, so that all 40 differ with a chance of 0.6 ** 40, about 1e-9.
BLOCKS = 40
CHUNK = 1000  # documents of a bucket that a task compares with as many others at a time
LEAF = 32

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xFF51AFD7ED558CCD], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * _STEPS[3]
    x = (x ^ (x >> np.uint64(29))) * _STEPS[4]
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of shingle hashes; remembers the hashes of words."""

    def __init__(self):
        self.words = Remembered(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        # lower() and split() of bytes know ASCII only: A-Z, and white space 09-0D and 20
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        if len(h) < WORDS:
            if not len(h):
                return h
            return _mixed((h * _STEPS[:len(h)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(h)))
        n = len(h) - WORDS + 1
        total = h[:n] * _STEPS[0]
        for i in range(1, WORDS):
            total += h[i:i + n] * _STEPS[i]
        return np.unique(_mixed(total))


_ZONES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # a plain dict travels with the functions


def zones(limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size classes up to `limit`: where each begins, how many blocks its zone has, and spare ones.

    A set and any that it may link with lie in one class or in two neighbouring ones. Zone z serves
    pairs whose smaller set is in class z.
    """
    if limit not in _ZONES:
        _ZONES[limit] = _zones(limit)
    return _ZONES[limit]


def _zones(limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = [1, 2]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, 5 * (starts[-1] - 1) // 4 + 1))
    largest = np.array(starts[1:]) - 1
    differ = (largest + 5 * largest // 4) // 9
    spare = 1 + -(-differ // 10)
    return np.array(starts), np.where(differ > 0, differ + 1 + spare, 0), spare


def block_keys(shingles: np.ndarray, most: int | None = BLOCKS) -> np.ndarray:
    """The keys of the buckets in which a set meets all that it may link with, by `most` blocks, or by all."""
    n = len(shingles)
    starts, blocks, spare = zones(1 << max(10, int(2 * n).bit_length()))
    size_class = int(np.searchsorted(starts, n, "right")) - 1
    found, sparse = [], False
    for zone in (size_class, size_class - 1):
        if zone < 0 or not blocks[zone]:
            continue  # sets of this size link with equal ones only
        block = (shingles >> np.uint64(20)) % np.uint64(blocks[zone])
        few = int(blocks[zone]) if most is None else min(most, int(blocks[zone]))
        inside = block < few
        own = block[inside]
        order = np.argsort(own, kind="stable")
        own, held = own[order], _mixed(shingles[inside][order] * _MIX)
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else own
        sparse |= blocks[zone] == few and few - len(first) > spare[zone]
        if len(first):
            # the sum of its hashes stands for the counts of a block
            counts = np.add.reduceat(held, first.astype(np.int64))
            place = own[first.astype(np.int64)] * np.uint64(1 << 20) + np.uint64(zone)
            found.append(_mixed(counts + _mixed(place)))
    if sparse:
        # so many blocks are empty that equal ones might all be: the smallest hashes serve as well, as two
        # such sets have one of these in common
        prefix = shingles[:n - (4 * n + 4) // 5 + 1]
        found.append(_mixed(prefix ^ _STEPS[2]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def point(shingles: np.ndarray) -> bytes:
    """The counts of the fine groups: the group of each hash in order, or all counts if that is shorter."""
    group = (shingles >> np.uint64(54)).astype(np.uint16)  # the hashes are sorted, so these are
    if 2 * len(group) < 4 * FINE:
        return group.tobytes()
    return np.bincount(group, minlength=FINE).astype(np.uint32).tobytes()


def fine_counts(point: bytes) -> np.ndarray:
    if len(point) == 4 * FINE:
        return np.frombuffer(point, np.uint32).astype(np.int32)
    return np.bincount(np.frombuffer(point, np.uint16), minlength=FINE).astype(np.int32)


def coarse_counts(fine: np.ndarray) -> np.ndarray:
    return fine.reshape(*fine.shape[:-1], GROUPS, FINE // GROUPS).sum(axis=-1)


class CountTree:
    """An R-tree over points of counts, packed by halving along the widest coordinate.

    A node keeps the largest count of each coordinate, which bounds what any point in it can share.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.high, self.low, self.children = [], [], []
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        node = len(self.high)
        self.high.append(self.points[rows].max(axis=0))
        self.low.append(self.sizes[rows].min())
        self.children.append(rows)
        if len(rows) > LEAF:
            spread = self.points[rows].max(axis=0) - self.points[rows].min(axis=0)
            order = rows[np.argsort(self.points[rows, spread.argmax()], kind="stable")]
            half = len(order) // 2
            self.children[node] = (self._build(order[:half]), self._build(order[half:]))
        return node

    def near(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose overlap with a set of `size` shingles at `point` may reach the threshold."""
        found, open_nodes = [], [self.root]
        while open_nodes:
            node = open_nodes.pop()
            if 9 * int(np.minimum(point, self.high[node]).sum()) < 4 * (size + int(self.low[node])):
                continue
            inside = self.children[node]
            if isinstance(inside, tuple):
                open_nodes += inside
            else:
                shared = np.minimum(self.points[inside], point).sum(axis=1)
                found.append(inside[9 * shared >= 4 * (self.sizes[inside] + size)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def set_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              blocks: int | None = BLOCKS) -> DataFrame:
    """Per document: `doc_id`, `n`, `node` (hash of its set, null if empty), `point`, `keys`, and `mark`, a
    hash of its text.

    Within a task only the first document with a set has keys; its copies meet others through it.
    """
    small_batches(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), Remembered(lambda node: False)
        for batch in batches:
            sizes, nodes, points, keys = [], [], [], []
            for value in batch.column(1).to_pylist():
                shingles = shingler(value)
                sizes.append(len(shingles))
                if not len(shingles):
                    nodes.append(None)
                    points.append(None)
                    keys.append([])
                    continue
                node = int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(),
                                      "little", signed=True)
                nodes.append(node)
                points.append(point(shingles))
                keys.append([] if seen[node] else block_keys(shingles, blocks).view(np.int64))
                seen[node] = True
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(points, pa.binary()), pa.array(keys, pa.list_(pa.int64())), batch.column(2)],
                names=["doc_id", "n", "node", "point", "keys", "mark"])

    return docs.select(F.col(doc_id).alias("doc_id"), text, F.xxhash64(text)).mapInArrow(
        read, "doc_id long, n long, node long, point binary, keys array<long>, mark long")


def _verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b) whose sets reach the threshold. `docs` has doc_id and text, `owners` the
    doc_id (or null) and the mark of a row for each node: only the sets of documents that are in a pair are
    made again, of rows that agree in both once in a task."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = owners.join(needed, "node", "left_semi").select("owner", "node")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), Remembered(lambda node: False)
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not seen[node]:
                    nodes.append(node)
                    sets.append(shingler(text).view(np.int64))
                seen[node] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    same = docs["doc_id"].eqNullSafe(wanted["owner.doc_id"]) & (F.xxhash64(docs["text"]) == wanted["owner.mark"])
    sets = written(docs.join(wanted, same).select("node", "text")
                   .mapInArrow(read, "node long, shingles array<long>"), "sets")
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(two, "b").join(one, "a")
            .filter(9 * both >= 4 * (F.size("set_a") + F.size("set_b"))).select("a", "b"))


def _candidates(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes in one bucket, of different components, that the bound lets link.

    `members`: bucket `key`, `node`, `label`, `n`, `point`. A bucket is dealt into chunks, and every two
    chunks are joined by themselves, so that a task holds two chunks whatever the bucket's size.
    """
    chunks = members.groupBy("key").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = members.join(chunks, "key").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    copies = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    copies = copies.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                           (F.col("own") <= F.col("other")).alias("first"), "node", "label", "n", "point")
    group = ["key", "i", "j"]

    def pairs_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        node, label, n = (rows.column(c).to_numpy() for c in ("node", "label", "n"))
        fine = np.stack([fine_counts(p) for p in rows.column("point").to_pylist()])
        points = coarse_counts(fine)
        same = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
        first = rows.column("first").to_numpy(zero_copy_only=False)
        left = np.arange(len(node)) if same else np.flatnonzero(first)
        right = left if same else np.flatnonzero(~first)
        a, b = [], []
        if len(left) and len(right):
            tree = CountTree(points[right], n[right])
            for row in left:
                found = right[tree.near(points[row], int(n[row]))]
                found = found[label[found] != label[row]]
                if same:
                    found = found[node[found] > node[row]]
                shared = np.minimum(fine[found], fine[row]).sum(axis=1)
                found = found[9 * shared >= 4 * (n[found] + n[row])]
                a.append(np.minimum(node[found], node[row]))
                b.append(np.maximum(node[found], node[row]))
        none = np.zeros(0, np.int64)
        return (np.concatenate(a), np.concatenate(b)) if a else (none, none)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
            found = [pairs_of(table.slice(s, e - s)) for s, e in zip([0, *ends[:-1]], ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], names=["a", "b"])

        rest = None  # the group that the next batch may go on with
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            marks = [rest.column(c).to_numpy() for c in group]
            new = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            if len(new):
                yield emit(rest.slice(0, int(new[-1])), new)
                rest = rest.slice(int(new[-1]))
        if rest is not None and rest.num_rows:
            yield emit(rest, np.array([rest.num_rows]))

    return (copies.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(join, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    blocks: int | None = BLOCKS) -> DataFrame:
    """Per document: its id, `n_shingles` and `component_id`, the smallest id reachable by links.

    Beside them `component`, a number of the component (null for a text without words), and `mark`, the xxhash64 of
    the text. With `blocks` null sets of any size are looked up by all their blocks, so that no link is left to
    chance.

    A-Z count as a-z, words are what ASCII white space parts, and a text of fewer words than a shingle
    has is one shingle. Two documents link when 100 times the shingles in both are at least 80 times
    those in either. A text without words, or null, links with nothing. Rows with one id
    have a component each, by their own texts; a null id is never a component's id unless all its documents lack one.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    points = written(set_table(docs, blocks=blocks), "points")
    members = points.select("node", F.explode("keys").alias("key"))
    shared = members.groupBy("key").count().filter("count > 1").select("key")
    buckets = written(members.join(written(shared, "keys"), "key", "left_semi").distinct(), "buckets")
    owners = points.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "mark")).alias("owner"), F.first("n").alias("n"), F.first("point").alias("point"))
    # everyone in a bucket is compared with the first
    heads = written(buckets.groupBy("key").agg(F.min("node").alias("a")), "heads")
    stars = written(buckets.join(heads, "key").filter("node != a")
                    .select("a", F.col("node").alias("b")).distinct(), "stars")
    links = written(_verified(stars, docs, owners), "links")
    labels = components(links)
    # what is left: buckets with more than one component
    labelled = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = written(labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                    .filter("low != high").select("key"), "mixed")
    left = labelled.join(mixed, "key", "left_semi").join(owners.select("node", "n", "point"), "node")
    more = _candidates(left).join(stars, ["a", "b"], "left_anti")
    more = written(_verified(written(more, "pairs"), docs, owners), "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    # the smallest id of every component, for the sets that more than one document has or links with
    named = owners.select("node", "doc_id").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    lowest = written(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = written(named.join(lowest, "label").select("node", "component_id", F.col("label").alias("component")), "named")
    rows = points.select("doc_id", "n", "node", "mark").join(named, "node", "left")
    return rows.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"),
                       F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(
                           F.col("component_id")).alias("component_id"), "component", "mark")
