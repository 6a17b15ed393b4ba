"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A text is cut into paragraphs, its lines, with lines cut into pieces: at places that the content chooses, or
every LONG code points and short ones every SHORT, so that small texts have parts to compare. The set of their hashes is put into a sketch:
three tables of cells that each hold a count, the exclusive-or of the hashes and that of their check
sums. Subtracting two sketches leaves the differing hashes only, and peeling reads them cell by cell.
Where the difference is too large to peel, larger sketches are made, one per range of hashes, and a
range that still fails is retried with four times the cells. The likeness of two texts is the Jaccard
coefficient that the recovered difference gives. Larger sketches need the sets of both texts: two
sketches of 12 cells as they are returned do not give a large difference.

All of it is made of built-in functions. The sketches of a text are made in its own row; the only
shuffles bring together a text and its neighbour.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions.binding import let
from newsflow.llm.text import names
from newsflow.session import written

LONG, SHORT = 140, 24
#: Pieces of a long line end with a sentence, else after three or two characters of these kinds, else
#: after LONG;
#: those of a short one end at a blank after one of these letters, else after SHORT.
LONG_PIECE = (r"(?s).{64,320}?[.!?\u3002\uff01\uff1f]+ *"
              r"|.{64,320}?[aeostAEOST02468][bcdflmBCDFLM ][a-hA-H0-4 ]"
              r"|.{64,320}?[a-f0-4][g-z5-9 ]|.{1,%d}" % LONG)
SHORT_PIECE = r"(?s).{12,36}?[a-m] |.{1,%d}" % SHORT
TABLES, CELLS, BITS = 3, 4, 2  # a hash has one cell in each table; CELLS = 2 ** BITS
LOAD = 8  # hashes of both texts that one range should hold, at most
ROUNDS = 7
RETRIES = 3


def _shift(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", value, by if isinstance(by, Column) else F.lit(by))


def digests(text: Column) -> Column:
    """The distinct hashes of the paragraphs of `text`; the lowest bit of a hash is free."""
    return _digests(text, f"(?s).{{1,{LONG}}}", f"(?s).{{1,{SHORT}}}")


def content_digests(text: Column) -> Column:
    """Like `digests` of paragraphs whose ends the content chooses: after an insertion they line up again."""
    return _digests(text, LONG_PIECE, SHORT_PIECE)


def _digests(text: Column, long_piece: str, short_piece: str) -> Column:
    cut = lambda line, piece: F.regexp_extract_all(line, F.lit(piece), F.lit(0))
    pieces = F.flatten(F.transform(F.split(text, "\n"), lambda line: F.when(
        F.char_length(line) > LONG, cut(line, long_piece)).otherwise(cut(line, short_piece))))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p).bitwiseAND(F.lit(-2))))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(1)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(digest: Column, table: Column | int) -> Column:
    by = 1 + BITS * table if isinstance(table, int) else (table * BITS + 1).cast("int")
    return _shift(digest, by).bitwiseAND(F.lit(CELLS - 1))


def _merge(a: Column, b: Column, sign: Column | int) -> Column:
    return F.struct((a["n"] + b["n"] * sign).cast("int").alias("n"),
                    a["key"].bitwiseXOR(b["key"]).alias("key"),
                    a["check"].bitwiseXOR(b["check"]).alias("check"))


def _entry(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.cast("long").alias("key"),
                    check.cast("long").alias("check"))


def sketch(hashes: Column) -> Column:
    """The cells of a set of hashes: TABLES times CELLS structs of n, key and check."""
    empty = _entry(F.lit(0), F.lit(0), F.lit(0))

    def cells(table: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda i: F.aggregate(
            F.filter(hashes, lambda d: _cell(d, table) == i), empty,
            lambda a, d: _merge(a, _entry(F.lit(1), d, _check(d)), 1)))

    return F.concat(*[cells(t) for t in range(TABLES)])


def subtract(a: Column, b: Column) -> Column:
    """The sketch of what only one of two sets holds; hashes of `b` count negative."""
    return F.zip_with(a, b, lambda x, y: _merge(x, y, -1))


def peel(cells: Column) -> Column:
    """The hashes of a subtracted sketch with the side they come from (1 or -1), null if it fails.

    Each round takes the cells of one table that hold a single hash, so that no hash is met twice, and
    takes these hashes out of all tables.
    """
    def step(state: Column, turn: Column) -> Column:
        table = F.pmod(turn, F.lit(TABLES))
        alone = F.filter(F.slice(state["cells"], table * CELLS + 1, CELLS), lambda c: (
            (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))))
        return let(alone, lambda found: F.when(F.size(found) == 0, state).otherwise(F.struct(
            F.transform(state["cells"], lambda c, i: F.aggregate(
                F.filter(found, lambda p: _cell(p["key"], F.floor(i / CELLS)) == F.pmod(i, F.lit(CELLS))),
                c, lambda a, p: _merge(a, p, -1))).alias("cells"),
            F.concat(state["found"], F.transform(found, lambda p: F.struct(
                p["key"].alias("key"), p["n"].alias("side")))).alias("found"))))

    nothing = F.array().cast("array<struct<key:bigint,side:int>>")
    start = F.struct(cells.alias("cells"), nothing.alias("found"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return let(end, lambda s: F.when(F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (
        c["check"] == 0)), s["found"]))


def _ranges(both: Column, group) -> Column:
    """The sorted hashes `both` cut where `group` of a hash changes."""
    n = F.size(both)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        group(F.get(both, i)) != group(F.get(both, i - 1))))
    return let(starts, lambda s: F.transform(s, lambda at, k: F.slice(
        both, at + 1, F.coalesce(F.get(s, k + 1), n) - at)))


def _peel_part(part: Column) -> Column:
    """The differing hashes of one range, null if its sketches cannot be peeled.

    Hashes of the second text have their lowest bit set. The difference of the two sketches is made in one signed pass:
    the hashes of the second text count negative.
    """
    empty = _entry(F.lit(0), F.lit(0), F.lit(0))

    def table(entries: Column, number: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda i: F.aggregate(
            F.filter(entries, lambda e: _cell(e["key"], number) == i), empty, lambda a, e: _merge(a, e, 1)))

    def cells(entries: Column) -> Column:
        return F.concat(*[table(entries, number) for number in range(TABLES)])

    def signed(d: Column) -> Column:
        return let(d.bitwiseAND(F.lit(-2)), lambda key: _entry(1 - 2 * d.bitwiseAND(F.lit(1)), key, _check(key)))

    return peel(let(F.transform(part, signed), cells))


def _sides(part: Column) -> tuple[Column, Column]:
    return (F.filter(part, lambda x: x.bitwiseAND(F.lit(1)) == 0),
            F.transform(F.filter(part, lambda x: x.bitwiseAND(F.lit(1)) == 1),
                        lambda x: x.bitwiseAND(F.lit(-2))))


def _exact(part: Column) -> Column:
    a, b = _sides(part)
    signed = lambda side: lambda d: F.struct(d.alias("key"), F.lit(side).alias("side"))
    return F.concat(F.transform(F.array_except(a, b), signed(1)),
                    F.transform(F.array_except(b, a), signed(-1)))


def difference(df: DataFrame, a: str, b: str, sketch_a: str, sketch_b: str, out: str) -> DataFrame:
    """`df` with `out`: the hashes that one of the sets `a` and `b` holds alone, with their side.

    They are peeled from the sketches of the sets. Only where this fails larger sketches are made, a
    pair per range of hashes; a range that fails is cut into CELLS finer ones, RETRIES times.
    """
    whole, bits, parts, peeled, found = names(df.columns, "whole", "bits", "parts", "peeled", "found")
    n = F.size(a) + F.size(b)
    # more hashes on one side than there are cells cannot be peeled
    hopeless = F.abs(F.size(a) - F.size(b)) > TABLES * CELLS
    df = df.withColumn(whole, F.when(~hopeless, peel(subtract(F.col(sketch_a), F.col(sketch_b)))))
    df = df.withColumn(bits, F.greatest(
        F.lit(1), F.ceil(F.log2(F.greatest(n, F.lit(1)) / LOAD))).cast("int"))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(parts, F.when(F.col(whole).isNull(), F.sort_array(F.concat(
        a, F.transform(b, lambda x: x.bitwiseOR(F.lit(1)))))).otherwise(none))
    df = df.withColumn(parts, F.when(F.size(parts) > 0, _ranges(
        F.col(parts), lambda x: _shift(x, 64 - F.col(bits)))).otherwise(F.array().cast("array<array<bigint>>")))
    df = df.withColumn(found, F.coalesce(whole, F.array().cast("array<struct<key:bigint,side:int>>")))
    for retry in range(RETRIES + 1):
        df = df.withColumn(peeled, F.transform(parts, _peel_part))
        good = F.flatten(F.filter(peeled, lambda x: x.isNotNull()))
        failed = F.filter(parts, lambda x, i: F.get(F.col(peeled), i).isNull())
        df = df.withColumn(found, F.concat(found, good)).withColumn(parts, failed)
        if retry < RETRIES:
            by = 64 - F.col(bits) - BITS * (retry + 1)
            df = df.withColumn(parts, F.flatten(F.transform(
                parts, lambda p: _ranges(p, lambda x: _shift(x, by)))))
    # only hashes that agree in all the bits that choose cells and ranges are left
    df = df.withColumn(out, F.concat(found, F.flatten(F.transform(parts, _exact))))
    return df.drop(whole, bits, parts, peeled, found)


def likeness(n_a: Column, n_b: Column, differing: Column) -> Column:
    """Jaccard coefficient of two sets from their sizes and the size of their difference."""
    both = n_a + n_b
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def written_sketch(n: Column, cells: Column) -> Column:
    """A sketch as a string: the number of hashes, then count, hash and check of each cell."""
    return F.concat(n.cast("string"), F.lit("/"), F.array_join(F.transform(
        cells, lambda c: F.when(c["n"] == 0, F.lit("")).otherwise(
            F.concat(c["n"].cast("string"), F.lit("."), F.lower(F.hex(c["key"])), F.lit("."),
                     F.lower(F.hex(c["check"]))))), ","))


def _neighbours(keys: DataFrame) -> DataFrame:
    """Columns `key`, `doc_id`, `n_chars`, `next`: the key of the next document by descending id.

    Keys are dealt into ranges of ids and written, each range is ordered on its own, and the first key
    of the range after it, one row per range, follows its last.
    """
    ranged = keys.repartitionByRange(F.desc("doc_id"), F.desc("key"))
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    place = F.struct("doc_id", "key")
    heads = ranged.groupBy("part").agg(F.max(place)["key"].alias("head"))
    by_part = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(
        F.lead("head").over(by_part),
        F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    within = F.lead("key").over(Window.partitionBy("part").orderBy(F.desc("doc_id"), F.desc("key")))
    return (ranged.withColumn("within", within).join(F.broadcast(heads), "part")
            .select("key", "doc_id", "n_chars", F.coalesce("within", "after").alias("next")))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          pieces: Callable[[Column], Column] = digests) -> DataFrame:
    """Per document: its id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The edited text has its last third replaced by the beginning of the next document's text, by
    descending id; after the last comes the first. Null texts are empty, a null id comes last, and
    rows with one id follow each other by a hash of their text. Rows that agree in id and text are one
    document to their neighbours, and each gives its row. An empty table gives no rows. `pieces` makes the
    set of a text: `digests` cuts at fixed places, `content_digests` where the content says.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"), filled.alias("text"),
        F.md5(F.concat_ws("/", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), filled)).alias("key"))
    keys = base.select("doc_id", "key", F.char_length("text").alias("n_chars")).dropDuplicates(["key"])
    links = _neighbours(keys).withColumnsRenamed({"key": "owner", "next": "key"})
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    # for each document, what it takes from the next one
    texts = base.select("key", "text")  # dealt by key once, for both joins
    taken = texts.join(links, "key").select(
        F.col("owner").alias("key"), "doc_id", F.substring("text", F.lit(1), cut).alias("head"),
        pieces(F.col("text")).alias("next_set"))
    taken = taken.groupBy("key").agg(*[F.first(c).alias(c) for c in ("doc_id", "head", "next_set")])
    rows = texts.join(taken, "key").withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.select("doc_id", "n_chars", "next_set", "text", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.col("head")).alias("edited"))
    rows = rows.select("doc_id", "n_chars", "next_set", F.sha2("edited", 256).alias("edited_sha256"),
                       pieces(F.col("text")).alias("own_set"), pieces(F.col("edited")).alias("edited_set"))
    sets = ("own", "edited", "next")
    rows = rows.withColumns({f"{s}_sketch": sketch(F.col(f"{s}_set")) for s in sets})

    for other in ("edited", "next"):
        rows = difference(rows, "own_set", f"{other}_set", "own_sketch", f"{other}_sketch", f"{other}_diff")
    near = {o: likeness(F.size("own_set"), F.size(f"{o}_set"), F.size(f"{o}_diff")) for o in sets[1:]}
    return rows.select(
        F.col("doc_id").alias(doc_id), "n_chars", "edited_sha256",
        written_sketch(F.size("own_set"), F.col("own_sketch")).alias("fingerprint"),
        written_sketch(F.size("edited_set"), F.col("edited_sketch")).alias("edited_fingerprint"),
        near["edited"].alias("near_edited"), near["next"].alias("near_next"))
