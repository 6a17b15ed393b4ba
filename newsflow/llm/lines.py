"""Line dedup: lines that many documents share stay in one of them.

Long normalised lines are exploded, hashed (128 bits) and counted by distinct document. The hashes over
the threshold go back to the lines by a salted join, which adaptive execution can split further, so a
line that a third of all documents hold burdens no task; its count is summed before the shuffle. Only
hashes, ids and positions move there; the texts move once, to meet the positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.binding import let
from newsflow.llm.text import WHITE, lower_ascii, names


def line_key(line: Column) -> Column:
    """What two lines must have in common to be the same: stripped, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


#: Parts that the rows of one line are dealt into; the few lines over the threshold are copied to all.
SALTS = 16


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """`docs` with `text` without its repeated lines, and `n_lines`, `n_dropped` (long).

    A line whose key has at least `min_chars` code points and is held by at least `min_docs` documents
    is dropped everywhere but in the document with the largest id that holds it, where every copy
    stays. `n_lines` counts the lines before. A null or empty text is one empty line. Rows with one id
    are one document; they keep their rows, and equal rows get equal results. A null id counts as one
    document, smaller than all others. Columns of `docs` named like the new ones are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    digest, pos, line, key, n, last, drop, salt = names(
        kept, "digest", "pos", "line", "key", "n", "last", "drop", "salt")
    base = docs.select(kept).withColumn(text, F.coalesce(F.col(text), F.lit("")))
    base = base.withColumn(digest, F.xxhash64(text))
    lines = base.select(doc_id, digest, F.posexplode(F.split(text, "\n")).alias(pos, line))
    # stripping only shortens: short lines go before their key is made
    long = (lines.filter(F.char_length(line) >= min_chars).withColumn(line, line_key(F.col(line)))
            .filter(F.char_length(line) >= min_chars))
    keys = long.select(doc_id, digest, pos, F.unhex(F.md5(line)).alias(key))
    null_id = F.max(F.col(doc_id).isNull().cast("int"))
    common = (keys.groupBy(key)
              .agg((F.count_distinct(doc_id) + null_id).alias(n), F.max(doc_id).alias(last))
              .filter(F.col(n) >= min_docs)
              .select(key, last, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt)))
    losing = F.col(doc_id).isNull() | (F.col(doc_id) < F.col(last))
    salted = keys.withColumn(salt, F.pmod(F.xxhash64(doc_id, pos), F.lit(SALTS)).cast("int"))
    hits = (salted.join(common, [key, salt]).filter(losing).groupBy(doc_id, digest)
            .agg(F.collect_set(pos).alias(drop)))
    hits = hits.select(F.col(doc_id).alias(f"{drop}_id"), F.col(digest).alias(f"{drop}_digest"), drop)
    joined = base.join(hits, F.col(doc_id).eqNullSafe(F.col(f"{drop}_id"))
                       & (F.col(digest) == F.col(f"{drop}_digest")), "left")
    remaining = let(F.split(text, "\n"), lambda all_lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(drop)),
        lambda i: F.get(all_lines, i)), "\n"))
    count = F.char_length(text) - F.char_length(F.translate(text, "\n", "")) + 1
    return joined.select(
        *[F.when(F.col(drop).isNull(), F.col(text)).otherwise(remaining).alias(c) if c == text
          else F.col(c) for c in kept],
        count.cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"))
