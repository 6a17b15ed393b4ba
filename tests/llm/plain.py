"""Plain Python versions of the operators, and awkward rows for small tests."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """A documents table of (doc_id, text) rows."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def tables(spark, folder, **frames):
    """Write tables where a query looks for them."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def dedup_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(i)
    rank = lambda i: (i is not None, i or 0)
    last = {k: max(v, key=rank) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))
