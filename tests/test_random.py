"""Expressions against plain Python on random texts."""

import random
import re
import time
from urllib.parse import urljoin

from pyspark.sql import functions as F

from newsflow.functions import html, scores, text

BREAKS = ["\n", "\n", "\r\n", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x85",
          "\N{LINE SEPARATOR}", "\N{PARAGRAPH SEPARATOR}"]
LINES = ["Related article", " Related article\t", "\xa0Related article", "Related articles", "x", "",
         "\t\t\tkeep", " " * 12 + "ok ", " " * 12, "\t\t\tRelated article", " " * 12 + "New York CNN - a",
         "\t\t\tCNN Business\xa0- b", "\t\t\t\N{IDEOGRAPHIC SPACE}c\x1f", "\t\t“d”"]
PREFIX = re.compile(r"^(?:[A-Za-z\s]+)?\bCNN(?: Business)?\s*-\s*")


def expected_body(content):
    lines = iter(content.strip("“”\"").splitlines())
    kept = []
    for line in lines:
        if line.strip() == "Related article":
            next(lines, None)
        elif line.startswith(("\t\t\t", " " * 12)):
            kept.append(line.strip())
    return PREFIX.sub("", " ".join(kept))


def both(spark, make, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r.out for r in df.select("i", make.alias("out")).orderBy("i").collect()]


def test_clean_body(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(LINES) + rng.choice(BREAKS) for _ in range(rng.randrange(12)))
             for _ in range(3000)]
    texts = [rng.choice(["", "“", '"']) + t + rng.choice(["", "”"]) for t in texts]
    got = both(spark, text.clean_body(F.col("t")), [(t,) for t in texts], "t string")
    assert got == [expected_body(t) for t in texts]


def test_scrub(spark):
    rng = random.Random(12)
    parts = ["http://a.b/c", "https://x", "<b>", "</b>", "<", ">", "[x]", "(y", ")", "(z)", " ", "\n", "\xa0",
             "word", "  ", "\t", "[", "]", "(", "\ufdd0"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(15))) for _ in range(4000)]

    def expected(t):
        for pattern, to in ((r"http[s]?://\S+", ""), (r"<.*?>", ""), (r"\[.*?\]|\(.*?\)", ""), (r"\s+", " ")):
            t = re.sub(pattern, to, t, flags=re.ASCII)
        return t

    got = both(spark, text.scrub(F.col("t")), [(t,) for t in texts], "t string")
    assert got == [expected(t) for t in texts]


def test_scrub_is_linear_in_unmatched_brackets(spark):
    size = 200_000
    texts = [c * size for c in "([<"] + ["(" * size + "]", "[" * size + ")", "<" * size + "\n>", "(" * 9 + ")"]
    start = time.time()
    got = both(spark, text.scrub(F.col("t")), [(t,) for t in texts], "t string")
    assert time.time() - start < 20
    assert got == [*texts[:5], "<" * size + " >", ""]


def test_windows(spark):
    rng = random.Random(13)
    for _ in range(8):
        length, step, lead, trail = rng.randrange(1, 9), rng.randrange(1, 9), rng.randrange(2), rng.randrange(2)
        rows = [[f"w{i}" for i in range(rng.randrange(30))] for _ in range(50)]

        def expected(words):
            marked = [None] * lead + words + [None] * trail
            if not words:
                return []
            return [[w for w in marked[i:i + length] if w] for i in range(0, len(marked), step)]

        got = both(spark, scores.windows(F.col("t"), length, step, lead, trail), [(r,) for r in rows],
                   "t array<string>")
        assert got == [expected(r) for r in rows]


def test_url_join(spark):
    rng = random.Random(14)
    bases = ["http://a.b", "http://a.b/", "https://a.b/c/d", "http://a.b/c/d/?q=1", "http://a.b/c/d.html#f"]
    pieces = ["a", "..", ".", "b.pdf", "c"]
    links = ["/".join(rng.choices(pieces, k=rng.randrange(1, 5))) for _ in range(300)]
    links += ["/" + x for x in links[:100]] + ["x.pdf?y=1", "?z=1", "#top", "//h/i.pdf", "http://j/k.pdf", ""]
    pairs = [(rng.choice(bases), x) for x in links]
    got = both(spark, html.url_join(F.col("b"), F.col("l")), pairs, "b string, l string")
    wrong = [(p, g, urljoin(*p)) for p, g in zip(pairs, got) if g != urljoin(*p)]
    assert not wrong, wrong[:5]


def test_blank(spark):
    rng = random.Random(15)
    values = ["".join(rng.choices(" \t\n\xa0\N{EM SPACE}\x1fa​", k=rng.randrange(4))) for _ in range(300)]
    got = both(spark, text.is_blank(F.col("t")), [(v,) for v in values], "t string")
    assert got == [not v.strip() for v in values]
