"""Text, date, symbol and score expressions on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsflow.functions import dates, html, scores, symbols, text


def run(spark, make, values, kind="string"):
    """`make(col)` for each value, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


T3, B12 = "\t\t\t", " " * 12


@pytest.mark.parametrize("body, want", [
    ("\n".join(["x", "Related article", "Related article", T3 + "keep", "Related article",
                T3 + "drop", B12 + "ok"]), "keep ok"),
    (B12 + "New York CNN Business - Text", "Text"),
    ("“" + B12 + "a\r\n" + T3 + "b " + B12 + "c”", "a b c"),
    (f"Related article\r\n{T3}gone\r\n{T3}kept", "kept"),
    (f" Related article \n{T3}gone\n{B12}kept ", "kept"),
    (f"{T3}a\nRelated articles\n{T3}b", "a b"),
    (f"{T3}a\n{B12}  \n{T3}b", "a  b"),
    (f"{T3}a\nRelated article", "a"),
    (f"{T3}CNN  - x", "x"),
    (f"{T3}XCNN - x", "XCNN - x"),
    ("plain", ""), ("", ""), (None, None),
])
def test_clean_body(spark, body, want):
    assert run(spark, text.clean_body, [body]) == [want]


def test_scrub_order(spark):
    got = run(spark, text.scrub, ['<a href="http://x">go now', "a <b>c</b> [d] (e)\n f", None, " x "])
    assert got == ['<a href=" now', "a c f", None, " x "]


def test_keyword_and_company(spark):
    assert run(spark, symbols.keyword_ticker, ["Elon Musk", "Alphabet", "ibm", "", None]) == [
        "TSLA", "GOOGL", "IBM", "", None]
    assert run(spark, symbols.company_ticker, ["Netflix", "Other", None]) == ["NVDA", "Other", None]


def test_map_symbol_join_keeps_rows(spark):
    rows = spark.createDataFrame([("Apple",), ("ibm",), (None,), ("",)], "keyword string")
    out = symbols.map_symbol(rows, symbols.keyword_table(spark), "keyword")
    assert {(r.keyword, r.symbol) for r in out.collect()} == {
        ("Apple", "AAPL"), ("ibm", "IBM"), (None, None), ("", "")}


D17, D18 = dt.date(2025, 3, 17), dt.date(2025, 3, 18)


def test_normalize_date(spark):
    forms = ["2025-03-17T23:34:56.123", "1742256000", "2025-03-17", "2025-03-17T23:34:56",
             "1742256000123", "abc", None, "", "٣"]
    assert run(spark, dates.normalize_date, forms) == [D17, D18, D17, None, None, None, None, None, None]
    lenient = run(spark, lambda c: dates.normalize_date(c, lenient=True), ["2025-03-17T23:34:56"])
    assert lenient == [D17]


def test_offset_date(spark):
    forms = ["2025-03-17T23:34:56+0000", "2025-03-17T23:34:56Z", "2025-03-17T23:34:56+00:00", "no", None]
    assert run(spark, dates.parse_offset_date, forms) == [D17, None, None, None, None]
    assert run(spark, lambda c: dates.parse_offset_date(c, True), forms) == [D17, D17, D17, None, None]


def test_other_dates(spark):
    assert run(spark, dates.parse_epoch_date, ["1742256000", "x", "", None]) == [D18, None, None, None]
    assert run(spark, dates.format_date, ["2025-03-17T23:34:56.123", "9999-12-31", "x"]) == [
        "2025-03-17", "9999-12-31", None]
    assert run(spark, dates.parse_index_date, ["March 7, 2025", "3/7/2025", "03/07/2025", "x"]) == [
        dt.date(2025, 3, 7)] * 3 + [None]
    assert run(spark, dates.year_in_name, ["cnn_2024.parquet", "none"]) == [2024, None]


def test_pick_and_combine(spark):
    rows = spark.createDataFrame([("s", "h"), ("   ", "h"), (None, "h"), (None, None)],
                                 "s string, h string")
    got = [r[0] for r in rows.select(text.pick_text(F.col("s"), F.col("h"))).collect()]
    assert got == ["s", "h", "h", ""]
    rows = spark.createDataFrame([("a", ["x", None, "y"]), ("a", None), (None, ["x"])],
                                 "b string, p array<string>")
    got = [r[0] for r in rows.select(text.combine_text(F.col("b"), F.col("p"))).collect()]
    assert got == ["a x y", "a ", "x"]
    got = [r[0] for r in rows.select(text.append_texts(F.col("b"), F.col("p"))).collect()]
    assert got == ["a\nx\ny", "a", "x"]


def test_windows(spark):
    words = lambda c: scores.windows(scores.tokens(c), 3, 2)
    assert run(spark, words, ["a b c d e", " ", None, "a"]) == [
        [["a", "b", "c"], ["c", "d", "e"], ["e"]], [], [], [["a"]]]
    special = lambda c: scores.windows(scores.tokens(c), 3, 2, lead=1, trail=1)
    assert run(spark, special, ["a b c d e"]) == [[["a", "b"], ["b", "c", "d"], ["d", "e"], []]]
    long = lambda c: scores.windows_if_long(scores.tokens(c), 3, 2)
    assert run(spark, long, ["a b c", "a b c d"]) == [[["a", "b", "c"]], [["a", "b", "c"], ["c", "d"]]]


def test_top1_means(spark):
    chunks = [[0.9, 0.05, 0.05], [0.7, 0.1, 0.2], [0.1, 0.1, 0.8]]
    got = run(spark, scores.top1_means, [chunks, []], "array<array<double>>")
    assert got[0].positive == pytest.approx(0.8)
    assert (got[0].neutral, got[0].negative) == (0.0, 0.8)
    assert tuple(got[1]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("negative, neutral, positive, want", [
    (0.36, 0.12, 0.52, "negative"), (0.25, 0.375, 0.375, "negative"), (0.2, 0.4, 0.4, "neutral"),
    (0.1, 0.3, 0.6, "positive"), (None, 0.3, 0.6, None)])
def test_weighted_label(spark, negative, neutral, positive, want):
    row = spark.createDataFrame([(negative, neutral, positive)], "a double, b double, c double")
    assert row.select(scores.weighted_label(F.col("a"), F.col("b"), F.col("c"))).first()[0] == want


def test_softmax_is_stable(spark):
    got = run(spark, scores.softmax, [[1000.0, 1000.0], [0.0, -1e9]], "array<double>")
    assert got == [[0.5, 0.5], [1.0, 0.0]]


@pytest.mark.parametrize("base, link, want", [
    ("http://a.b/c/d?x#y", "e.pdf", "http://a.b/c/e.pdf"),
    ("http://a.b/c/d", "../e.pdf", "http://a.b/e.pdf"),
    ("http://a.b/c/d", "./e.pdf", "http://a.b/c/e.pdf"),
    ("http://a.b/c/d/", "../../../e.pdf", "http://a.b/e.pdf"),
    ("http://a.b", "e.pdf", "http://a.b/e.pdf"),
    ("http://a.b/c", "//z/e.pdf", "http://z/e.pdf"),
    ("http://a.b/c", "https://z/e.pdf", "https://z/e.pdf"),
    ("http://a.b/c", "/e.pdf?q=1", "http://a.b/e.pdf?q=1"),
    ("http://a.b/c?x", "?q=1", "http://a.b/c?q=1"),
])
def test_url_join(spark, base, link, want):
    row = spark.createDataFrame([(base, link)], "b string, l string")
    assert row.select(html.url_join(F.col("b"), F.col("l"))).first()[0] == want


def test_links(spark):
    page = ('<!-- <a href="no.pdf">x</a> --><a class="x" href="A.PDF">1</a><A HREF=\'b.pdf\'>2</A>'
            '<a data-href="c.pdf">3</a><a href=d.pdf>4</a><a href="/x?a=1&amp;b=.pdf">5</a>'
            '<a href="A.PDF">6</a><script>"<a href=\'e.pdf\'>"</script><a title="a>b" href="f.pdf">')
    row = spark.createDataFrame([("http://s/p/q", page)], "u string, h string")
    assert row.select(html.links(F.col("u"), F.col("h"))).first()[0] == [
        "http://s/p/A.PDF", "http://s/p/b.pdf", "http://s/p/d.pdf", "http://s/x?a=1&b=.pdf",
        "http://s/p/f.pdf"]
