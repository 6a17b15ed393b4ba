"""Readers, writers, merge, index and pages on small files."""

import datetime as dt
import html
import json
import random
from html.entities import html5
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newsflow.functions.dates import iso_millis
from newsflow.functions.html import unescape as unescape_text
from newsflow.operators import api, filters, index, news, pages
from newsflow.schema import NEWS, NEWS_MONTHS, RAW_ARTICLES
from newsflow.session import scratch_path, shared_dir
from newsflow.sources import readers, writers
from tests import page_parser


def stories(spark, rows):
    return spark.createDataFrame([(*r, f"s{i}") for i, r in enumerate(rows)],
                                 "symbol string, source string, datetime string, headline string, summary string")


def test_month_rewrite_keeps_both_days_and_other_months(spark):
    path = scratch_path(spark, "t")
    first = news.with_months(stories(spark, [("A", "x", "2025-01-05", "h"), ("A", "x", "2025-02-05", "h")]))
    writers.write_months(first, path)
    second = news.with_months(stories(spark, [("A", "x", "2025-02-06", "a"), ("A", "x", "2025-02-07", "b")]))
    writers.write_months(second, path)
    got = writers.read_months(spark, path).select("datetime", "year", "month").collect()
    assert sorted(map(tuple, got)) == [("2025-01-05", 2025, 1), ("2025-02-06", 2025, 2), ("2025-02-07", 2025, 2)]


def test_undated_rows_are_quarantined(spark):
    dated = news.with_months(stories(spark, [("A", "x", None, "h"), ("A", "x", "2025-02-05", "h"), ("A", "x", "?", "h")]))
    kept, undated = filters.split_undated(dated)
    assert kept.count() == 1 and undated.count() == 2


def test_dedup_is_null_safe_and_stable(spark):
    rows = stories(spark, [("A", "y", None, "h"), ("A", "x", None, "h"), (None, "z", "d", None),
                           (None, "z", "d", None), ("B", "x", "d", "h")])
    got = news.dedup_news(rows)
    assert sorted((r.source, r.summary) for r in got.collect()) == [("x", "s1"), ("x", "s4"), ("z", "s2")]


def test_wire_duplicates_go_before_the_scrub(spark):
    rows = stories(spark, [("A", "x", "1742256000", "h http://a"), ("A", "x", "1742256000", "h http://b"),
                           ("A", "x", "1742256000", "h http://b"), ("A", "x", "1742256001", "h http://b")])
    got = news.conform_wire(rows)
    assert [tuple(r) for r in got.select("datetime", "headline").collect()] == [("2025-03-18", "h ")] * 3


def test_csv_keeps_every_character(spark):
    rows = stories(spark, [("A", 'say "hi", now', " lead", "a\nb"), ("B", "", None, "back\\slash"),
                           ("C", "‘ü’", "trail ", '"')])
    path = writers.write_csv(rows, scratch_path(spark, "t"))
    got = readers.read_csv(spark, path, NEWS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_price_json_by_file_name(spark, tmp_path):
    doc = {"Date": {"0": 1741651200000, "1": "2025-03-12"}, "('Close', 'AAPL')": {"0": 1.5, "1": 2.5},
           "('Volume', 'AAPL')": {"0": 10, "1": None}, "('Open', 'AAPL')": {"0": 1, "1": 2}}
    (tmp_path / "AAPL_stock_data.json").write_text(json.dumps(doc))
    got = readers.read_price_json(spark, str(tmp_path)).orderBy("date").collect()
    assert [(r.symbol, r.date, r.open, r.high, r.close, r.volume) for r in got] == [
        ("AAPL", dt.date(2025, 3, 11), 1.0, None, 1.5, 10), ("AAPL", dt.date(2025, 3, 12), 2.0, None, 2.5, None)]


def article(spark, name):
    return spark.createDataFrame([("k", "2024-01-01", name, "c", "l")], RAW_ARTICLES)


def titles(df):
    return sorted(r.title for r in df.collect())


def test_file_choice(spark):
    path = scratch_path(spark, "t")
    for name in ("2020/a", "2024/b", "2025/nyt_2025_01", "2025/nyt_2025_02", "2025/nyt_2025_03", "2019/z"):
        article(spark, name).write.parquet(f"{path}/{name}")
    assert titles(readers.read_history(spark, path, RAW_ARTICLES, range(2020, 2025), 2025,
                                       ("2025_01", "2025_02"))) == [
        "2020/a", "2024/b", "2025/nyt_2025_01", "2025/nyt_2025_02"]
    assert titles(readers.read_years(spark, path, [2018, 2019, 2020], RAW_ARTICLES, "*/*.parquet")) == [
        "2019/z", "2020/a"]


def test_years_above_the_path_do_not_count(spark):
    path = f"{scratch_path(spark, 't')}/2020/archive"
    for name in ("2019/a", "2020/b"):
        article(spark, name).write.parquet(f"{path}/{name}")
    for root in (path, f"file:{path}/"):
        assert titles(readers.read_history(spark, root, RAW_ARTICLES, [2020], 2025, ["x"])) == ["2020/b"]


def test_unreadable_files_are_named(spark):
    path = scratch_path(spark, "t")
    for name in ("2019", "2020"):
        article(spark, name).coalesce(1).write.parquet(f"{path}/{name}")
    cut = next(Path(f"{path}/2020").glob("*.parquet"))
    cut.write_bytes(cut.read_bytes()[:100])
    for crc in Path(f"{path}/2020").glob(".*.crc"):
        crc.unlink()
    years = [2018, 2019, 2020]
    assert titles(readers.read_years(spark, path, years, RAW_ARTICLES)) == ["2019"]
    (bad,) = readers.unread_files(spark, path, years, RAW_ARTICLES).collect()
    assert bad.path == str(cut) and bad.length == 100


def test_bad_csv_rows_are_kept_raw(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,x\ntwo,"y ""z"""\n3,w\n')
    schema = spark.createDataFrame([(1, "x")], "a int, b string").schema
    rows = readers.read_csv(spark, str(tmp_path), schema, "raw").collect()
    assert sorted((r.a or 0, r.b, r.raw) for r in rows) == [
        (0, 'y "z"', 'two,"y ""z"""'), (1, "x", None), (3, "w", None)]
    assert readers.read_csv(spark, str(tmp_path), schema).count() == 3


def test_increment_by_file_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    for day in ("2025_03_17", "2025_03_18"):
        rows = {f: [day] for f in RAW_ARTICLES.names}
        pq.write_table(pa.table(rows), tmp_path / f"nyt_articles_{day}.parquet")
    got = readers.read_increment(spark, str(tmp_path), "2025_03_18", RAW_ARTICLES)
    assert titles(got) == ["2025_03_18"]
    both = spark.read.schema(RAW_ARTICLES).parquet(str(tmp_path))
    assert readers.with_file_year(both).select("year").distinct().collect()[0].year == 2025


def test_empty_and_missing_inputs_fail(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([], NEWS).write.parquet(path)
    with pytest.raises(FileNotFoundError):
        readers.read_parquet(spark, path)
    assert readers.read_parquet(spark, path, schema=NEWS, allow_empty=True).isEmpty()
    with pytest.raises(AnalysisException):
        readers.read_parquet(spark, path + "/none")
    with pytest.raises(ValueError):
        news.union_feeds([])


def test_landing_drops_sentinels_and_splits_years(spark):
    rows = spark.createDataFrame([("b", "2024-05-01"), ("a", "9999-12-31"), ("a", "2023-01-01")],
                                 "keyword string, date string")
    rows = rows.unionByName(spark.createDataFrame([("c", None), ("d", "soon")], rows.schema))
    bad = scratch_path(spark, "t")
    path = writers.land_by_year(rows, scratch_path(spark, "t"), bad)
    assert {(r.keyword, r.date) for r in spark.read.parquet(bad).collect()} == {("c", None), ("d", "soon")}
    assert {(r.keyword, r.year) for r in spark.read.parquet(path).collect()} == {("b", 2024), ("a", 2023)}


def test_sql_table(spark):
    path = scratch_path(spark, "t")
    writers.write_months(news.with_months(stories(spark, [("A", "x", "2025-01-05", "h")])), path)
    writers.register_table(spark, "t_news", path)
    assert spark.sql("SELECT symbol FROM t_news WHERE year = 2025 AND month = 1").first().symbol == "A"


def test_catalog_table(spark):
    path = scratch_path(spark, "t")
    for day, count in (("2025-01-05", 1), ("2025-02-05", 2)):
        writers.write_months(news.with_months(stories(spark, [("A", "x", day, "h")])), path)
        writers.create_table(spark, "months_t", path)
        assert spark.table("months_t").count() == count
    plan = spark.sql("SELECT symbol FROM months_t WHERE month = 2")
    assert plan.count() == 1 and "PartitionFilters: [isnotnull(month" in plan._jdf.queryExecution().toString()
    spark.sql("DROP TABLE months_t")


def test_month_read_is_pruned(spark):
    path = scratch_path(spark, "t")
    writers.write_months(news.with_months(stories(spark, [("A", "x", "2025-01-05", "h")])), path)
    plan = writers.read_months(spark, path, [(2025, 1)])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "year#" in plan.split("PartitionFilters: [")[1].split("]")[0]


# Index ------------------------------------------------------------------------------------------

def test_upsert_index(spark):
    old = spark.createDataFrame([("d", "t", None, "old", 0), ("d", "t", None, "old2", 1)],
                                "date string, title string, category string, link string, n int")
    new = spark.createDataFrame([("d", "t", None, "new", 0), ("d", "u", "c", "first", 1), ("d", "u", "c", "second", 2)],
                                old.schema)
    got = index.upsert_index(old, new, index.PRESS_KEYS, ["n"])
    assert sorted((r.link, r.is_new) for r in got.collect()) == [("first", True), ("old", False)]


def test_frontier_and_fan_out(spark):
    links = spark.createDataFrame([("a",), ("b",), (None,)], "link string")
    done = spark.createDataFrame([("a",), ("a",), (None,)], "link string")
    assert {r.link for r in index.frontier(links, done).collect()} == {"b", None}
    grid = index.fan_out(links.limit(2), "2025-01-30", "2025-02-02")
    assert grid.count() == 8


# API replies ------------------------------------------------------------------------------------

def test_flatten_docs(spark):
    docs = [{"headline": {"main": "h"}, "pub_date": "p", "lead_paragraph": "", "snippet": "s", "web_url": "w"},
            {"headline": {}, "lead_paragraph": "l", "news_desk": "Business"}]
    rows = spark.createDataFrame([(json.dumps({"response": {"docs": docs}}), "Apple"), ("{}", "Tesla")],
                                 "reply string, stock string")
    got = [tuple(r) for r in api.flatten_docs(rows, "reply", "stock").collect()]
    assert got == [("h", "p", "s", "w", "N/A", "Apple"), ("", "", "l", "", "Business", "Apple")]


def test_flatten_items(spark):
    rows = spark.createDataFrame([('[{"datetime": 12, "headline": "h", "extra": 1}, {"source": "s"}]', "A"), ("[]", "B")],
                                 "reply string, symbol string")
    got = [tuple(r) for r in api.flatten_items(rows, "reply", "symbol").collect()]
    assert got == [("A", "", "12", "h", ""), ("A", "s", "", "", "")]


# Pages ------------------------------------------------------------------------------------------

ARTICLE = """<html><head><meta property="article:published_time" content="2025-03-17T23:34:56.123Z"/>
<script>var x = "<h1>no</h1>"</script></head><body><h1> A &amp; <b>B</b> </h1><h1>second</h1>
<div class="wide article__content"><div>one</div><!-- no --><style>p{}</style> two</div><div>three</div>"""


PARTS = ["<h1>", "</h1>", "<p>", "</p>", "<P class='x>y'>", "<p/>", "<b>", "</b>", "<br/>", "</div>", "</DIV >",
         '<div class="article__content">', "<div class='wide article__content'>", "<div>", '<div title="a=b" class=c>',
         '<div class="heading col-xs-12 col-sm-8 col-md-8">', '<div class="col-xs-12 col-sm-8 col-md-8">',
         '<p class="article__time">', "<h3 class='big title'>", '<p class="releaseTime">', "</h3>", "text", " a < b ",
         "&amp;", "&lt;p&gt;", "&notit;", "&#233;", "&#x20AC;", "&#128;", "&nope;", "&", "\n", "\xa0", "<!-- <p> -->",
         "<script>var x = '</p><h1>';</script>", "<style>p{}</style>", "<!DOCTYPE html>",
         '<meta property="article:published_time" content="2025-03-17T23:34:56.123Z">',
         "<meta property='article:published_time' content='soon'/>", "it's", '"']


def read_pages(spark, pages_, fields):
    rows = spark.createDataFrame(list(enumerate(pages_)), "id long, html string")
    return [tuple(r)[1:] for r in fields(rows, "html").orderBy("id").collect()]


def test_article_pages(spark):
    meta = '<meta property="article:published_time" content="soon">'
    got = read_pages(spark, [ARTICLE, "<p>x", None, meta], pages.extract_articles)
    assert got == [("A & B", "one two", "2025-03-17T23:34:56.123"), *[("No title", "No content", "9999-12-31")] * 3]


def test_pages_are_read_as_by_a_parser(spark):
    rng = random.Random(4)
    some = ["".join(rng.choices(PARTS, k=rng.randrange(40))) for _ in range(1500)] + ["<h1>a", "<div class='x", "", None]
    for fields, plain in ((pages.extract_articles, page_parser.article_of), (pages.extract_releases, page_parser.release_of)):
        for page, got in zip(some, read_pages(spark, some, fields), strict=True):
            assert got == plain(page), page


def test_character_references(spark):
    rng = random.Random(5)
    names = rng.sample(sorted(html5), 300)
    texts = [f"a&{n}b &{n[:-1]} &{n}" for n in names] + [f"&#{n};&#x{n:x};&#{n}" for n in (
        0, 1, 9, 11, 13, 38, 127, 128, 129, 150, 159, 160, 8364, 55296, 64976, 65534, 128512, 1114111, 1114112, 10 ** 9)]
    texts += ["&#;", "&#x;", "&#xg", "&;", "&&amp;amp;", "& amp;", "&ampamp;", "&NotEqualTilde;", "&a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(unescape_text(F.col("t")).alias("u"))
    assert [r.u for r in df.collect()] == [html.unescape(t) for t in texts]


def test_iso_times(spark):
    texts = ["2025-03-17", "2025-03-17T23:34:56.123Z", "2025-03-17 23:34", "20250317T233456", "2025-03-17T23:34:56.1+02:00",
             "2025-03-17T23:34:56.1234567", "2025-02-30", "2025-03-17T25:00", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(iso_millis(F.col("t")).alias("u"))
    assert [r.u or "9999-12-31" for r in df.collect()] == [page_parser._iso_millis(t) for t in texts]


def test_release_page(spark):
    page = """<p class="article__time">not in the heading</p>
    <div class="heading col-xs-12 col-sm-8 col-md-8"><p class="article__time"> March 7, 2025 </p>
    <h3 class="title">T <em>x</em></h3><p class="releaseTime">For release at 2 p.m.</p></div>
    <div class="col-xs-12 col-sm-8 col-md-8"><p>one <b> two</b></p><p>three<div>x</div></div><p>out</p>"""
    rows = spark.createDataFrame([("u", page), ("v", None)], "url string, html string")
    got = {r.url: r for r in pages.extract_releases(rows, "html").collect()}
    assert (got["u"].date, got["u"].title, got["u"].release_time) == (
        "March 7, 2025", "Tx", "For release at 2 p.m.")
    assert got["u"].content == "onetwo\nthreex"
    assert (got["v"].date, got["v"].content) == (None, "")


def test_links_are_distinct_rows(spark):
    rows = spark.createDataFrame([("http://s/a", '<a href="x.pdf"></a><a href="x.pdf"></a><a href="y.htm"></a>')],
                                 "url string, html string")
    assert [r.link for r in pages.extract_links(rows, "url", "html").collect()] == ["http://s/x.pdf"]


def test_local_folder_is_for_one_process_only():
    class Session:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    for master in ("yarn", "local-cluster[3,2,1024]", "spark://h:7077"):
        with pytest.raises(ValueError):
            shared_dir(Session(master))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_schema_of_months():
    assert NEWS_MONTHS.names[-2:] == ["year", "month"]
