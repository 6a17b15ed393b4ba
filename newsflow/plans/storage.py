"""Queries of the sources and sinks: each writes to the shared folder and reads its files back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators import news
from newsflow.operators.api import flatten_docs, flatten_items
from newsflow.plans.cleansing import FEED_VIEWS, SQL_MERGED, merged_news
from newsflow.plans.registry import query
from newsflow.plans.views import table, view
from newsflow.schema import PRESS_CONTENTS, RAW_ARTICLES
from newsflow.session import scratch_path
from newsflow.sources import readers, writers

_CANONICAL = "symbol, source, datetime, headline, summary"
_ARTICLES = RAW_ARTICLES.names


@query("scan_parquet", "SELECT doc_id, lang, source, n_chars FROM documents")
def scan_parquet(spark, d) -> DataFrame:
    return readers.read_parquet(spark, f"{d}/documents.parquet").select(
        "doc_id", "lang", "source", "n_chars")


@query("scan_multi_path", f"SELECT {', '.join(_ARTICLES)} FROM articles_v", "articles_v")
def scan_multi_path(spark, d) -> DataFrame:
    articles = view(spark, d, "articles_v")
    path = scratch_path(spark, "multi")
    even = F.col("doc_id") % 2 == 0
    writers.write_staging(articles.filter(even).select(*_ARTICLES), f"{path}/2024/archive")
    writers.write_staging(articles.filter(~even).select(*_ARTICLES), f"{path}/2025/recent")
    return readers.read_parquet(spark, f"{path}/2024/*", f"{path}/2025/*", schema=RAW_ARTICLES)


@query("scan_file_filter", f"""
SELECT {', '.join(_ARTICLES)} FROM articles_v
WHERE substr(date, 1, 4) IN ('2020', '2021') OR substr(date, 1, 7) IN ('2022-01', '2022-02')""",
       "articles_v")
def scan_file_filter(spark, d) -> DataFrame:
    path = scratch_path(spark, "history")
    month = F.translate(F.substring("date", 1, 7), "-", "_")
    articles = view(spark, d, "articles_v").select(
        *_ARTICLES, F.substring("date", 1, 4).alias("year"),
        F.concat(F.lit("articles_"), month).alias("file"))
    articles.write.partitionBy("year", "file").parquet(path)
    return readers.read_history(spark, path, RAW_ARTICLES, (2020, 2021), 2022, ("2022_01", "2022_02"))


@query("scan_year_union", f"""
SELECT {', '.join(_ARTICLES)} FROM articles_v WHERE substr(date, 1, 4) IN ('2020', '2022')""",
       "articles_v")
def scan_year_union(spark, d) -> DataFrame:
    path = scratch_path(spark, "years")
    articles = view(spark, d, "articles_v").select(*_ARTICLES, F.substring("date", 1, 4).alias("year"))
    articles.write.partitionBy("year").parquet(path)
    # there is no 2019
    return readers.read_years(spark, path, (2019, 2020, 2022), RAW_ARTICLES, folder="year=")


def _stored_news(spark, d) -> DataFrame:
    return view(spark, d, "news_v").select("doc_id", "source", "datetime", "headline", "summary")


_STORED = "SELECT doc_id, source, datetime, headline, summary FROM news_v"


@query("scan_csv", _STORED, "news_v")
def scan_csv(spark, d) -> DataFrame:
    stored = _stored_news(spark, d)
    path = writers.write_csv(stored, scratch_path(spark, "csv"))
    return readers.read_csv(spark, path, stored.schema)


# A file that tasks read in parts, with every thirtieth line cut short after its number: these go to the quarantine.
@query("scan_csv_bad_rows", f"""
SELECT doc_id, source, datetime, headline, summary, CAST(NULL AS VARCHAR) AS bad_row FROM news_v WHERE doc_id % 30 <> 7
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CAST(doc_id AS VARCHAR) || 'x,cut' FROM news_v WHERE doc_id % 30 = 7""",
       "news_v")
def scan_csv_bad_rows(spark, d) -> DataFrame:
    stored, path, n = _stored_news(spark, d), scratch_path(spark, "csv"), F.col("doc_id")
    writers.write_csv(stored.filter(n % 30 != 7), f"{path}/rows", flat=True)
    (stored.filter(n % 30 == 7).select(F.concat(n, F.lit("x,cut")).alias("value"))
     .write.mode("append").option("header", True).option("sep", "\x01").csv(f"{path}/rows"))
    good = readers.load_csv(spark, f"{path}/rows", stored.schema, f"{path}/bad", flat=True)
    bad = spark.read.text(f"{path}/bad").withColumnRenamed("value", "bad_row")
    return good.withColumn("bad_row", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@query("sink_csv_roundtrip", """
SELECT event_id, symbol, date, finbert_positive, finbert_negative FROM senti_v""", "senti_v")
def sink_csv_roundtrip(spark, d) -> DataFrame:
    scored = view(spark, d, "senti_v")
    path = writers.write_csv(scored, scratch_path(spark, "csv"))
    return readers.read_csv(spark, path, scored.schema)


@query("scan_json", """
SELECT url, html AS content, page_id FROM
  (SELECT 'https://pages.example/' || CAST(page_id AS VARCHAR) AS url, html, page_id FROM pages)""")
def scan_json(spark, d) -> DataFrame:
    pages = table(spark, d, "pages").select(
        "page_id", F.concat(F.lit("https://pages.example/"), "page_id").alias("url"),
        F.col("html").alias("content"))
    path = scratch_path(spark, "json")
    # a crawl batch is an array of at most 50 pages
    batch = pages.groupBy(F.floor(F.col("page_id") / 50).alias("batch")).agg(
        F.to_json(F.collect_list(F.struct("page_id", "url", "content"))).alias("value"))
    # a file holds many batches, an array on each line
    batch.select("value").write.text(path)
    return readers.read_json(spark, f"{path}/part-*", pages.schema, multi_line=False)


@query("sink_json_roundtrip", _STORED, "news_v")
def sink_json_roundtrip(spark, d) -> DataFrame:
    stored = _stored_news(spark, d)
    path = writers.write_json(stored, scratch_path(spark, "json"))
    return readers.read_json(spark, path, stored.schema, multi_line=False)


@query("price_json_unpivot", "SELECT symbol, date, open, high, low, close, volume FROM prices_v",
       "prices_v")
def price_json_unpivot(spark, d) -> DataFrame:
    path = writers.write_price_json(view(spark, d, "prices_v"), scratch_path(spark, "prices"))
    return readers.read_price_json(spark, path)


@query("sink_staging", f"{SQL_MERGED} SELECT {_CANONICAL}, feed FROM analytic", FEED_VIEWS)
def sink_staging(spark, d) -> DataFrame:
    merged = merged_news(spark, d).select("symbol", "source", "datetime", "headline", "summary", "feed")
    path = writers.write_feeds(merged, scratch_path(spark, "staging"))
    return readers.read_parquet(spark, path, schema=merged.schema)


_MONTHS = f"""{SQL_MERGED}
SELECT {_CANONICAL}, CAST(year(record_date) AS INTEGER) AS year,
  CAST(month(record_date) AS INTEGER) AS month FROM analytic"""


@query("sink_month_partitions", _MONTHS, FEED_VIEWS)
def sink_month_partitions(spark, d) -> DataFrame:
    path = writers.write_months(merged_news(spark, d), scratch_path(spark, "months"))
    return writers.read_months(spark, path)


@query("read_partition", f"{_MONTHS} WHERE year(record_date) = 2025 AND month(record_date) IN (1, 2)",
       FEED_VIEWS)
def read_partition(spark, d) -> DataFrame:
    path = writers.write_months(merged_news(spark, d), scratch_path(spark, "months"))
    return writers.read_months(spark, path, [(2025, 1), (2025, 2)])


@query("land_by_year", f"""
SELECT {', '.join(_ARTICLES[:1])}, date, {', '.join(_ARTICLES[2:])},
  CAST(substr(date, 1, 4) AS INTEGER) AS year FROM
  (SELECT *, CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN 'none' ELSE date END AS d
   FROM articles_v) x, LATERAL (SELECT x.d AS given) WHERE coalesce(given, '') NOT LIKE '9999%'
  AND given IS NOT NULL AND given <> 'none'
UNION ALL SELECT {', '.join(_ARTICLES[:1])}, CASE WHEN doc_id % 29 = 0 THEN NULL ELSE 'none' END,
  {', '.join(_ARTICLES[2:])}, CAST(NULL AS INTEGER) FROM articles_v WHERE doc_id % 29 = 0 OR doc_id % 31 = 0""",
       "articles_v")
def land_by_year(spark, d) -> DataFrame:
    # some dates are missing and some are none: these rows are in the quarantine, the others in their year
    n, path = F.col("doc_id"), scratch_path(spark, "landed")
    date = F.when(n % 29 == 0, F.lit(None)).when(n % 31 == 0, F.lit("none")).otherwise(F.col("date"))
    articles = view(spark, d, "articles_v").withColumn("date", date).select(*_ARTICLES)
    writers.land_by_year(articles, f"{path}/years", f"{path}/bad")
    bad = spark.read.schema(RAW_ARTICLES).parquet(f"{path}/bad").withColumn("year", F.lit(None).cast("int"))
    return spark.read.parquet(f"{path}/years").select(*_ARTICLES, "year").unionByName(bad)


@query("sink_multi_format", f"""
SELECT doc_id, source, datetime, headline, summary, kind FROM news_v,
  (SELECT unnest(['csv', 'json', 'parquet']) AS kind)""", "news_v")
def sink_multi_format(spark, d) -> DataFrame:
    stored = _stored_news(spark, d)
    paths = writers.write_formats(stored, scratch_path(spark, "formats"))
    read = {
        "parquet": readers.read_parquet(spark, paths["parquet"], schema=stored.schema),
        "csv": readers.read_csv(spark, paths["csv"], stored.schema),
        "json": readers.read_json(spark, paths["json"], stored.schema, multi_line=False),
    }
    return news.union_feeds([df.withColumn("kind", F.lit(kind)) for kind, df in read.items()])


@query("sql_view", f"""{SQL_MERGED}
SELECT symbol, CAST(month(record_date) AS INTEGER) AS month, count(*) AS stories,
  count(DISTINCT source) AS sources
FROM analytic WHERE year(record_date) = 2025 GROUP BY 1, 2""", FEED_VIEWS)
def sql_view(spark, d) -> DataFrame:
    path = writers.write_months(merged_news(spark, d), scratch_path(spark, "months"))
    writers.register_table(spark, "analytic_news", path)
    return spark.sql("""
        SELECT symbol, month, count(*) AS stories, count(DISTINCT source) AS sources
        FROM analytic_news WHERE year = 2025 GROUP BY symbol, month""")


# A catalog table over day folders; a join with some months of a calendar reads the folders of these only.
@query("sql_catalog_table", f"""{SQL_MERGED}
SELECT symbol, feed, CAST(year(record_date) AS INTEGER) AS year, CAST(month(record_date) AS INTEGER) AS month,
  count(*) AS stories
FROM analytic WHERE month(record_date) <= 3 AND year(record_date) IS NOT NULL GROUP BY ALL""", FEED_VIEWS)
def sql_catalog_table(spark, d) -> DataFrame:
    path = scratch_path(spark, "catalog")
    rows = merged_news(spark, d).filter("year IS NOT NULL").withColumn("day", F.lit("full"))
    writers.write_days(rows, f"{path}/news")
    calendar = rows.select("year", "month").distinct().withColumn("quarter", F.ceil(F.col("month") / 3))
    calendar.write.parquet(f"{path}/calendar")
    name = f"news_{path[-32:]}"
    writers.create_table(spark, name, f"{path}/news", days=True)
    spark.read.parquet(f"{path}/calendar").createOrReplaceTempView(f"{name}_calendar")
    return spark.sql(f"""
        SELECT symbol, feed, n.year, n.month, count(*) AS stories FROM {name} n
        JOIN {name}_calendar c ON n.year = c.year AND n.month = c.month
        WHERE c.quarter = 1 GROUP BY symbol, feed, n.year, n.month""")


# API replies -----------------------------------------------------------------------------------

@query("flatten_api_docs", """
SELECT concat('Headline ', CAST(doc_id AS VARCHAR)) AS headline, pub_date,
  CASE WHEN doc_id % 5 = 0 THEN concat('snippet ', CAST(doc_id AS VARCHAR))
    WHEN doc_id % 7 = 0 THEN '' ELSE content END AS content,
  web_url, coalesce(news_desk, 'N/A') AS news_desk, stock FROM archive_v""", "archive_v")
def flatten_api_docs(spark, d) -> DataFrame:
    n = F.col("doc_id")
    article = F.struct(
        F.struct(F.col("headline").alias("main")).alias("headline"), "pub_date",
        F.when(n % 5 == 0, F.lit("")).when(n % 7 != 0, F.col("content")).alias("lead_paragraph"),
        F.when(n % 5 == 0, F.concat(F.lit("snippet "), n)).alias("snippet"), "web_url", "news_desk")
    # one reply per stock and ten articles, as the pages of the API
    page = F.floor(n / 80).alias("page")
    docs = F.collect_list(article).alias("docs")
    reply = F.to_json(F.struct(F.struct("docs").alias("response"))).alias("reply")
    replies = view(spark, d, "archive_v").groupBy("stock", page).agg(docs).select("stock", reply)
    return flatten_docs(replies, "reply", "stock")


@query("flatten_api_lists", """
SELECT symbol, source, CASE WHEN datetime = '' THEN '' ELSE datetime END AS datetime, headline,
  coalesce(summary, '') AS summary FROM wire_v""", "wire_v")
def flatten_api_lists(spark, d) -> DataFrame:
    item = F.struct("source", F.col("datetime").try_cast("bigint").alias("datetime"),
                    "headline", "summary")
    page = F.floor(F.col("doc_id") / 70).alias("page")
    replies = (view(spark, d, "wire_v").groupBy("symbol", page)
               .agg(F.to_json(F.collect_list(item)).alias("reply")))
    return flatten_items(replies, "reply", "symbol")


@query("scan_contents", """
SELECT url, content, concat_ws(' ', content, CASE WHEN page_id % 2 = 0 THEN html ELSE '' END)
  AS combined_text FROM (SELECT page_id, url, concat('Page ', CAST(page_id AS VARCHAR)) AS content,
  html FROM pages)""")
def scan_contents(spark, d) -> DataFrame:
    from newsflow.functions.text import combine_text

    n = F.col("page_id")
    stored = table(spark, d, "pages").select(
        "url", F.concat(F.lit("Page "), n).alias("content"),
        F.when(n % 2 == 0, F.array(F.lit(None).cast("string"), "html")).alias("pdf_texts"))
    path = writers.write_json(stored, scratch_path(spark, "contents"))
    contents = readers.read_json(spark, path, PRESS_CONTENTS, multi_line=False)
    return contents.select("url", "content", combine_text(
        F.col("content"), F.col("pdf_texts")).alias("combined_text"))
