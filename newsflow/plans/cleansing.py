"""Queries of the cleansing layer: text, dates, symbols, filters, duplicates and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates, scores, symbols, text
from newsflow.operators import filters, news
from newsflow.operators.scoring import expand_struct
from newsflow.plans.registry import query
from newsflow.plans.views import table, view
from newsflow.schema import date_column
from newsflow.sources.readers import with_file_year

_QUOTED = "“”\""


def sql_scrub(c: str) -> str:
    for pattern, to in ((r"http[s]?://\S+", ""), ("<.*?>", ""),
                        (r"\[.*?\]|\(.*?\)", ""), (r"\s+", " ")):
        c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
    return c


def sql_epoch(c: str) -> str:
    return f"(date '1970-01-01' + CAST(TRY_CAST({c} AS BIGINT) // 86400 AS INTEGER))"


def sql_day(c: str) -> str:
    return (f"CASE WHEN length({c}) > 10 THEN CAST(try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%g') AS DATE)"
            f" WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({sql_epoch(c)} AS DATE)"
            f" ELSE CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END")


def sql_keyword(c: str) -> str:
    return f"""CASE lower({c}) WHEN 'apple' THEN 'AAPL' WHEN 'google' THEN 'GOOGL' WHEN 'alphabet' THEN 'GOOGL'
  WHEN 'facebook' THEN 'META' WHEN 'meta' THEN 'META' WHEN 'microsoft' THEN 'MSFT' WHEN 'amazon' THEN 'AMZN'
  WHEN 'tesla' THEN 'TSLA' WHEN 'elon musk' THEN 'TSLA' WHEN 'nvidia' THEN 'NVDA' ELSE upper({c}) END"""


def sql_company(c: str) -> str:
    return f"""CASE {c} WHEN 'Apple' THEN 'AAPL' WHEN 'Amazon' THEN 'AMZN' WHEN 'Google' THEN 'GOOGL'
  WHEN 'Microsoft' THEN 'MSFT' WHEN 'Facebook' THEN 'META' WHEN 'Tesla' THEN 'TSLA' WHEN 'Netflix' THEN 'NVDA'
  ELSE {c} END"""


SQL_OFFSET = (r"CASE WHEN regexp_matches(pub_date, '[0-9][+-][0-9]{4}$')"
              " THEN TRY_CAST(substr(pub_date, 1, 10) AS DATE) END")

# Lines of the article bodies. A line is dropped when the run of marker lines right before it is
# odd: the last of them then was no "line after" itself.
SQL_BODY = rf"""
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
  FROM (SELECT doc_id, string_split(trim(content, '{_QUOTED}'), chr(10)) AS parts FROM articles_v)),
marked AS (SELECT *, trim(line) = 'Related article' AS mark FROM lines),
runs AS (SELECT *, n - 1 - coalesce(max(CASE WHEN NOT mark THEN n END) OVER (
    PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
  FROM marked),
bodies AS (SELECT doc_id, string_agg(trim(line, concat(' ', chr(9))), ' ' ORDER BY n) AS body FROM runs
  WHERE NOT mark AND run % 2 = 0
    AND (starts_with(line, repeat(chr(9), 3)) OR starts_with(line, repeat(' ', 12)))
  GROUP BY doc_id),
cleaned AS (SELECT a.*, regexp_replace(coalesce(body, ''),
    '^(?:[A-Za-z\s]+)?\bCNN(?: Business)?\s*-\s*', '') AS summary
  FROM articles_v a LEFT JOIN bodies USING (doc_id))"""


@query("map_symbol_case", f"SELECT doc_id, stock, {sql_company('stock')} AS symbol FROM archive_v",
       "archive_v")
def map_symbol_case(spark, d) -> DataFrame:
    return view(spark, d, "archive_v").select(
        "doc_id", "stock", symbols.company_ticker(F.col("stock")).alias("symbol"))


@query("map_symbol_keyword",
       f"SELECT doc_id, keyword, {sql_keyword('keyword')} AS symbol FROM articles_v", "articles_v")
def map_symbol_keyword(spark, d) -> DataFrame:
    return view(spark, d, "articles_v").select(
        "doc_id", "keyword", symbols.keyword_ticker(F.col("keyword")).alias("symbol"))


@query("map_symbol_join",
       f"SELECT doc_id, keyword, {sql_keyword('keyword')} AS symbol FROM articles_v", "articles_v")
def map_symbol_join(spark, d) -> DataFrame:
    return symbols.map_symbol(view(spark, d, "articles_v").select("doc_id", "keyword"),
                              symbols.keyword_table(spark), "keyword")


@query("clean_article_body", f"WITH {SQL_BODY.strip()} SELECT doc_id, summary FROM cleaned",
       "articles_v")
def clean_article_body(spark, d) -> DataFrame:
    return view(spark, d, "articles_v").select(
        "doc_id", text.clean_body(F.col("content")).alias("summary"))


@query("scrub_text",
       f"SELECT doc_id, {sql_scrub('headline')} AS headline, {sql_scrub('summary')} AS summary"
       " FROM news_v", "news_v")
def scrub_text(spark, d) -> DataFrame:
    return view(spark, d, "news_v").select(
        "doc_id", text.scrub(F.col("headline")).alias("headline"),
        text.scrub(F.col("summary")).alias("summary"))


@query("parse_offset_date",
       f"SELECT doc_id, pub_date, {SQL_OFFSET} AS strict_date,"
       " TRY_CAST(substr(pub_date, 1, 10) AS DATE) AS lenient_date FROM archive_v", "archive_v")
def parse_offset_date(spark, d) -> DataFrame:
    return view(spark, d, "archive_v").select(
        "doc_id", "pub_date", dates.parse_offset_date(F.col("pub_date")).alias("strict_date"),
        dates.parse_offset_date(F.col("pub_date"), lenient=True).alias("lenient_date"))


@query("parse_epoch_date",
       f"SELECT doc_id, datetime, CAST(CAST({sql_epoch('datetime')} AS DATE) AS VARCHAR) AS day"
       " FROM wire_v", "wire_v")
def parse_epoch_date(spark, d) -> DataFrame:
    return view(spark, d, "wire_v").select(
        "doc_id", "datetime", dates.parse_epoch_date(F.col("datetime")).cast("string").alias("day"))


@query("format_date", "SELECT doc_id, date, substr(date, 1, 10) AS day FROM articles_v",
       "articles_v")
def format_date(spark, d) -> DataFrame:
    return view(spark, d, "articles_v").select(
        "doc_id", "date", dates.format_date(F.col("date")).alias("day"))


@query("normalize_date",
       f"SELECT doc_id, datetime, {sql_day('datetime')} AS record_date FROM news_v", "news_v")
def normalize_date(spark, d) -> DataFrame:
    return view(spark, d, "news_v").select(
        "doc_id", "datetime", dates.normalize_date(F.col("datetime")).alias("record_date"))


SQL_MONTHS = f"""
SELECT doc_id, keyword, source, datetime, headline, summary, record_date,
  CAST(year(record_date) AS INTEGER) AS year, CAST(month(record_date) AS INTEGER) AS month
FROM (SELECT *, {sql_day('datetime')} AS record_date FROM news_v)"""


@query("year_month", f"SELECT doc_id, record_date, year, month FROM ({SQL_MONTHS})", "news_v")
def year_month(spark, d) -> DataFrame:
    return news.with_months(view(spark, d, "news_v")).select("doc_id", "record_date", "year", "month")


@query("null_audit", f"""
SELECT source, count(*) AS rows, count(*) FILTER (datetime IS NULL) AS null_datetime,
  count(*) FILTER (record_date IS NULL) AS null_record_date
FROM ({SQL_MONTHS}) GROUP BY source""", "news_v")
def null_audit(spark, d) -> DataFrame:
    return news.null_audit(news.with_months(view(spark, d, "news_v")), ["datetime", "record_date"])


@query("pick_text", """
SELECT doc_id, CASE WHEN regexp_matches(summary, '\\S') THEN summary ELSE coalesce(headline, '') END
  AS text FROM news_v""", "news_v")
def pick_text(spark, d) -> DataFrame:
    return view(spark, d, "news_v").select(
        "doc_id", text.pick_text(F.col("summary"), F.col("headline")).alias("text"))


@query("combine_text", """
SELECT doc_id, concat_ws(' ', CASE WHEN doc_id % 6 = 0 THEN NULL ELSE text END,
  concat_ws(' ', source, CASE WHEN doc_id % 4 <> 0 THEN lang END)) AS combined_text FROM documents""")
def combine_text(spark, d) -> DataFrame:
    body = F.when(F.col("doc_id") % 6 != 0, F.col("text"))
    parts = F.array("source", F.when(F.col("doc_id") % 4 != 0, F.col("lang")))
    return table(spark, d, "documents").select(
        "doc_id", text.combine_text(body, parts).alias("combined_text"))


@query("expand_struct", """
SELECT event_id, symbol, finbert_negative AS negative_prob, finbert_positive AS positive_prob
FROM senti_v""", "senti_v")
def expand_struct_query(spark, d) -> DataFrame:
    info = F.struct(F.col("finbert_negative").alias("negative_prob"),
                    F.col("finbert_positive").alias("positive_prob"))
    return expand_struct(
        view(spark, d, "senti_v").select("event_id", "symbol", info.alias("info")), "info")


@query("parse_date_formats", """
SELECT doc_id, date, CAST(coalesce(try_strptime(date, '%B %d, %Y'), try_strptime(date, '%m/%d/%Y'))
  AS DATE) AS release_date FROM index_v""", "index_v")
def parse_date_formats(spark, d) -> DataFrame:
    return view(spark, d, "index_v").select(
        "doc_id", "date", dates.parse_index_date(F.col("date")).alias("release_date"))


@query("raw_sentiment", """
SELECT event_id, finbert_positive - finbert_negative AS raw_sentiment,
  1 - (finbert_positive + finbert_negative) AS neutral FROM senti_v""", "senti_v")
def raw_sentiment(spark, d) -> DataFrame:
    positive, negative = F.col("finbert_positive"), F.col("finbert_negative")
    return view(spark, d, "senti_v").select(
        "event_id", scores.raw_sentiment(positive, negative).alias("raw_sentiment"),
        scores.neutral_score(positive, negative).alias("neutral"))


@query("to_calendar_date", "SELECT event_id, CAST(ts AS DATE) AS date FROM events")
def to_calendar_date(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", dates.calendar_date(F.col("ts")).alias("date"))


@query("year_from_name", """
SELECT doc_id, CAST(2020 + doc_id % 6 AS INTEGER) AS year FROM documents WHERE doc_id % 4 <> 0""")
def year_from_name(spark, d) -> DataFrame:
    year = (F.col("doc_id") % 6 + 2020).cast("string")
    name = F.when(F.col("doc_id") % 4 != 0, F.concat(
        F.lit("article_"), year, F.lit(".parquet"))).otherwise("article_latest.parquet")
    named = table(spark, d, "documents").select("doc_id", name.alias("file"))
    return with_file_year(named, "file").drop("file")


# Filters --------------------------------------------------------------------------------------

@query("filter_date_range", """
SELECT doc_id, keyword, CAST(substr(date, 1, 10) AS DATE) AS day FROM articles_v
WHERE CAST(substr(date, 1, 10) AS DATE) >= date '2020-01-01'
  AND CAST(substr(date, 1, 10) AS DATE) < date '2025-03-01'""", "articles_v")
def filter_date_range(spark, d) -> DataFrame:
    days = view(spark, d, "articles_v").select(
        "doc_id", "keyword", dates.calendar_date(F.col("date")).alias("day"))
    return filters.filter_dates(days, "day", "2020-01-01", "2025-03-01")


@query("filter_index_range", """
SELECT doc_id, title, day FROM (SELECT *, CAST(coalesce(try_strptime(date, '%B %d, %Y'),
  try_strptime(date, '%m/%d/%Y')) AS DATE) AS day FROM index_v)
WHERE day BETWEEN date '2021-01-01' AND date '2024-02-29' ORDER BY day DESC, doc_id""", "index_v")
def filter_index_range(spark, d) -> DataFrame:
    days = view(spark, d, "index_v").select(
        "doc_id", "title", dates.parse_index_date(F.col("date")).alias("day"))
    found = filters.filter_dates(days, "day", "2021-01-01", "2024-02-29", end_inclusive=True)
    return found.orderBy(F.desc("day"), "doc_id")


@query("filter_links", """
SELECT doc_id, link FROM articles_v
WHERE NOT contains(link, '/videos/') AND NOT contains(link, '/cnn-underscored/')""", "articles_v")
def filter_links(spark, d) -> DataFrame:
    return filters.exclude_links(view(spark, d, "articles_v").select("doc_id", "link"), "link")


@query("filter_since", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
WHERE CAST(o_orderdate AS DATE) >= date '1996-01-01'""")
def filter_since(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return filters.since(orders, "date", "1996-01-01")


@query("filter_blank_text", r"SELECT doc_id, summary FROM news_v WHERE regexp_matches(summary, '\S')",
       "news_v")
def filter_blank_text(spark, d) -> DataFrame:
    return filters.usable_text(view(spark, d, "news_v").select("doc_id", "summary"), "summary")


@query("quarantine_undated", f"""
SELECT doc_id, keyword, datetime, CASE WHEN record_date IS NULL THEN 'quarantine' ELSE 'kept' END
  AS output FROM ({SQL_MONTHS})""", "news_v")
def quarantine_undated(spark, d) -> DataFrame:
    kept, undated = filters.split_undated(news.with_months(view(spark, d, "news_v")))
    both = (kept.withColumn("output", F.lit("kept"))
            .unionByName(undated.withColumn("output", F.lit("quarantine"))))
    return both.select("doc_id", "keyword", "datetime", "output")


@query("filter_in_list", """
SELECT doc_id, news_desk FROM archive_v WHERE news_desk IN ('Business', 'Financial', 'Market Place',
  'Business Day', 'DealBook', 'Personal Investing')""", "archive_v")
def filter_in_list(spark, d) -> DataFrame:
    return filters.filter_in(view(spark, d, "archive_v").select("doc_id", "news_desk"), "news_desk")


@query("bad_row_sample", f"""
SELECT doc_id, source, datetime FROM ({SQL_MONTHS}) WHERE record_date IS NULL
ORDER BY doc_id, source LIMIT 5""", "news_v")
def bad_row_sample(spark, d) -> DataFrame:
    dated = news.with_months(view(spark, d, "news_v")).select(
        "doc_id", "source", "datetime", "record_date")
    return filters.bad_rows(dated, "record_date", ["doc_id", "source"]).drop("record_date")


# Duplicates and merge --------------------------------------------------------------------------

SQL_ARTICLES = f"""
SELECT {sql_keyword('keyword')} AS symbol, 'CNN' AS source, substr(date, 1, 10) AS datetime,
  title AS headline, summary FROM cleaned"""

SQL_ARCHIVE = f"""
SELECT symbol, source, datetime, headline, summary FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, datetime, headline
      ORDER BY source NULLS FIRST, summary NULLS FIRST) AS r
  FROM (SELECT {sql_company('stock')} AS symbol, 'NYTD' AS source,
      CAST({SQL_OFFSET} AS VARCHAR) AS datetime, headline, content AS summary FROM archive_v))
WHERE r = 1"""

SQL_WIRE = f"""
SELECT symbol, source, CAST(CAST({sql_epoch('datetime')} AS DATE) AS VARCHAR) AS datetime,
  {sql_scrub('headline')} AS headline, {sql_scrub('summary')} AS summary FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, datetime, headline
      ORDER BY source NULLS FIRST, summary NULLS FIRST) AS r FROM wire_v)
WHERE r = 1"""

SQL_MERGED = f"""
WITH {SQL_BODY.strip()},
merged AS (
  SELECT *, 'articles' AS feed FROM ({SQL_ARTICLES}) UNION ALL
  SELECT *, 'archive' AS feed FROM ({SQL_ARCHIVE}) UNION ALL
  SELECT *, 'wire' AS feed FROM ({SQL_WIRE})),
analytic AS (SELECT * FROM (SELECT *, {sql_day('datetime')} AS record_date FROM merged)
  WHERE record_date IS NOT NULL)"""
FEED_VIEWS = "articles_v archive_v wire_v"


def merged_news(spark, d) -> DataFrame:
    """The dated news of all feeds."""
    feeds = {"articles": view(spark, d, "articles_v"), "archive": view(spark, d, "archive_v"),
             "wire": view(spark, d, "wire_v")}
    return news.merge_feeds(feeds)[0]


@query("conform_news", f"WITH {SQL_BODY.strip()} {SQL_ARTICLES}", "articles_v")
def conform_news(spark, d) -> DataFrame:
    return news.conform_articles(view(spark, d, "articles_v"))


@query("conform_archive", SQL_ARCHIVE, "archive_v")
def conform_archive(spark, d) -> DataFrame:
    return news.conform_archive(view(spark, d, "archive_v"))


@query("conform_wire", SQL_WIRE, "wire_v")
def conform_wire(spark, d) -> DataFrame:
    return news.conform_wire(view(spark, d, "wire_v"))


@query("merge_sources", f"""{SQL_MERGED}
SELECT symbol, source, datetime, headline, summary, feed, record_date,
  CAST(year(record_date) AS INTEGER) AS year, CAST(month(record_date) AS INTEGER) AS month
FROM analytic""", FEED_VIEWS)
def merge_sources(spark, d) -> DataFrame:
    return merged_news(spark, d)


@query("dedup_news", f"""
SELECT symbol, source, datetime, headline, summary FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, datetime, headline
      ORDER BY source NULLS FIRST, summary NULLS FIRST) AS r
  FROM (SELECT {sql_keyword('keyword')} AS symbol, source, datetime, headline, summary FROM news_v))
WHERE r = 1""", "news_v")
def dedup_news(spark, d) -> DataFrame:
    symbol = symbols.keyword_ticker(F.col("keyword")).alias("symbol")
    return news.dedup_news(view(spark, d, "news_v").select(
        symbol, "source", "datetime", "headline", "summary"))


@query("distinct_months", f"SELECT DISTINCT year, month FROM ({SQL_MONTHS})", "news_v")
def distinct_months(spark, d) -> DataFrame:
    return news.distinct_months(news.with_months(view(spark, d, "news_v")))


@query("partition_counts", f"SELECT year, month, count(*) AS rows FROM ({SQL_MONTHS}) GROUP BY 1, 2",
       "news_v")
def partition_counts(spark, d) -> DataFrame:
    return news.partition_counts(news.with_months(view(spark, d, "news_v")))


@query("facet_counts", "SELECT news_desk, count(*) AS rows FROM archive_v GROUP BY 1", "archive_v")
def facet_counts(spark, d) -> DataFrame:
    return news.facet_counts(view(spark, d, "archive_v"), "news_desk")


@query("backfill_range", f"""{SQL_MERGED}
SELECT symbol, source, headline, record_date FROM analytic
WHERE record_date BETWEEN date '2025-01-10' AND date '2025-02-20'""", FEED_VIEWS)
def backfill_range(spark, d) -> DataFrame:
    days = news.backfill(merged_news(spark, d), "2025-01-10", "2025-02-20")
    return days.select("symbol", "source", "headline", "record_date")


# Tables name their date column differently: `Date` where there is one, else `datetime`.
@query("date_column_choice", """
SELECT doc_id, CAST(substr(date, 1, 10) AS DATE) AS day, 'Date' AS chosen FROM articles_v WHERE doc_id % 2 = 0
UNION ALL SELECT doc_id, CAST(substr(date, 1, 10) AS DATE), 'datetime' FROM articles_v WHERE doc_id % 2 = 1""",
       "articles_v")
def date_column_choice(spark, d) -> DataFrame:
    articles = view(spark, d, "articles_v").select("doc_id", F.substring("date", 1, 10).alias("given"))
    both = articles.withColumnRenamed("given", "Date").withColumn("datetime", F.lit("not this one"))
    halves = [both.filter("doc_id % 2 = 0"),
              articles.filter("doc_id % 2 = 1").withColumnRenamed("given", "datetime")]
    out = [df.select("doc_id", dates.calendar_date(F.col(date_column(df))).alias("day"),
                     F.lit(date_column(df)).alias("chosen")) for df in halves]
    return out[0].unionByName(out[1])
