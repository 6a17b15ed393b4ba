"""Input views: news, prices and scored articles out of the given tables.

The tables hold no news, so these views give them the shape of the feeds. Their text runs on Spark
and on DuckDB; `{documents}`, `{orders}` and `{events}` stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_KEYWORD = """CASE doc_id % 10 WHEN 0 THEN 'apple' WHEN 1 THEN 'google' WHEN 2 THEN 'alphabet'
    WHEN 3 THEN 'facebook' WHEN 4 THEN 'meta' WHEN 5 THEN 'microsoft' WHEN 6 THEN 'amazon'
    WHEN 7 THEN 'tesla' WHEN 8 THEN 'Elon Musk' ELSE 'other' END"""

_STOCK = """CASE doc_id % 8 WHEN 0 THEN 'Apple' WHEN 1 THEN 'Amazon' WHEN 2 THEN 'Google'
    WHEN 3 THEN 'Microsoft' WHEN 4 THEN 'Facebook' WHEN 5 THEN 'Tesla' WHEN 6 THEN 'Netflix'
    ELSE 'Other' END"""

_TICKER = """CASE doc_id % 7 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'MSFT' WHEN 2 THEN 'GOOGL'
    WHEN 3 THEN 'AMZN' WHEN 4 THEN 'META' WHEN 5 THEN 'TSLA' ELSE 'NVDA' END"""

_HEADLINE = """concat('Story (', CAST(doc_id % 50 AS STRING), ')  [x] http://a.example/',
    CAST(doc_id AS STRING), ' <b>', source, ' in ', lang, '</b>')"""

_SUMMARY = """CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '   '
    ELSE concat('<p>', text, '</p> [pic] http://x.example/1') END"""

TEXT: dict[str, str] = {
    # canonical news with every date form; a fifth of the rows comes twice
    "news_v": f"""
WITH b AS (SELECT *, CAST(doc_id % 90 AS INT) AS k FROM {{documents}}),
n AS (
SELECT doc_id, {_KEYWORD} AS keyword, {_STOCK} AS stock, source,
  CASE doc_id % 4
    WHEN 0 THEN concat(CAST(date '2025-01-01' + k AS STRING), 'T12:34:56.',
                       lpad(CAST(doc_id % 1000 AS STRING), 3, '0'))
    WHEN 1 THEN CAST(1735689600 + k * 86400 + doc_id % 86400 AS STRING)
    WHEN 2 THEN CAST(date '2025-01-01' + k AS STRING)
    ELSE CASE WHEN doc_id % 8 = 3 THEN NULL ELSE 'not a date' END END AS datetime,
  {_HEADLINE} AS headline, {_SUMMARY} AS summary
FROM b)
SELECT * FROM n UNION ALL SELECT * FROM n WHERE doc_id % 5 = 0""",

    # crawled articles: quotes, indented lines, teasers and a dateline around the whole text
    "articles_v": f"""
SELECT doc_id, {_KEYWORD} AS keyword,
  CASE WHEN doc_id % 13 = 0 THEN '9999-12-31'
    ELSE concat(CAST(date '2020-01-01' + CAST(doc_id % 1900 AS INT) AS STRING), 'T12:34:56.',
                lpad(CAST(doc_id % 1000 AS STRING), 3, '0')) END AS date,
  CASE WHEN doc_id % 17 = 0 THEN 'No title' ELSE concat('Title ', CAST(doc_id AS STRING)) END AS title,
  CASE WHEN doc_id % 19 = 0 THEN 'No content' WHEN doc_id % 23 = 0 THEN '' ELSE
    concat('“', '            New York CNN Business - ',
      replace(replace(text, chr(10), concat(chr(10), chr(9), chr(9), chr(9))), '. ',
        CASE doc_id % 4
          WHEN 0 THEN concat('.', chr(10), 'Related article', chr(10), '            ')
          WHEN 1 THEN concat('.', chr(10), ' Related article ', chr(10), 'Related article',
                             chr(10), '            ')
          WHEN 2 THEN concat('.', chr(10), '            ') ELSE '. ' END), '”') END AS content,
  concat('https://news.example/', CAST(2020 + doc_id % 6 AS STRING),
    CASE doc_id % 5 WHEN 0 THEN '/videos/' WHEN 1 THEN '/cnn-underscored/' ELSE '/business/' END,
    CAST(doc_id AS STRING)) AS link
FROM {{documents}}""",

    # archive replies with three offset forms; a fifth of the rows comes twice
    "archive_v": f"""
WITH n AS (
SELECT doc_id, concat('Headline ', CAST(doc_id AS STRING)) AS headline,
  CASE WHEN doc_id % 29 = 0 THEN 'soon'
    ELSE concat(CAST(date '2025-01-01' + CAST(doc_id % 90 AS INT) AS STRING), 'T12:34:56',
      CASE doc_id % 3 WHEN 0 THEN '+0000' WHEN 1 THEN 'Z' ELSE '+00:00' END) END AS pub_date,
  text AS content, concat('https://archive.example/', CAST(doc_id AS STRING)) AS web_url,
  CASE doc_id % 9 WHEN 0 THEN 'Business' WHEN 1 THEN 'Financial' WHEN 2 THEN 'Market Place'
    WHEN 3 THEN 'Business Day' WHEN 4 THEN 'DealBook' WHEN 5 THEN 'Personal Investing'
    WHEN 6 THEN 'Sports' WHEN 7 THEN 'Culture' ELSE NULL END AS news_desk,
  {_STOCK} AS stock
FROM {{documents}})
SELECT * FROM n UNION ALL SELECT * FROM n WHERE doc_id % 5 = 0""",

    # wire items with epoch seconds as text; a fifth of the rows comes twice
    "wire_v": f"""
WITH n AS (
SELECT doc_id, {_TICKER} AS symbol, source,
  CASE WHEN doc_id % 31 = 0 THEN '' ELSE
    CAST(1735689600 + (doc_id % 90) * 86400 + doc_id % 86400 AS STRING) END AS datetime,
  {_HEADLINE} AS headline, {_SUMMARY} AS summary
FROM {{documents}})
SELECT * FROM n UNION ALL SELECT * FROM n WHERE doc_id % 5 = 0""",

    # index of releases: two date forms, some without a date
    "index_v": """
SELECT doc_id,
  CASE WHEN doc_id % 37 = 0 THEN 'undated'
    WHEN doc_id % 2 = 0 THEN concat(
      CASE (doc_id % 12) + 1 WHEN 1 THEN 'January' WHEN 3 THEN 'March' WHEN 5 THEN 'May'
        WHEN 7 THEN 'July' WHEN 9 THEN 'September' ELSE 'November' END,
      ' ', CAST(doc_id % 28 + 1 AS STRING), ', ', CAST(2020 + doc_id % 6 AS STRING))
    ELSE concat(CAST(doc_id % 12 + 1 AS STRING), '/', CAST(doc_id % 28 + 1 AS STRING), '/',
                CAST(2020 + doc_id % 6 AS STRING)) END AS date,
  concat('Release ', CAST(doc_id % 40 AS STRING)) AS title,
  CASE doc_id % 3 WHEN 0 THEN 'Monetary Policy' WHEN 1 THEN 'Orders' ELSE NULL END AS category,
  concat('https://releases.example/', CAST(doc_id AS STRING)) AS link
FROM {documents}""",

    # daily prices per symbol
    "prices_v": """
SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'AAPL' WHEN '2' THEN 'AMZN'
         WHEN '3' THEN 'GOOGL' WHEN '4' THEN 'META' ELSE 'MSFT' END AS symbol,
  CAST(o_orderdate AS DATE) AS date,
  min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
  max_by(o_totalprice, o_orderkey) AS close, count(*) AS volume
FROM {orders} GROUP BY 1, 2""",

    # scored articles; every third day has none
    "senti_v": """
SELECT event_id,
  CASE event_type WHEN 'view' THEN 'AAPL' WHEN 'click' THEN 'AMZN' WHEN 'purchase' THEN 'GOOGL'
    WHEN 'signup' THEN 'META' ELSE 'MSFT' END AS symbol,
  date '1995-01-01' + CAST(floor((event_id % 267) * 1.5) AS INT) AS date,
  value / (value + 100) AS finbert_positive,
  (1 - value / (value + 100)) * (event_id % 7) / 10 AS finbert_negative
FROM {events}""",
}

SQL: dict[str, str] = {
    name: text.format(documents="documents", orders="orders", events="events").strip()
    for name, text in TEXT.items()
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An input view over the given tables."""
    text = TEXT[name]
    tables = {t: table(spark, folder, t) for t in ("documents", "orders", "events")
              if "{" + t + "}" in text}
    return spark.sql(text, **tables)
