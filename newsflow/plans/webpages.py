"""Queries over stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text
from newsflow.operators import pages
from newsflow.plans.registry import query
from newsflow.plans.views import table

BODY = pages.Element("article")


def sql_decoded(c: str) -> str:
    # the semicolon of these entities may be missing
    for entity, char in (("&quot", '"'), ("&middot", "·"), ("&copy", "©"), ("&lt", "<"),
                         ("&gt", ">"), ("&amp", "&")):
        c = f"regexp_replace({c}, '{entity};?', '{char}', 'g')"
    return c


_ARTICLE = r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
_TITLE = r"regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"


def sql_text(c: str) -> str:
    return sql_decoded(f"regexp_replace({c}, '<[^>]*>', '', 'g')")


# The stored pages have no times: every third gets one, in both engines.
_DAY = "'2025-03-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')"


@query("extract_page_fields", f"""
SELECT page_id, url, trim({sql_text(_TITLE)}) AS title, {sql_text(_ARTICLE)} AS content,
  CASE WHEN page_id % 3 = 0 THEN {_DAY} || 'T10:20:30.500' ELSE '9999-12-31' END AS date FROM pages""")
def extract_page_fields(spark, d) -> DataFrame:
    time = F.concat(F.lit('<meta content="'), F.expr(_DAY.replace("VARCHAR", "STRING")),
                    F.lit('T10:20:30.5Z" property="article:published_time"/>'))
    stored = table(spark, d, "pages").select("page_id", "url", F.concat(
        F.when(F.col("page_id") % 3 == 0, time).otherwise(""), "html").alias("html"))
    return pages.extract_articles(stored, "html", BODY)


@query("extract_release_fields", f"""
SELECT page_id, CASE WHEN page_id % 4 > 0 THEN {_DAY} END AS date,
  CASE WHEN page_id % 4 > 0 THEN trim({sql_text(_TITLE)}) END AS title,
  CASE WHEN page_id % 4 > 1 THEN 'at ' || CAST(page_id AS VARCHAR) END AS release_time FROM pages""")
def extract_release_fields(spark, d) -> DataFrame:
    """Date, title and release time inside a heading that three of four pages get in front."""
    n = F.col("page_id")
    title = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    time = F.concat(F.lit('<p class="releaseTime"> at '), n, F.lit(" </p>"))
    heading = F.concat(
        F.lit('<div class="heading col-xs-12 col-sm-8 col-md-8"><div><p class="article__time"> '),
        F.expr(_DAY.replace("VARCHAR", "STRING")), F.lit(' </p></div><h3 class="title">'), title,
        F.lit("</h3>"), F.when(n % 4 > 1, time).otherwise(""), F.lit("</div>"))
    stored = table(spark, d, "pages").select("page_id", F.concat(
        F.when(n % 4 > 0, heading).otherwise(""), "html").alias("html"))
    return pages.extract_releases(stored, "html", body=BODY).drop("content")


_STRIPPED = sql_decoded(r"regexp_replace(split_part(x, '</p>', 1), '\s*<[^>]*>\s*', '', 'g')")


@query("extract_paragraphs", f"""
SELECT page_id, array_to_string(list_transform(list_filter(
  string_split_regex({_ARTICLE}, '<p[^>]*>')[2:], lambda x: true),
  lambda x: trim({_STRIPPED}, concat(' ', chr(10), chr(9), chr(13)))), chr(10)) AS content
FROM pages""")
def extract_paragraphs(spark, d) -> DataFrame:
    stored = table(spark, d, "pages").select("page_id", "html")
    return pages.extract_releases(stored, "html", body=BODY).select("page_id", "content")


@query("extract_links", """
SELECT page_id, site || href AS link FROM (
  SELECT DISTINCT page_id, regexp_extract(url, '^[^/]*//[^/]*') AS site,
    unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
WHERE ends_with(lower(href), 'e')""")
def extract_links(spark, d) -> DataFrame:
    stored = table(spark, d, "pages").select("page_id", "url", "html")
    return pages.extract_links(stored, "url", "html", "E").select("page_id", "link")


@query("append_texts", """
SELECT page_id, array_to_string(list_filter([CASE WHEN page_id % 3 = 0 THEN '' ELSE url END,
  CASE WHEN page_id % 2 = 0 THEN html END, 'end'], lambda x: x IS NOT NULL AND x <> ''), chr(10))
  AS content FROM pages""")
def append_texts(spark, d) -> DataFrame:
    n = F.col("page_id")
    body = F.when(n % 3 == 0, "").otherwise(F.col("url"))
    texts = F.array(F.when(n % 2 == 0, F.col("html")), F.lit(""), F.lit("end"))
    return table(spark, d, "pages").select("page_id", text.append_texts(body, texts).alias("content"))
