"""Stored API replies to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.schema import API_ITEM, API_REPLY

# Fixed value: news desk of an article that names none.
NO_DESK = "N/A"


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def flatten_docs(df: DataFrame, column: str, stock: str) -> DataFrame:
    """One row per article of archive replies, `response.docs[]`, with the name searched for.

    The content is the lead paragraph, else the snippet, else empty.
    """
    reply = F.from_json(column, API_REPLY)
    docs = df.select(F.col(stock).alias("stock"), F.explode(reply["response"]["docs"]).alias("doc"))
    content = F.coalesce(F.nullif(F.col("doc.lead_paragraph"), F.lit("")),
                         F.nullif(F.col("doc.snippet"), F.lit("")), F.lit(""))
    return docs.select(
        _text(F.col("doc.headline.main")).alias("headline"),
        _text(F.col("doc.pub_date")).alias("pub_date"),
        content.alias("content"),
        _text(F.col("doc.web_url")).alias("web_url"),
        F.coalesce("doc.news_desk", F.lit(NO_DESK)).alias("news_desk"),
        "stock",
    )


def flatten_items(df: DataFrame, column: str, symbol: str) -> DataFrame:
    """One row per item of wire replies, JSON arrays, with the symbol asked for.

    Epoch seconds become text; missing fields become empty.
    """
    items = F.from_json(column, T.ArrayType(API_ITEM))
    rows = df.select(F.col(symbol).alias("symbol"), F.explode(items).alias("item"))
    return rows.select(
        "symbol", _text(F.col("item.source")).alias("source"),
        _text(F.col("item.datetime").cast("string")).alias("datetime"),
        _text(F.col("item.headline")).alias("headline"),
        _text(F.col("item.summary")).alias("summary"),
    )
