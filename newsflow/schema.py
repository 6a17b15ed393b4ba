"""Declared schemas of every table the pipeline reads or writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


RAW_ARTICLES = T.StructType(_strings("keyword", "date", "title", "content", "link"))
RAW_WIRE = T.StructType(_strings("symbol", "source", "datetime", "headline", "summary"))
RAW_ARCHIVE = T.StructType(
    _strings("headline", "pub_date", "content", "web_url", "news_desk", "stock"))

NEWS = T.StructType(_strings("symbol", "source", "datetime", "headline", "summary"))
NEWS_COLUMNS = NEWS.fieldNames()
NEWS_MONTHS = T.StructType(
    NEWS.fields + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])

PRESS_INDEX = T.StructType(_strings("date", "title", "category", "link"))
SPEECH_INDEX = T.StructType(_strings("date", "title", "speaker", "location", "link"))
PRESS_CONTENTS = T.StructType(
    _strings("url", "date", "title", "release_time", "content")
    + [T.StructField("pdf_links", T.ArrayType(T.StringType())),
       T.StructField("pdf_texts", T.ArrayType(T.StringType()))])
SPEECH_CONTENTS = T.StructType(_strings("url", "date", "title", "release_time", "content"))

SCORE_COLUMNS = ["finbert_positive", "finbert_neutral", "finbert_negative"]
NEWS_SCORED = T.StructType(NEWS.fields + _doubles(*SCORE_COLUMNS))
LABEL_STRUCT = T.StructType(
    _strings("sentiment_label") + _doubles("negative_prob", "neutral_prob", "positive_prob"))

#: The analytic table by staged day: a feed's day can be replaced on its own.
NEWS_DAYS = T.StructType([*NEWS_MONTHS.fields, *_strings("feed", "day")])

API_ARTICLE = T.StructType([
    T.StructField("headline", T.StructType(_strings("main"))),
    *_strings("pub_date", "lead_paragraph", "snippet", "web_url", "news_desk"),
])
API_REPLY = T.StructType([
    T.StructField("response", T.StructType([T.StructField("docs", T.ArrayType(API_ARTICLE))])),
])
API_ITEM = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("datetime", T.LongType()),
    *_strings("headline", "summary"),
])
PRICE_DOC = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))

PRICES = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())]
    + _doubles("open", "high", "low", "close") + [T.StructField("volume", T.LongType())])
PREDICTIONS = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("model", T.StringType()),
    *_doubles("actual", "predicted", "prev_close")])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """`df` unchanged; raises before any job when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df


def date_column(df: DataFrame) -> str:
    """Name of the date column: `Date` when there is one, else `datetime`."""
    for name in ("Date", "datetime"):
        if name in df.columns:
            return name
    raise ValueError("a Date or datetime column is required")
