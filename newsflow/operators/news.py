"""Three feeds to one news schema, duplicates, merge and month columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import dates, symbols, text
from newsflow.operators.filters import split_undated
from newsflow.schema import NEWS_COLUMNS, RAW_ARCHIVE, RAW_ARTICLES, RAW_WIRE, require

# Source names written by the feeds that have one constant name.
ARTICLE_SOURCE = "CNN"
ARCHIVE_SOURCE = "NYTD"
STORY = ["symbol", "datetime", "headline"]


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first by `order`. Null keys are equal to each other.

    The rank filter is also applied before the shuffle, so a key with very many copies sends one
    row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def dedup_news(df: DataFrame, keys: list[str] = STORY, order: list[str] | None = None) -> DataFrame:
    """One row per story. The survivor is the first by `order`, by default all other columns."""
    rest = order if order is not None else [c for c in df.columns if c not in keys]
    return keep_first(df, keys, rest or keys)


def conform_articles(df: DataFrame) -> DataFrame:
    """Crawled articles (keyword, date, title, content) to news. Copies stay."""
    require(df, *[c for c in RAW_ARTICLES.names if c != "link"])
    return df.select(
        symbols.keyword_ticker(F.col("keyword")).alias("symbol"),
        F.lit(ARTICLE_SOURCE).alias("source"),
        dates.format_date(F.col("date")).alias("datetime"),
        F.col("title").alias("headline"),
        text.clean_body(F.col("content")).alias("summary"),
    )


def conform_archive(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Archive replies (stock, pub_date, headline, content) to news, one row per story and day."""
    require(df, *[c for c in RAW_ARCHIVE.names if c not in ("web_url", "news_desk")])
    published = dates.parse_offset_date(F.col("pub_date"), lenient)
    news = df.select(
        symbols.company_ticker(F.col("stock")).alias("symbol"),
        F.lit(ARCHIVE_SOURCE).alias("source"),
        published.cast("string").alias("datetime"),
        F.col("headline"),
        F.col("content").alias("summary"),
    )
    return dedup_news(news)


def conform_wire(df: DataFrame) -> DataFrame:
    """Wire items to news: one row per story and second, then day text and scrubbed text.

    Duplicates go before the scrub, so stories that differ only in a URL both stay.
    """
    require(df, *RAW_WIRE.names)
    first = dedup_news(df.select(*NEWS_COLUMNS))
    return first.select(
        "symbol", "source",
        dates.parse_epoch_date(F.col("datetime")).cast("string").alias("datetime"),
        text.scrub(F.col("headline")).alias("headline"),
        text.scrub(F.col("summary")).alias("summary"),
    )


CONFORM = {"articles": conform_articles, "archive": conform_archive, "wire": conform_wire}


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns, matched by name."""
    if not feeds:
        raise ValueError("no feed to merge")
    return reduce(DataFrame.unionByName, feeds)


def with_feed(df: DataFrame, feed: str) -> DataFrame:
    """Add the feed a row came in by; `source` may hold a publisher's name instead."""
    return df.withColumn("feed", F.lit(feed))


def with_months(df: DataFrame, column: str = "datetime", lenient: bool = False) -> DataFrame:
    """Add `record_date`, `year` and `month` of the text date."""
    day = dates.normalize_date(F.col(column).cast("string"), lenient)
    return (df.withColumn("record_date", day)
            .withColumn("year", F.year("record_date"))
            .withColumn("month", F.month("record_date")))


def merge_feeds(feeds: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Conform every raw feed, merge them and split off rows without a date.

    One lazy plan; the only exchanges are those of the per-feed duplicate filters.
    """
    news = union_feeds([with_feed(CONFORM[name](df), name) for name, df in feeds.items()])
    return split_undated(with_months(news))


def null_audit(df: DataFrame, columns: list[str], by: str = "source") -> DataFrame:
    """Rows and nulls per column and `by`, in one pass."""
    return df.groupBy(by).agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def distinct_months(df: DataFrame) -> DataFrame:
    return df.select("year", "month").distinct()


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per month."""
    return df.groupBy("year", "month").agg(F.count("*").alias("rows"))


def facet_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def backfill(df: DataFrame, start, end) -> DataFrame:
    """News of the days `start` to `end`, both included, every day once, in one job."""
    return df.filter(F.col("record_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
