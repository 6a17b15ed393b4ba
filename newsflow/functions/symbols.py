"""Company names and search keywords to tickers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Company to ticker. Netflix stands for NVDA in the archive feed, because that feed
# is asked for Netflix in place of Nvidia; pass another table to change it.
COMPANY_TICKER = {
    "Apple": "AAPL",
    "Amazon": "AMZN",
    "Google": "GOOGL",
    "Microsoft": "MSFT",
    "Facebook": "META",
    "Tesla": "TSLA",
    "Netflix": "NVDA",
}

# Lower-case search keyword to ticker.
KEYWORD_TICKER = {
    "apple": "AAPL",
    "google": "GOOGL",
    "alphabet": "GOOGL",
    "facebook": "META",
    "meta": "META",
    "microsoft": "MSFT",
    "amazon": "AMZN",
    "tesla": "TSLA",
    "elon musk": "TSLA",
    "nvidia": "NVDA",
}


def _lookup(key: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(pairs, key)


def company_ticker(col: Column, table: dict[str, str] = COMPANY_TICKER) -> Column:
    """Ticker of a company; an unknown name stays as it is."""
    return F.coalesce(_lookup(col, table), col)


def keyword_ticker(col: Column, table: dict[str, str] = KEYWORD_TICKER) -> Column:
    """Ticker of a keyword in any case; an unknown keyword in upper case; blank unchanged."""
    return F.coalesce(_lookup(F.lower(col), table), F.upper(col))


def keyword_table(spark: SparkSession, table: dict[str, str] = KEYWORD_TICKER) -> DataFrame:
    """The keyword map as a table (keyword, ticker)."""
    return spark.createDataFrame(list(table.items()), "keyword string, ticker string")


def map_symbol(df: DataFrame, mapping: DataFrame, column: str, name: str = "symbol") -> DataFrame:
    """Add ticker `name` by a left join with `mapping` (keyword, ticker).

    No hint: the join is broadcast only when the planner proves the mapping small. The mapping has
    one row per keyword, so rows are never multiplied.
    """
    found = mapping.select(F.lower("keyword").alias("_key"), F.col("ticker").alias("_ticker"))
    found = found.dropDuplicates(["_key"])
    joined = df.join(found, F.lower(df[column]) == found["_key"], "left")
    ticker = F.coalesce("_ticker", F.upper(F.col(column)))
    return joined.withColumn(name, ticker).drop("_key", "_ticker")
