"""Crawl index: what is still to fetch, upserts and request grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.news import keep_first

# Keys of the two indexes.
PRESS_KEYS = ["date", "title", "category"]
SPEECH_KEYS = ["date", "title", "speaker", "location"]


def frontier(index: DataFrame, processed: DataFrame, key: str = "link") -> DataFrame:
    """Index rows whose link was not processed yet."""
    return index.join(processed.select(key).distinct(), key, "left_anti")


def upsert_index(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The old index plus the new rows with unknown keys; one row per key, first by `order`.

    `is_new` tells them apart. A known key keeps its old row, so that old rows rank first; one
    ranking does the work of an anti join and a duplicate filter. Null keys are equal.
    """
    rows = old.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
    return keep_first(rows, keys, ["is_new", *order])


def fan_out(symbols: DataFrame, start, end) -> DataFrame:
    """Every symbol for every day from `start` to `end`: the requests of a catch-up run."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return symbols.withColumn("date", F.explode(days))
