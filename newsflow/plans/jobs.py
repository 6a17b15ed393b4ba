"""The daily jobs: cleanse a feed, merge the staging area, score the news, build features.

Each job reads one layer by path and writes the next one; running it again for the same day gives the
same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions import dates, scores, text
from newsflow.operators import forecast, metrics, news, scoring, series
from newsflow.operators.filters import split_undated
from newsflow.schema import (LABEL_STRUCT, NEWS, NEWS_COLUMNS, RAW_ARCHIVE, RAW_ARTICLES, RAW_WIRE,
                             SCORE_COLUMNS, date_column)
from newsflow.session import written
from newsflow.sources import readers, writers

RAW = {"articles": RAW_ARTICLES, "archive": RAW_ARCHIVE, "wire": RAW_WIRE}


def cleanse(spark: SparkSession, feed: str, raw: list[str], staging: str, day: str = "full") -> str:
    """Conform raw files of a feed and replace its staging folder of that day."""
    df = readers.read_parquet(spark, *raw, schema=RAW[feed])
    return writers.write_staging(news.CONFORM[feed](df), f"{staging}/feed={feed}/day={day}")


def _staged(spark: SparkSession, staging: str, *folders: str) -> DataFrame:
    """Staged news with their feed, staged day and month."""
    schema = T.StructType([*NEWS.fields, T.StructField("feed", T.StringType()),
                           T.StructField("day", T.StringType())])
    return news.with_months(spark.read.schema(schema).option("basePath", staging).parquet(
        *[f"{staging}/{f}" for f in folders]))


def _replace(spark: SparkSession, staging: str, staged: str, target: str, quarantine: str) -> None:
    """Put the staged days that `staged` names into the months and the quarantine.

    First everything is written, a folder at a time replacing what it was; then folders of these days that the
    new rows no longer fill are deleted. So a write that fails leaves the table as it was, or with some days
    new and none missing, and days that are no longer staged stay.
    """
    days = {writers.folder_keys(p, ["feed", "day"]) for p in writers.folders(spark, f"{staging}/{staged}")}
    dated, undated = split_undated(_staged(spark, staging, staged))
    writers.write_days(dated, target)
    writers.write_feeds(undated.select(*NEWS_COLUMNS, "feed", "day"), quarantine, ["day", "feed"])
    for path, pattern, rows, keys in (
            (target, "year=*/month=*/feed=*/day=*", dated, ["year", "month", "feed", "day"]),
            (quarantine, "day=*/feed=*", undated, ["day", "feed"])):
        # a row per folder
        filled = {tuple(map(str, r)) for r in rows.select(*keys).distinct().collect()}
        for folder in writers.folders(spark, f"{path}/{pattern}"):
            found = dict(zip(keys, writers.folder_keys(folder, keys)))
            if (found["feed"], found["day"]) in days and tuple(found.values()) not in filled:
                writers.remove_folders(spark, folder)


def merge(spark: SparkSession, staging: str, target: str, quarantine: str) -> DataFrame:
    """Put all staged news into their months and rows without a date into the quarantine.

    Days that are not staged, as those that `add_day` has removed from the stage, stay as they are. Returns the
    rows per month, null for the quarantine.
    """
    _replace(spark, staging, "feed=*/day=*", target, quarantine)
    return _counts(spark, target, quarantine)


def add_day(spark: SparkSession, staging: str, day: str, target: str, quarantine: str,
            remove: bool = False) -> DataFrame:
    """Put the staged news of one day, as yyyyMMdd, into their months in the place of what that day had.

    Nothing else in the months is read or written, so the outcome is that of `merge` over all days,
    whatever their order and however often a day is added. With `remove` the staged day is deleted at
    the end. Returns the rows per month of the day.
    """
    _replace(spark, staging, f"feed=*/day={day}", target, quarantine)
    counts = _counts(spark, target, quarantine, day)
    if remove:
        writers.remove_folders(spark, f"{staging}/feed=*/day={day}")
    return counts


def _counts(spark: SparkSession, target: str, quarantine: str, day: str | None = None) -> DataFrame:
    """Rows per month of what was written, and of the quarantine; only folder names are read."""
    schema = T.StructType([*NEWS.fields, T.StructField("day", T.StringType())])
    bad = spark.read.schema(schema).parquet(quarantine).select(
        "day", F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"))
    rows = writers.read_months(spark, target, days=True).select("day", "year", "month").unionByName(bad)
    return news.partition_counts(rows if day is None else rows.filter(F.col("day") == day))


def score(spark: SparkSession, target: str, scored: str, months: list[tuple[int, int]] | None = None,
          lexicon: scores.Lexicon = scores.FINANCE,
          load: Callable[[], scoring.Scorer] | None = None, tokens: bool = False) -> str:
    """Score the picked text of every story and replace the same months of the scored table.

    `load` plugs in a model; without it the lexicon is used. With `tokens` the windows of long texts are cut by the
    tokens of the model, not by words. The table is written once, so that the
    features do not run the model again.
    """
    stories = writers.read_months(spark, target, months)
    picked = stories.withColumn("text", text.pick_text(F.col("summary"), F.col("headline")))
    if load is None:
        out = scoring.score_lexicon(picked, "text", lexicon)
    elif tokens:
        out = scoring.label_tokens(picked, "text", load)
    else:
        out = scoring.score_label(picked, "text", load, only_long=False)
    columns = [*NEWS_COLUMNS, *LABEL_STRUCT.names, "year", "month"]
    (out.select(*columns).write.mode("overwrite").partitionBy("year", "month")
     .option("partitionOverwriteMode", "dynamic").parquet(scored))
    return scored


def features(spark: SparkSession, scored: str) -> DataFrame:
    """Daily sentiment per symbol with the values of the day before."""
    rows = spark.read.parquet(scored).withColumn("date", dates.normalize_date(F.col("datetime")))
    return series.add_lags(series.daily_sentiment(rows))


def price_features(spark: SparkSession, scored: str, prices: DataFrame) -> DataFrame:
    """Prices with the daily means of the rolling article features.

    Articles of a symbol are sorted by date, and within a day by a hash of their content, as rows of a
    table have no order. Texts do not travel through the series, only their scores. Prices without a `date` have it in
    `Date` or `datetime`.
    """
    if "date" not in prices.columns:
        given = date_column(prices)
        prices = prices.withColumn(given, dates.calendar_date(F.col(given))).withColumnRenamed(given, "date")
    rows = spark.read.parquet(scored)
    articles = rows.select(
        "symbol", dates.normalize_date(F.col("datetime")).alias("date"),
        F.xxhash64(*NEWS_COLUMNS).alias("article"),
        *[F.col(f"{c.removeprefix('finbert_')}_prob").alias(c) for c in SCORE_COLUMNS])
    rolled = series.sentiment_features(articles, ["symbol"], ["date", "article"])
    return series.join_sentiment(prices, series.daily_feature_mean(rolled))


def evaluate(df: DataFrame, feature_sets: dict[str, list[str]], train_end: str,
             path: str) -> DataFrame:
    """Compare regressions on feature sets; writes predictions and metrics, returns the metrics."""
    split = series.split_date(df, train_end=train_end)
    predictions = written(forecast.compare_regressors(split, feature_sets), "predictions")
    errors = metrics.forecast_metrics(predictions)
    table = metrics.predictions_table(predictions, list(feature_sets))
    writers.write_csv(table.orderBy("symbol", "date"), f"{path}/predictions")
    writers.write_csv(errors, f"{path}/evaluation")
    return errors
