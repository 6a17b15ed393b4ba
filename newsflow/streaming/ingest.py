"""New files once each, duplicates across increments, daily windows and month upserts.

Every stream runs with `availableNow`: it takes what has arrived since its checkpoint and stops, so a
scheduler may start it as often as it likes. Sinks are files; nothing passes through the driver.

Where a watermark follows, files must be taken oldest event day first, at most a day's files at a time,
or all that has arrived as one batch. A long history belongs into the batch operators, and what came too
late is found by comparing the outcome with the stored rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.sources.writers import write_days


def ingest_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None,
                  files_per_batch: int | None = None, archive: str | None = None) -> DataFrame:
    """Parquet files below `path` as a stream; `archive` moves the files that were taken there."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)


def append_files(stream: DataFrame, path: str, checkpoint: str,
                 partition_by: list[str] = []) -> str:
    """Run the stream over what is there and append the rows to a parquet table."""
    (stream.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
     .option("path", path).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return path


def dedup_stream(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """One row per key among rows at most `delay` apart; older keys are forgotten."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def daily_stream(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """Daily sentiment per symbol. A day comes out once, when `delay` has passed after its end.

    Rows that come later than that are not in it: `incomplete_days` finds their days, and
    `rebuild_days` counts them anew from the stored rows.
    """
    days = stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), "symbol").agg(*_daily())
    return days.select("symbol", F.to_date("window.start").alias("date"), "avg_positive",
                       "avg_neutral", "avg_negative", "news_count")


def _daily() -> list[Column]:
    return [*[F.avg(f"{kind}_prob").alias(f"avg_{kind}") for kind in ("positive", "neutral", "negative")],
            F.count("*").alias("news_count")]


def _by_day(rows: DataFrame, time: str) -> DataFrame:
    return rows.filter(F.col(time).isNotNull()).withColumn("date", F.to_date(time))


def incomplete_days(daily: DataFrame, rows: DataFrame, time: str, until=None) -> DataFrame:
    """The days (`date`) before `until` on which `daily` counts other news than `rows` has.

    The table is compared with the rows by their numbers per symbol and day, so it does not matter
    why a row is missing: late, out of order, or of a batch that was never run.
    """
    counted = _by_day(rows, time).groupBy("symbol", "date").agg(F.count("*").alias("n"))
    if until is not None:
        counted = counted.filter(F.col("date") < F.lit(until).cast("date"))
    known = daily.select("symbol", "date", "news_count")
    both = counted.join(known, ["symbol", "date"], "left")
    return both.filter("news_count IS NULL OR news_count != n").select("date").distinct()


def rebuild_days(daily: DataFrame, rows: DataFrame, time: str, days: DataFrame) -> DataFrame:
    """`daily` with the days `days` counted anew from `rows`."""
    renewed = (_by_day(rows, time).join(days, "date", "left_semi").groupBy("symbol", "date").agg(*_daily()))
    kept = daily.join(days, "date", "left_anti").select(*renewed.columns)
    return kept.unionByName(renewed)


def upsert_months(target: str, feed: str) -> Callable[[DataFrame, int], None]:
    """Batch function that adds conformed news to the months they belong to.

    A micro-batch is a staged day of its own, so a batch that is run again after a failure replaces
    what it wrote the first time. Stored news is neither read nor changed.
    """
    def upsert(batch: DataFrame, number: int) -> None:
        news = batch.filter("year IS NOT NULL")
        write_days(news.withColumn("feed", F.lit(feed)).withColumn("day", F.lit(f"batch-{number}")), target)

    return upsert


def run_batches(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run the stream over what is there, one call of `batch` per micro-batch."""
    (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
