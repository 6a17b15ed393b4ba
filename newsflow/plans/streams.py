"""Streaming queries over the given tables; each runs to its end and returns the written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators import news
from newsflow.plans import jobs
from newsflow.plans.cleansing import sql_epoch, sql_scrub
from newsflow.plans.features import _AVG, rounded, sql_round
from newsflow.plans.registry import query
from newsflow.plans.views import table, view
from newsflow.schema import RAW_WIRE
from newsflow.session import scratch_path, written
from newsflow.sources import writers
from newsflow.streaming import ingest

_SYMBOL = """CASE event_type WHEN 'view' THEN 'AAPL' WHEN 'click' THEN 'AMZN'
  WHEN 'purchase' THEN 'GOOGL' WHEN 'signup' THEN 'META' ELSE 'MSFT' END"""


def event_stream(spark, d) -> DataFrame:
    """The events table as a stream of its files, be it one file or a folder of them."""
    schema = table(spark, d, "events").schema
    # a stream takes a folder or a pattern; this pattern names the table, whichever of both it is
    events = ingest.ingest_stream(spark, f"{d}/events.parque[t]", schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _written(spark, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    ingest.append_files(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


@query("stream_ingest", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_ingest(spark, d) -> DataFrame:
    stream = event_stream(spark, d).select("event_id", "user_id", "event_type", "value", "props")
    return _written(spark, stream, "ingest")


@query("stream_dedup", f"SELECT event_id, {_SYMBOL} AS symbol, value FROM events")
def stream_dedup(spark, d) -> DataFrame:
    # every item is delivered again an hour later
    twice = event_stream(spark, d).select(
        "event_id", F.expr(_SYMBOL).alias("symbol"), "value",
        F.explode(F.array(F.col("ts"), F.col("ts") + F.expr("INTERVAL 1 HOUR"))).alias("ts"))
    once = ingest.dedup_stream(twice, ["event_id", "symbol"], "ts", "2 days")
    return _written(spark, once, "dedup").drop("ts")


SQL_DAYS = f"""
SELECT symbol, date, {sql_round('avg(p)', 'avg_positive')}, {sql_round('avg(1 - p - n)', 'avg_neutral')},
  {sql_round('avg(n)', 'avg_negative')}, count(*) AS news_count
FROM (SELECT {_SYMBOL} AS symbol, CAST(ts AS DATE) AS date, value / (value + 100) AS p,
  (1 - value / (value + 100)) / 2 AS n, max(ts) OVER () AS latest FROM events)"""


def _scored(events: DataFrame) -> DataFrame:
    positive = F.col("value") / (F.col("value") + 100)
    negative = (1 - positive) / 2
    return events.select(
        "ts", F.expr(_SYMBOL).alias("symbol"), positive.alias("positive_prob"),
        negative.alias("negative_prob"), (1 - positive - negative).alias("neutral_prob"))


@query("stream_daily_sentiment", f"""{SQL_DAYS}
WHERE date + INTERVAL 1 DAY <= latest - INTERVAL 12 HOUR GROUP BY symbol, date""")
def stream_daily_sentiment(spark, d) -> DataFrame:
    days = ingest.daily_stream(_scored(event_stream(spark, d)), "ts", "12 hours")
    return rounded(_written(spark, days, "daily"), _AVG)


# The events come as six files that are not cut by time, one file a batch: what the watermark leaves out is
# found by the numbers and counted anew from the stored events.
@query("stream_daily_rebuilt", f"{SQL_DAYS} GROUP BY symbol, date")
def stream_daily_rebuilt(spark, d) -> DataFrame:
    path = scratch_path(spark, "rebuilt")
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(6, "event_id").write.parquet(f"{path}/events")
    stored = _scored(spark.read.schema(events.schema).parquet(f"{path}/events"))
    stream = _scored(ingest.ingest_stream(spark, f"{path}/events", events.schema, files_per_batch=1))
    ingest.append_files(ingest.daily_stream(stream, "ts", "12 hours"), f"{path}/daily", f"{path}/checkpoint")
    daily = spark.read.schema("symbol string, date date, avg_positive double, avg_neutral double, "
                              "avg_negative double, news_count long").parquet(f"{path}/daily")
    days = written(ingest.incomplete_days(daily, stored, "ts"), "days")
    return rounded(ingest.rebuild_days(daily, stored, "ts", days), _AVG)


# Four increments; a fifth of the items comes again in the next one. Within an increment a story counts
# once at its second; what comes again on another day stays, as in a merge of all days.
@query("stream_month_upsert", f"""
SELECT symbol, CAST(day AS VARCHAR) AS datetime, {sql_scrub('headline')} AS headline,
  CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month
FROM (SELECT DISTINCT increment, symbol, headline, datetime, CAST({sql_epoch('datetime')} AS DATE) AS day
  FROM (SELECT *, unnest(CASE WHEN doc_id % 5 = 0 THEN [doc_id % 4, (doc_id + 1) % 4]
    ELSE [doc_id % 4] END) AS increment FROM wire_v)) WHERE day IS NOT NULL""", "wire_v")
def stream_month_upsert(spark, d) -> DataFrame:
    path = scratch_path(spark, "upsert")
    raw = _increments(spark, d)
    upsert = ingest.upsert_months(f"{path}/table", "wire")

    def conform(batch: DataFrame, number: int) -> None:
        upsert(news.with_months(news.conform_wire(batch)), number)

    for increment in range(4):
        arrived = raw.filter(F.col("increment") == increment).select(*RAW_WIRE.names)
        writers.write_staging(arrived, f"{path}/raw/day={increment}")
        stream = ingest.ingest_stream(spark, f"{path}/raw/*", RAW_WIRE)
        ingest.run_batches(stream, conform, f"{path}/checkpoint")
    return writers.read_months(spark, f"{path}/table", days=True).select(
        "symbol", "datetime", "headline", "year", "month")


def _increments(spark, d) -> DataFrame:
    n = F.col("doc_id")
    increments = F.when(n % 5 == 0, F.array(n % 4, (n + 1) % 4)).otherwise(F.array(n % 4))
    return view(spark, d, "wire_v").withColumn("increment", F.explode(increments))


# Three feeds of four days: merged at once, and added day by day out of order with one day twice.
@query("merge_equals_days", f"""
WITH wire AS (SELECT DISTINCT increment, symbol, headline, datetime,
    CAST({sql_epoch('datetime')} AS DATE) AS day
  FROM (SELECT *, unnest(CASE WHEN doc_id % 5 = 0 THEN [doc_id % 4, (doc_id + 1) % 4]
    ELSE [doc_id % 4] END) AS increment FROM wire_v)),
news AS (SELECT symbol, CAST(day AS VARCHAR) AS datetime, {sql_scrub('headline')} AS headline,
    increment, day AS date, 'wire' AS feed FROM wire
  UNION ALL SELECT 'AAPL', CASE WHEN page_id % 9 = 0 THEN NULL ELSE '2025-03-17' END, 'No title',
    page_id % 4, CASE WHEN page_id % 9 = 0 THEN NULL ELSE DATE '2025-03-17' END, 'articles' FROM pages)
SELECT how, feed, CAST(increment AS VARCHAR) AS day, symbol, datetime, headline,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM news, (SELECT unnest(['merge', 'days']) AS how) WHERE date IS NOT NULL""", "wire_v")
def merge_equals_days(spark, d) -> DataFrame:
    path = scratch_path(spark, "days")
    raw = _increments(spark, d)
    pages = table(spark, d, "pages").select(
        (F.col("page_id") % 4).alias("increment"), F.lit("AAPL").alias("symbol"), F.lit("CNN").alias("source"),
        F.when(F.col("page_id") % 9 != 0, F.lit("2025-03-17")).alias("datetime"),
        F.lit("No title").alias("headline"), F.lit("").alias("summary"))
    for day in range(4):
        wire = news.conform_wire(raw.filter(F.col("increment") == day).select(*RAW_WIRE.names))
        crawled = pages.filter(F.col("increment") == day).drop("increment")
        writers.write_staging(wire, f"{path}/staging/feed=wire/day={day}")
        writers.write_staging(crawled, f"{path}/staging/feed=articles/day={day}")
    jobs.merge(spark, f"{path}/staging", f"{path}/merge", f"{path}/bad")
    for day in ("2", "0", "3", "2", "1"):
        jobs.add_day(spark, f"{path}/staging", day, f"{path}/days", f"{path}/worse")
    columns = ["feed", "day", "symbol", "datetime", "headline", "year", "month"]
    return news.union_feeds([
        writers.read_months(spark, f"{path}/{how}", days=True).select(F.lit(how).alias("how"), *columns)
        for how in ("merge", "days")])


# Days are removed from the stage once they are in the table. A merge of what is staged later, of which one day
# has become shorter, leaves them where they are.
@query("merge_after_removal", """
SELECT 'articles' AS feed, CAST(page_id % 4 AS VARCHAR) AS day, CAST(page_id AS VARCHAR) AS headline,
  CAST(2025 AS INTEGER) AS year, CAST(page_id % 3 + 1 AS INTEGER) AS month FROM pages
WHERE page_id % 9 <> 0 AND (page_id % 4 <> 2 OR page_id % 3 = 1)""")
def merge_after_removal(spark, d) -> DataFrame:
    path, n = scratch_path(spark, "removal"), F.col("page_id")
    pages = table(spark, d, "pages").select(
        "page_id", F.lit("AAPL").alias("symbol"), F.lit("CNN").alias("source"),
        F.when(n % 9 != 0, F.concat(F.lit("2025-0"), n % 3 + 1, F.lit("-17"))).alias("datetime"),
        n.cast("string").alias("headline"), F.lit("").alias("summary"))

    def stage(day: int, kept: DataFrame) -> None:
        rows = kept.filter(n % 4 == day).drop("page_id")
        writers.write_staging(rows, f"{path}/staging/feed=articles/day={day}")

    for day in (0, 1, 2):
        stage(day, pages)
        jobs.add_day(spark, f"{path}/staging", str(day), f"{path}/table", f"{path}/bad", remove=day < 2)
    stage(2, pages.filter(n % 3 == 1))
    stage(3, pages)
    jobs.merge(spark, f"{path}/staging", f"{path}/table", f"{path}/bad")
    return writers.read_months(spark, f"{path}/table", days=True).select("feed", "day", "headline", "year", "month")
