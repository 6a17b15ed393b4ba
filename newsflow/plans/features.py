"""Queries over daily and article series: joins, windows, fills, sequences and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators import index, report, series
from newsflow.plans.registry import query
from newsflow.plans.views import table, view

ARTICLE_KEYS, ARTICLE_ORDER = ["symbol"], ["date", "event_id"]
_ROWS = "OVER (PARTITION BY symbol ORDER BY date, event_id"
_DAYS = "OVER (PARTITION BY symbol ORDER BY date"


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def sql_round(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name}"


def scored(spark, d) -> DataFrame:
    """Scored articles as input of the daily aggregate."""
    return view(spark, d, "senti_v").select(
        "event_id", "symbol", "date", F.col("finbert_positive").alias("positive_prob"),
        (1 - (F.col("finbert_positive") + F.col("finbert_negative"))).alias("neutral_prob"),
        F.col("finbert_negative").alias("negative_prob"))


def daily(spark, d) -> DataFrame:
    return series.daily_sentiment(scored(spark, d))


SQL_DAILY = """
daily AS (SELECT symbol, date, avg(finbert_positive) AS avg_positive,
  avg(1 - (finbert_positive + finbert_negative)) AS avg_neutral,
  avg(finbert_negative) AS avg_negative, count(*) AS news_count
  FROM senti_v GROUP BY symbol, date)"""
_AVG = ["avg_positive", "avg_neutral", "avg_negative"]


@query("daily_sentiment", f"""
WITH {SQL_DAILY.strip()} SELECT symbol, date, {', '.join(sql_round(c, c) for c in _AVG)}, news_count
FROM daily""", "senti_v")
def daily_sentiment(spark, d) -> DataFrame:
    return rounded(daily(spark, d), _AVG)


@query("lag_features", f"""
WITH {SQL_DAILY.strip()} SELECT symbol, date, {', '.join(sql_round(c, c) for c in _AVG)}, news_count,
  {', '.join(sql_round(f'lag({c}) {_DAYS})', f'lag_{c}') for c in _AVG)},
  lag(news_count) {_DAYS}) AS lag_news_count FROM daily""", "senti_v")
def lag_features(spark, d) -> DataFrame:
    return rounded(series.add_lags(daily(spark, d)), _AVG + [f"lag_{c}" for c in _AVG])


# Article series --------------------------------------------------------------------------------

def _article_columns(spark, d, make, before: int) -> DataFrame:
    raw = view(spark, d, "senti_v").select(
        "event_id", "symbol", "date",
        (F.col("finbert_positive") - F.col("finbert_negative")).alias("raw"))
    return series.over_rows(raw, ARTICLE_KEYS, ARTICLE_ORDER, [make], before)


_RAW = "(SELECT event_id, symbol, date, finbert_positive - finbert_negative AS raw FROM senti_v)"


@query("rolling_mean", f"""
SELECT event_id, symbol, {sql_round(f'avg(raw) {_ROWS} ROWS 2 PRECEDING)', 'mean_3')},
  {sql_round(f'avg(raw) {_ROWS} ROWS 4 PRECEDING)', 'mean_5')} FROM {_RAW}""", "senti_v")
def rolling_mean(spark, d) -> DataFrame:
    out = _article_columns(spark, d, lambda w: {
        "mean_3": series.rolling_mean("raw", 3, w), "mean_5": series.rolling_mean("raw", 5, w)}, 4)
    return rounded(out.select("event_id", "symbol", "mean_3", "mean_5"), ["mean_3", "mean_5"])


@query("rolling_std", f"""
SELECT event_id, symbol,
  {sql_round(f'coalesce(stddev_samp(raw) {_ROWS} ROWS 2 PRECEDING), 0)', 'std_3')},
  {sql_round(f'coalesce(stddev_samp(raw) {_ROWS} ROWS 4 PRECEDING), 0)', 'std_5')} FROM {_RAW}""",
       "senti_v")
def rolling_std(spark, d) -> DataFrame:
    out = _article_columns(spark, d, lambda w: {
        "std_3": series.rolling_std("raw", 3, w), "std_5": series.rolling_std("raw", 5, w)}, 4)
    return rounded(out.select("event_id", "symbol", "std_3", "std_5"), ["std_3", "std_5"])


@query("diff", f"""
SELECT event_id, symbol, coalesce(raw - lag(raw) {_ROWS}), 0) AS diff FROM {_RAW}""", "senti_v")
def diff(spark, d) -> DataFrame:
    out = _article_columns(spark, d, lambda w: {"diff": series.diff("raw", w)}, 1)
    return out.select("event_id", "symbol", "diff")


@query("pct_change", f"""
SELECT event_id, symbol, coalesce(CASE WHEN prev = 0 THEN CASE WHEN raw > 0 THEN 'inf'::DOUBLE
    WHEN raw < 0 THEN '-inf'::DOUBLE END ELSE (raw - prev) / prev END, 0) AS change
FROM (SELECT *, lag(raw) {_ROWS}) AS prev FROM {_RAW})""", "senti_v")
def pct_change(spark, d) -> DataFrame:
    out = _article_columns(spark, d, lambda w: {"change": series.pct_change("raw", w)}, 1)
    return out.select("event_id", "symbol", "change")


SQL_FEATURES = f"""
level AS (SELECT *, avg(raw) {_ROWS} ROWS 2 PRECEDING) AS s, 1 - (pos + neg) AS n FROM (
  SELECT event_id, symbol, date, finbert_positive AS pos, finbert_negative AS neg,
    finbert_positive - finbert_negative AS raw FROM senti_v)),
before AS (SELECT *, lag(s) {_ROWS}) AS ps, lag(n) {_ROWS}) AS pn FROM level),
features AS (SELECT event_id, symbol, date, s AS "Sentiment", coalesce(s - ps, 0) AS "Sentiment_Diff",
  coalesce(stddev_samp(s) {_ROWS} ROWS 2 PRECEDING), 0) AS "Sentiment_Volatility",
  avg(s) {_ROWS} ROWS 4 PRECEDING) AS "Sentiment_MA5",
  coalesce(CASE WHEN ps = 0 THEN CASE WHEN s > 0 THEN 'inf'::DOUBLE WHEN s < 0 THEN '-inf'::DOUBLE
    END ELSE (s - ps) / ps END, 0) AS "Sentiment_Change",
  coalesce(stddev_samp(s) {_ROWS} ROWS 4 PRECEDING), 0) AS "Sentiment_Volatility_MA5",
  n AS "Neutral", coalesce(n - pn, 0) AS "Neutral_Diff",
  coalesce(stddev_samp(n) {_ROWS} ROWS 2 PRECEDING), 0) AS "Neutral_Volatility",
  avg(n) {_ROWS} ROWS 4 PRECEDING) AS "Neutral_MA5" FROM before),
daily_features AS (SELECT symbol, date, {', '.join(f'avg("{c}") AS "{c}"'
                                                   for c in series.SENTIMENT_FEATURES)}
  FROM features GROUP BY symbol, date)"""


def features(spark, d) -> DataFrame:
    """Daily means of the article features."""
    rows = series.sentiment_features(view(spark, d, "senti_v"), ARTICLE_KEYS, ARTICLE_ORDER)
    return series.daily_feature_mean(rows)


@query("daily_feature_mean", f"""
WITH {SQL_FEATURES.strip()} SELECT symbol, date, {', '.join(
    sql_round(f'"{c}"', f'"{c}"', 4) for c in series.SENTIMENT_FEATURES)} FROM daily_features""",
       "senti_v")
def daily_feature_mean(spark, d) -> DataFrame:
    return rounded(features(spark, d), series.SENTIMENT_FEATURES, 4)


# Prices ----------------------------------------------------------------------------------------

@query("join_price_sentiment", f"""
WITH {SQL_FEATURES.strip()} SELECT p.symbol, p.date, close, {', '.join(
    sql_round(f'coalesce("{c}", 0)', f'"{c}"', 4) for c in series.SENTIMENT_FEATURES)}
FROM prices_v p LEFT JOIN daily_features f ON p.symbol = f.symbol AND p.date = f.date""",
       "senti_v prices_v")
def join_price_sentiment(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v").select("symbol", "date", "close")
    joined = series.join_sentiment(prices, features(spark, d))
    return rounded(joined, series.SENTIMENT_FEATURES, 4)


@query("join_ohlcv", """
SELECT s.symbol, s.date, s.close, open, high, low, volume
FROM (SELECT symbol, date, close FROM prices_v) s
LEFT JOIN (SELECT * FROM prices_v WHERE volume > 1) p ON p.symbol = s.symbol AND p.date = s.date""",
       "prices_v")
def join_ohlcv(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v")
    closes = prices.select("symbol", "date", "close")
    return series.join_ohlcv(closes, prices.filter("volume > 1"))


SQL_GRID = """
days AS (SELECT symbol, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT symbol, min(date) AS a, max(date) AS b FROM prices_v GROUP BY symbol)),
grid AS (SELECT d.symbol, d.date, open, high, low, close, volume
  FROM (SELECT * FROM days WHERE isodow(date) < 6) d
  LEFT JOIN prices_v p ON p.symbol = d.symbol AND p.date = d.date)"""


@query("business_day_grid", f"""
WITH {SQL_GRID.strip()} SELECT symbol, date, open, close, volume FROM grid""", "prices_v")
def business_day_grid(spark, d) -> DataFrame:
    return series.business_days(view(spark, d, "prices_v"), ["symbol"]).select(
        "symbol", "date", "open", "close", "volume")


SQL_FILLED = f"""{SQL_GRID.strip()},
filled AS (SELECT symbol, date, {', '.join(
    f"last_value({c} IGNORE NULLS) {_DAYS} ROWS UNBOUNDED PRECEDING) AS {c}"
    for c in ('open', 'high', 'low', 'close', 'volume'))} FROM grid)"""


def filled(spark, d) -> DataFrame:
    return series.filled_grid(view(spark, d, "prices_v"), ["open", "high", "low", "close", "volume"])


@query("forward_fill", f"""
WITH {SQL_FILLED} SELECT symbol, date, open, high, low, close, volume FROM filled""", "prices_v")
def forward_fill(spark, d) -> DataFrame:
    return filled(spark, d)


@query("make_sequences", f"""
WITH {SQL_DAILY.strip()}, j AS (SELECT p.symbol, p.date, close,
  coalesce(avg_positive, 0) AS avg_positive
  FROM prices_v p LEFT JOIN daily s ON p.symbol = s.symbol AND p.date = s.date),
n AS (SELECT symbol, date, close AS y, row_number() {_DAYS}) AS r,
  {', '.join(f"lag(close, {5 - i}) {_DAYS}) AS close_{i}" for i in range(5))},
  {', '.join(f"lag(avg_positive, {5 - i}) {_DAYS}) AS p_{i}" for i in range(5))} FROM j)
SELECT symbol, date, y, {', '.join(f'close_{i}' for i in range(5))},
  {', '.join(sql_round(f'p_{i}', f'positive_{i}') for i in range(5))} FROM n WHERE r > 5""",
       "senti_v prices_v")
def make_sequences(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v").select("symbol", "date", "close")
    joined = series.join_sentiment(prices, daily(spark, d).select("symbol", "date", "avg_positive"))
    rows = series.sequences(joined, ["close", "avg_positive"], "close", 5)
    return rows.select(
        "symbol", "date", "y", *[F.col("X")[i][0].alias(f"close_{i}") for i in range(5)],
        *[F.round(F.col("X")[i][1], 6).alias(f"positive_{i}") for i in range(5)])


@query("split_fraction", f"""
SELECT symbol, date, row_number() {_DAYS}) <= floor(count(*) OVER (PARTITION BY symbol) * 0.8::DOUBLE)
  AS is_train FROM prices_v""", "prices_v")
def split_fraction(spark, d) -> DataFrame:
    return series.split_fraction(view(spark, d, "prices_v").select("symbol", "date"))


@query("split_date", """
SELECT symbol, date, close, date <= date '1996-12-31' AS is_train FROM prices_v""", "prices_v")
def split_date(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v").select("symbol", "date", "close")
    return series.split_date(prices, train_end="1996-12-31")


@query("prev_close", f"SELECT symbol, date, close, lag(close) {_DAYS}) AS prev_close FROM prices_v",
       "prices_v")
def prev_close(spark, d) -> DataFrame:
    return series.prev_close(view(spark, d, "prices_v").select("symbol", "date", "close"))


@query("direction_consecutive", f"""
SELECT symbol, date, CAST(sign(close - lag(close) {_DAYS})) AS DOUBLE) AS direction
FROM prices_v WHERE date > date '1996-12-31'""", "prices_v")
def direction_consecutive(spark, d) -> DataFrame:
    test = view(spark, d, "prices_v").filter("date > date '1996-12-31'")
    window = Window.partitionBy("symbol").orderBy("date")
    return test.select("symbol", "date", series.direction("close", window).alias("direction"))


# Crawl index -----------------------------------------------------------------------------------

@query("crawl_frontier", """
SELECT doc_id, link, title FROM index_v i WHERE NOT EXISTS (
  SELECT 1 FROM index_v done WHERE done.category = 'Orders' AND done.link = i.link)""", "index_v")
def crawl_frontier(spark, d) -> DataFrame:
    rows = view(spark, d, "index_v")
    done = rows.filter("category = 'Orders'").select("link")
    return index.frontier(rows.select("doc_id", "link", "title"), done)


@query("index_upsert", """
SELECT date, title, category, link, is_new FROM (SELECT *, row_number() OVER (
    PARTITION BY date, title, category ORDER BY is_new, doc_id) AS r FROM (
  SELECT *, false AS is_new FROM index_v WHERE category IS NULL OR category = 'Orders' UNION ALL
  SELECT *, true AS is_new FROM index_v)) WHERE r = 1""", "index_v")
def index_upsert(spark, d) -> DataFrame:
    # the index so far has two categories; the new crawl lists everything
    rows = view(spark, d, "index_v")
    old = rows.filter("category IS NULL OR category = 'Orders'")
    return index.upsert_index(old, rows, index.PRESS_KEYS, ["doc_id"]).drop("doc_id")


@query("symbol_day_grid", """
SELECT source AS symbol, CAST(unnest(generate_series(date '2025-01-01', date '2025-03-31',
  INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT source FROM documents)""")
def symbol_day_grid(spark, d) -> DataFrame:
    symbols = table(spark, d, "documents").select(F.col("source").alias("symbol")).distinct()
    return index.fan_out(symbols, "2025-01-01", "2025-03-31")


# Reports ---------------------------------------------------------------------------------------

@query("report_sentiment_trend", f"""
WITH {SQL_DAILY.strip()} SELECT symbol, date, news_count,
  {sql_round('avg_positive - avg_negative', 'sentiment')},
  {sql_round(f'avg(avg_positive - avg_negative) {_DAYS} ROWS 6 PRECEDING)', 'trend')} FROM daily""",
       "senti_v")
def report_sentiment_trend(spark, d) -> DataFrame:
    return rounded(report.sentiment_trend(daily(spark, d)), ["sentiment", "trend"])


@query("report_outliers", f"""
SELECT symbol, date, close, {sql_round('z', 'z_score')}, coalesce(abs(z) > 3, false) AS is_outlier
FROM (SELECT *, CASE WHEN count(close) {_DAYS} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) = 20 THEN
  (close - avg(close) {_DAYS} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) /
  nullif(stddev_samp(close) {_DAYS} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0) END AS z
  FROM prices_v)""", "prices_v")
def report_outliers(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v").select("symbol", "date", "close")
    return rounded(report.outliers(prices, "close"), ["z_score"])


@query("report_volume_corr", f"""
WITH {SQL_DAILY.strip()} SELECT s.symbol,
  {sql_round('CASE WHEN isnan(corr(news_count, volume)) THEN NULL ELSE corr(news_count, volume) END',
             'corr')}, count(*) AS days
FROM daily s JOIN prices_v p ON p.symbol = s.symbol AND p.date = s.date GROUP BY s.symbol""",
       "senti_v prices_v")
def report_volume_corr(spark, d) -> DataFrame:
    return rounded(report.volume_corr(daily(spark, d), view(spark, d, "prices_v")), ["corr"])
