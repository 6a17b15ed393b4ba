"""Ordered series per key: lags, rolling features, fills, sequences and splits.

Series of at most one row per key and calendar day are small per key by nature; for them a plain
window is right (`daily=True`). A table of articles has no such bound: one symbol may hold a third
of all rows. There the rows of every key are cut into buckets of time, each with a copy of the
few rows before it, and every bucket is a group of its own. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000
Step = Callable[[WindowSpec], dict[str, Column]]


def attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table of one row per key; null keys match each other.

    No hint: a small table is broadcast when its size is known at run time, a large one is not.
    """
    named = stats.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return df.join(named, match, "left").drop(*[f"_key_{k}" for k in keys])


def _buckets(df: DataFrame, order: list[str], block_rows: int) -> Column:
    """Parts of a key that follow each other in `order`: days, and blocks of an integer last column.

    A value of an integer that is unique within the key stands for one row, so a bucket has `block_rows` rows at
    most, however many fall on a day.
    """
    types = dict(df.dtypes)
    first = F.to_date(order[0]) if types[order[0]].startswith("timestamp") else F.col(order[0])
    parts = [first.alias("first")]
    if len(order) > 1 and types[order[-1]] in ("bigint", "int", "smallint", "tinyint"):
        parts += [F.col(c).alias(f"then{i}") for i, c in enumerate(order[1:-1])]
        parts.append(F.floor(F.col(order[-1]) / block_rows).alias("block"))
    return F.struct(*parts)


def over_rows(df: DataFrame, keys: list[str], order: list[str], steps: list[Step], before: int,
              daily: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add window columns that look at most `before` rows back.

    Each step gets the window and returns columns; later steps see the columns of earlier ones, and
    `before` must cover the whole chain. `daily` says that a key has one row per day at most. In all other
    series every bucket (see `_buckets`) is a group of its own, with a copy of the `before` rows that precede it. Those
    are among the last rows of the `before` buckets before it; the last rows of a bucket are found with a
    limit that tasks apply before they send anything. `order` must be unique within a key. Without an order there
    is no result, so it is required.
    """
    if not order:
        raise ValueError("an order is required: rows of a table have none of their own")
    if daily:
        window = Window.partitionBy(*keys).orderBy(*order)
        for step in steps:
            df = df.withColumns(step(window))
        return df
    rows = df.withColumn("_bucket", _buckets(df, order, block_rows))
    bucket = Window.partitionBy(*keys, "_bucket")
    last = (rows.withColumn("_back", F.row_number().over(bucket.orderBy(*[F.desc(c) for c in order])))
            .filter(F.col("_back") <= before))
    ends = last.groupBy(*keys, "_bucket").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("_back")).alias("back"), F.struct(*df.columns).alias("row")))).alias("end"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(-before, -1)
    ends = ends.select("_bucket", F.flatten(F.collect_list("end").over(earlier)).alias("end"))
    start = F.greatest(F.size("end") - before + 1, F.lit(1))
    copies = ends.select("_bucket", F.explode(F.slice("end", start, before)).alias("end"))
    out = (rows.withColumn("_home", F.lit(True))
           .unionByName(copies.select("end.row.*", "_bucket", F.lit(False).alias("_home"))))
    for step in steps:
        out = out.withColumns(step(bucket.orderBy(*order)))
    return out.filter("_home").drop("_bucket", "_home")


# Columns over a window ------------------------------------------------------------------------

def rolling_mean(col, k: int, window: WindowSpec) -> Column:
    """Mean of the last `k` rows, of fewer at the start."""
    return F.avg(col).over(window.rowsBetween(1 - k, 0))


def rolling_std(col, k: int, window: WindowSpec) -> Column:
    """Sample standard deviation of the last `k` rows; 0 for a single value."""
    return F.coalesce(F.stddev_samp(col).over(window.rowsBetween(1 - k, 0)), F.lit(0.0))


def diff(col, window: WindowSpec) -> Column:
    """Difference to the previous row, 0 for the first."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col - F.lag(col, 1).over(window), F.lit(0.0))


def pct_change(col, window: WindowSpec) -> Column:
    """Relative change to the previous row, 0 for the first; infinite from a zero base."""
    col = F.col(col) if isinstance(col, str) else col
    base = F.lag(col, 1).over(window)
    infinite = F.when(col > 0, F.lit(float("inf"))).when(col < 0, F.lit(float("-inf")))
    return F.coalesce(F.when(base == 0, infinite).otherwise(F.try_divide(col - base, base)),
                      F.lit(0.0))


def forward_fill(col, window: WindowSpec) -> Column:
    """The last value that is not null."""
    return F.last(col, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))


def direction(col, window: WindowSpec) -> Column:
    """Sign of the change from the previous row; null for the first."""
    col = F.col(col) if isinstance(col, str) else col
    return F.signum(col - F.lag(col, 1).over(window))


# Operators ------------------------------------------------------------------------------------

def daily_sentiment(df: DataFrame) -> DataFrame:
    """Mean probabilities and number of news per symbol and day."""
    return df.groupBy("symbol", "date").agg(
        F.avg("positive_prob").alias("avg_positive"),
        F.avg("neutral_prob").alias("avg_neutral"),
        F.avg("negative_prob").alias("avg_negative"),
        F.count("*").alias("news_count"),
    )


DAILY_COLUMNS = ["avg_positive", "avg_neutral", "avg_negative", "news_count"]


def add_lags(df: DataFrame, columns: list[str] = DAILY_COLUMNS, keys: list[str] = ["symbol"],
             order: list[str] = ["date"], n: int = 1, daily: bool = True) -> DataFrame:
    """Add `lag_<column>`, the value `n` rows earlier. All lags share one window."""
    def lags(window: WindowSpec) -> dict[str, Column]:
        return {f"lag_{c}": F.lag(c, n).over(window) for c in columns}
    return over_rows(df, keys, order, [lags], n, daily)


# Names of the article features.
SENTIMENT_FEATURES = [
    "Sentiment", "Sentiment_Diff", "Sentiment_Volatility", "Sentiment_MA5", "Sentiment_Change",
    "Sentiment_Volatility_MA5", "Neutral", "Neutral_Diff", "Neutral_Volatility", "Neutral_MA5",
]


def sentiment_features(df: DataFrame, keys: list[str], order: list[str],
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the ten rolling features of scored articles, in `order` within `keys`.

    The longest chain is a mean of five over a mean of three: six rows back.
    """
    def level(window: WindowSpec) -> dict[str, Column]:
        raw = F.col("finbert_positive") - F.col("finbert_negative")
        rest = 1 - (F.col("finbert_positive") + F.col("finbert_negative"))
        given = F.coalesce("finbert_neutral", rest) if "finbert_neutral" in df.columns else rest
        return {"Sentiment": rolling_mean(raw, 3, window), "Neutral": given}

    def shape(window: WindowSpec) -> dict[str, Column]:
        return {
            "Sentiment_Diff": diff("Sentiment", window),
            "Sentiment_Volatility": rolling_std("Sentiment", 3, window),
            "Sentiment_MA5": rolling_mean("Sentiment", 5, window),
            "Sentiment_Change": pct_change("Sentiment", window),
            "Sentiment_Volatility_MA5": rolling_std("Sentiment", 5, window),
            "Neutral_Diff": diff("Neutral", window),
            "Neutral_Volatility": rolling_std("Neutral", 3, window),
            "Neutral_MA5": rolling_mean("Neutral", 5, window),
        }

    return over_rows(df, keys, order, [level, shape], 6, block_rows=block_rows)


def daily_feature_mean(df: DataFrame, features: list[str] = SENTIMENT_FEATURES) -> DataFrame:
    """Mean of the article features per symbol and day."""
    return df.groupBy("symbol", "date").agg(*[F.avg(c).alias(c) for c in features])


def join_sentiment(prices: DataFrame, daily: DataFrame, fill: float = 0.0) -> DataFrame:
    """Prices with the daily features of their symbol and date; `fill` where there was no news."""
    features = [c for c in daily.columns if c not in ("symbol", "date")]
    return prices.join(daily, ["symbol", "date"], "left").fillna(fill, subset=features)


def join_ohlcv(df: DataFrame, ohlcv: DataFrame) -> DataFrame:
    """Add open, high, low and volume of the same symbol and date."""
    return df.join(ohlcv.select("symbol", "date", "open", "high", "low", "volume"),
                   ["symbol", "date"], "left")


def business_days(df: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Series on a grid of all weekdays from its first to its last day; weekend rows drop out."""
    span = df.groupBy(*keys).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    grid = (span.select(*keys, F.explode(F.sequence("_from", "_to")).alias(date))
            .filter(F.weekday(date) < 5))
    return grid.join(df, [*keys, date], "left")


def filled_grid(df: DataFrame, columns: list[str], keys: list[str] = ["symbol"],
                date: str = "date") -> DataFrame:
    """Business-day grid with the last known values carried forward."""
    window = Window.partitionBy(*keys).orderBy(date)
    return business_days(df, keys, date).withColumns(
        {c: forward_fill(c, window) for c in columns})


def sequences(df: DataFrame, features: list[str], target: str, window: int = 5,
              keys: list[str] = ["symbol"], order: list[str] = ["date"]) -> DataFrame:
    """For every row with `window` rows before it: those rows as `X` and the target as `y`.

    `X` is an array of `window` arrays of features, oldest first. A daily series is expected. The
    struct keeps null features in place.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    row = F.struct(F.array(*[F.col(c).cast("double") for c in features]).alias("f"))
    steps = F.collect_list(row).over(w.rowsBetween(-window, -1))
    return (df.select("*", steps.alias("_steps"), F.col(target).cast("double").alias("y"))
            .filter(F.size("_steps") == window)
            .withColumn("X", F.col("_steps.f")).drop("_steps"))


def split_fraction(df: DataFrame, keys: list[str] = ["symbol"], order: list[str] = ["date"],
                   fraction: float = 0.8) -> DataFrame:
    """Add `is_train`: the first `fraction` of every daily series by order."""
    w = Window.partitionBy(*keys)
    number = F.row_number().over(w.orderBy(*order))
    total = F.count("*").over(w)
    return df.withColumn("is_train", number <= F.floor(total * F.lit(fraction)))


def split_date(df: DataFrame, column: str = "date", train_end="2023-12-31") -> DataFrame:
    """Add `is_train`: rows up to `train_end`."""
    return df.withColumn("is_train", F.col(column) <= F.lit(train_end).cast("date"))


def prev_close(df: DataFrame, column: str = "close", keys: list[str] = ["symbol"],
               order: list[str] = ["date"]) -> DataFrame:
    """Add the close of the previous row of the daily series."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("prev_close", F.lag(column, 1).over(w))
