"""Report tables: trends, outliers and relations of news to prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators.series import rolling_mean


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; null for a constant column, where `corr` would raise."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    spread = F.stddev_samp(a) * F.stddev_samp(b)
    varies = (F.min(a) != F.max(a)) & (F.min(b) != F.max(b))
    return F.when(varies, F.try_divide(F.covar_samp(a, b), spread))


def sentiment_trend(daily: DataFrame, k: int = 7) -> DataFrame:
    """Daily sentiment per symbol with its mean over the last `k` days with news."""
    window = Window.partitionBy("symbol").orderBy("date")
    level = daily.select("symbol", "date", "news_count",
                         (F.col("avg_positive") - F.col("avg_negative")).alias("sentiment"))
    return level.withColumn("trend", rolling_mean("sentiment", k, window))


def sentiment_vs_prediction(daily: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions with the sentiment of their symbol and day; 0 where there was no news."""
    level = daily.select("symbol", "date",
                         (F.col("avg_positive") - F.col("avg_negative")).alias("sentiment"))
    return predictions.join(level, ["symbol", "date"], "left").fillna(0.0, ["sentiment"])


def outliers(df: DataFrame, column: str, k: int = 20, z: float = 3.0) -> DataFrame:
    """Add the z-score against the `k` rows before (null until there are `k`) and `is_outlier`."""
    past = Window.partitionBy("symbol").orderBy("date").rowsBetween(-k, -1)
    mean, spread = F.avg(column).over(past), F.stddev_samp(column).over(past)
    full = F.count(column).over(past) == k
    score = F.when(full, F.try_divide(F.col(column) - mean, spread))
    return (df.withColumn("z_score", score)
            .withColumn("is_outlier", F.coalesce(F.abs("z_score") > z, F.lit(False))))


def volume_corr(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Correlation of the number of news with the trading volume per symbol."""
    both = daily.join(prices.select("symbol", "date", "volume"), ["symbol", "date"])
    return both.groupBy("symbol").agg(correlation("news_count", "volume").alias("corr"),
                                      F.count("*").alias("days"))
