"""Series operators against pandas and numpy, and the block way against the plain window."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from newsflow.operators import series

DAY = dt.date(2025, 3, 3)


def days(spark, values, column="x"):
    return spark.createDataFrame([("A", DAY + dt.timedelta(i), v) for i, v in enumerate(values)],
                                 f"symbol string, date date, {column} double")


def column(df, name):
    return [r[name] for r in df.orderBy("symbol", "date").collect()]


def by_date():
    return Window.partitionBy("symbol").orderBy("date")


def test_rolling_with_gap(spark):
    df = days(spark, [1.0, None, 3.0, 6.0]).withColumns({
        "m": series.rolling_mean("x", 3, by_date()), "s": series.rolling_std("x", 3, by_date())})
    assert column(df, "m") == [1, 1, 2, 4.5]
    assert column(df, "s") == pytest.approx([0, 0, 2 ** 0.5, 4.5 ** 0.5])


def test_pct_change_and_diff(spark):
    df = days(spark, [0.0, 0.0, 2.0, 1.0, 0.0, -3.0]).withColumns({
        "p": series.pct_change("x", by_date()), "d": series.diff("x", by_date())})
    assert column(df, "p") == [0, 0, float("inf"), -0.5, -1, float("-inf")]
    assert column(df, "d") == [0, 0, 2, -1, -1, -3]


def test_business_days_of_a_month(spark):
    df = spark.createDataFrame([("A", dt.date(2025, 3, 1), 1.0), ("A", dt.date(2025, 3, 31), 2.0)],
                               "symbol string, date date, close double")
    grid = series.business_days(df, ["symbol"])
    assert grid.count() == 21
    assert grid.filter("close IS NOT NULL").count() == 1  # the first is a Saturday


def test_forward_fill(spark):
    df = days(spark, [None, 1.0, None, 2.0, None]).withColumn("f", series.forward_fill("x", by_date()))
    assert column(df, "f") == [None, 1, 1, 2, 2]


def test_sequences(spark):
    df = days(spark, [float(i) for i in range(8)])
    got = series.sequences(df, ["x"], "x", 5).orderBy("date").collect()
    assert [(r.X, r.y) for r in got] == [
        ([[float(i + j)] for j in range(5)], float(i + 5)) for i in range(3)]
    assert series.sequences(days(spark, [1.0] * 5), ["x"], "x", 5).isEmpty()


def test_sequences_keep_null_features_in_place(spark):
    got = series.sequences(days(spark, [1.0, None, 3.0]), ["x"], "x", 2).collect()
    assert got[0].X == [[1.0], [None]]


@pytest.mark.parametrize("n", [1, 5, 10, 11])
def test_split_fraction(spark, n):
    df = series.split_fraction(days(spark, [1.0] * n))
    assert df.filter("is_train").count() == int(n * 0.8)


def test_direction_and_prev_close(spark):
    df = series.prev_close(days(spark, [1.0, 3.0, 2.0], "close"))
    assert column(df, "prev_close") == [None, 1, 3]
    assert column(df.withColumn("d", series.direction("close", by_date())), "d") == [None, 1, -1]


@pytest.fixture(scope="module")
def articles(spark):
    """One symbol with most rows, one key that is null, and days with very many articles."""
    rng = np.random.default_rng(1)
    n = 700
    pdf = pd.DataFrame({
        "event_id": rng.permutation(n),
        "symbol": rng.choice(["A", "A", "A", "A", "B", None], n),
        "day": np.where(rng.random(n) < 0.5, 3, rng.integers(0, 30, n)),
        "finbert_positive": rng.random(n), "finbert_negative": rng.random(n)})
    df = spark.createDataFrame(pdf.astype({"symbol": object}).where(pdf.notna(), None),
                               "event_id long, symbol string, day int, finbert_positive double, "
                               "finbert_negative double")
    return df.select("*", F.date_add(F.lit(DAY), F.col("day")).alias("date")).drop("day")


KEYS, ORDER = ["symbol"], ["date", "event_id"]


def collected(df):
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    return sorted(rows, key=lambda r: r[columns.index("event_id")])


def first_of_six(window):
    return {"first": F.first("event_id").over(window.rowsBetween(-6, 0)), "n": F.count("*").over(window.rowsBetween(-6, 0)),
            "back": F.lag("date", 6).over(window)}


@pytest.mark.parametrize("block_rows", [1, 6, 7, 50, 10_000])
def test_buckets_equal_plain_window(spark, articles, block_rows):
    late = articles.limit(20).select((F.col("event_id") + 1000).alias("event_id"), "symbol", "finbert_positive",
                                     "finbert_negative", F.lit(None).cast("date").alias("date"))
    articles = articles.unionByName(late)
    plain = series.over_rows(articles, KEYS, ORDER, [first_of_six], 6, daily=True)
    buckets = series.over_rows(articles, KEYS, ORDER, [first_of_six], 6, block_rows=block_rows)
    assert collected(plain) == collected(buckets)
    one, many = (series.sentiment_features(articles, KEYS, ORDER, n) for n in (10_000, block_rows))
    for a, b in zip(collected(one), collected(many), strict=True):
        assert a == pytest.approx(b, nan_ok=True)


def test_buckets_of_sparse_times(spark):
    rows = [("A", dt.datetime(2025, 3, 1 + i * 3, i), i) for i in range(9)] + [("B", None, 1)]
    df = spark.createDataFrame(rows, "symbol string, date timestamp, event_id long")
    plain = series.over_rows(df, KEYS, ["date"], [first_of_six], 6, daily=True)
    assert collected(series.over_rows(df, KEYS, ["date"], [first_of_six], 6)) == collected(plain)


@pytest.mark.parametrize("partitions", ["1", "2", "17"])
def test_partition_count_does_not_matter(spark, articles, partitions):
    want = collected(series.sentiment_features(articles, KEYS, ORDER, 20))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = collected(series.sentiment_features(articles, KEYS, ORDER, 20))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for a, b in zip(want, got, strict=True):
        assert a == pytest.approx(b)


def test_features_equal_pandas(spark, articles):
    pdf = articles.filter("symbol IS NOT NULL").toPandas().sort_values(["symbol", *ORDER])
    raw = pdf["finbert_positive"] - pdf["finbert_negative"]
    by = pdf["symbol"]

    def per_symbol(s, fn):
        return s.groupby(by, sort=False).transform(fn)

    level = per_symbol(raw, lambda x: x.rolling(3, min_periods=1).mean())
    neutral = 1 - (pdf["finbert_positive"] + pdf["finbert_negative"])
    want = pd.DataFrame({
        "Sentiment": level,
        "Sentiment_Diff": per_symbol(level, lambda x: x.diff().fillna(0)),
        "Sentiment_Volatility": per_symbol(level, lambda x: x.rolling(3, min_periods=1).std().fillna(0)),
        "Sentiment_MA5": per_symbol(level, lambda x: x.rolling(5, min_periods=1).mean()),
        "Sentiment_Change": per_symbol(level, lambda x: x.pct_change().fillna(0)),
        "Sentiment_Volatility_MA5": per_symbol(level, lambda x: x.rolling(5, min_periods=1).std().fillna(0)),
        "Neutral": neutral,
        "Neutral_Diff": per_symbol(neutral, lambda x: x.diff().fillna(0)),
        "Neutral_Volatility": per_symbol(neutral, lambda x: x.rolling(3, min_periods=1).std().fillna(0)),
        "Neutral_MA5": per_symbol(neutral, lambda x: x.rolling(5, min_periods=1).mean()),
    }).assign(event_id=pdf["event_id"]).sort_values("event_id")
    got = (series.sentiment_features(articles, KEYS, ORDER, 40).filter("symbol IS NOT NULL")
           .toPandas().sort_values("event_id"))
    for name in series.SENTIMENT_FEATURES:
        np.testing.assert_allclose(got[name].to_numpy(), want[name].to_numpy(), rtol=1e-6, atol=1e-9)


def test_order_is_required(spark, articles):
    with pytest.raises(ValueError):
        series.over_rows(articles, KEYS, [], [], 1)
