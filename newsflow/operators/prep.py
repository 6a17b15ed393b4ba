"""Preparation for models: scaling fitted on training rows, feature selection, augmentation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators.report import correlation
from newsflow.operators.series import attach

# Features kept by the correlation filter and its threshold.
TOP_FEATURES = 6
MIN_CORRELATION = 0.1


def _scaled(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); a constant column is divided by 1."""
    spread = high - low
    return (value - low) / F.when(spread == 0, 1.0).otherwise(spread)


def unscaled(value: Column, low: Column, high: Column) -> Column:
    """Inverse of the scaling."""
    spread = high - low
    return value * F.when(spread == 0, 1.0).otherwise(spread) + low


def minmax_scale(df: DataFrame, columns: list[str], keys: list[str] = ["symbol"],
                 train: str = "is_train") -> DataFrame:
    """Scale columns to [0, 1] by the range of the training rows of each key.

    Adds `<column>_min` and `<column>_max` for the way back. Test rows may leave [0, 1].
    """
    stats = df.filter(F.col(train)).groupBy(*keys).agg(
        *[F.min(c).alias(f"{c}_min") for c in columns],
        *[F.max(c).alias(f"{c}_max") for c in columns])
    return attach(df, stats, keys).withColumns(
        {c: _scaled(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")) for c in columns})


def scale_sequences(df: DataFrame, size: int, keys: list[str] = ["symbol"],
                    train: str = "is_train") -> DataFrame:
    """Scale sequences `X` (arrays of `size` features) and targets `y` by the training ones.

    Every feature has one range over all steps. Adds `y_min` and `y_max` for the way back.
    """
    def ends(i: int) -> list[Column]:
        values = F.transform("X", lambda step: step[i])
        return [F.min(F.array_min(values)).alias(f"_min{i}"),
                F.max(F.array_max(values)).alias(f"_max{i}")]

    stats = df.filter(F.col(train)).groupBy(*keys).agg(
        *[c for i in range(size) for c in ends(i)],
        F.min("y").alias("y_min"), F.max("y").alias("y_max"))
    joined = attach(df, stats, keys)
    steps = F.transform("X", lambda step: F.array(*[
        _scaled(step[i], F.col(f"_min{i}"), F.col(f"_max{i}")) for i in range(size)]))
    return (joined.withColumn("X", steps)
            .withColumn("y", _scaled(F.col("y"), F.col("y_min"), F.col("y_max")))
            .drop(*[f"_{end}{i}" for i in range(size) for end in ("min", "max")]))


def select_features(df: DataFrame, candidates: list[str], target: str = "close",
                    keys: list[str] = ["symbol"], top: int = TOP_FEATURES,
                    threshold: float = MIN_CORRELATION) -> DataFrame:
    """Features per key, one row each: `rank`, `feature`, `abs_corr`.

    The target comes first with rank 0, then the `top` candidates with an absolute correlation to
    it of at least `threshold`; all candidates in their order if there is none. Correlations come
    out of one aggregate over the rows; only its result, one row per key, is unpivoted.
    """
    wide = df.groupBy(*keys).agg(*[
        F.abs(F.nanvl(correlation(c, target), F.lit(None))).alias(c) for c in candidates])
    place = F.create_map(*[F.lit(x) for i, c in enumerate(candidates) for x in (c, i)])
    long = wide.unpivot(keys, candidates, "feature", "abs_corr")
    long = long.withColumn("_place", place[F.col("feature")])
    passes = F.coalesce(F.col("abs_corr") >= threshold, F.lit(False))
    per_key = Window.partitionBy(*keys)
    long = long.withColumn("_any", F.max(passes).over(per_key)).filter(passes | ~F.col("_any"))
    order = [F.when(F.col("_any"), -F.col("abs_corr")), F.col("_place")]
    ranked = long.withColumn("rank", F.row_number().over(per_key.orderBy(*order)))
    chosen = ranked.filter((F.col("rank") <= top) | ~F.col("_any"))
    first = wide.select(*keys, F.lit(0).alias("rank"), F.lit(target).alias("feature"),
                        F.lit(None).cast("double").alias("abs_corr"))
    return chosen.select(*keys, "rank", "feature", "abs_corr").unionByName(first)


def row_noise(*parts: Column | str) -> Column:
    """A standard normal value that depends on the texts of `parts` only (Box-Muller on their hash).

    The same row gets the same noise whatever its partition, so a task that is run again gives the same
    rows.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]))

    def uniform(first: int) -> Column:
        return (F.conv(F.substring(digest, first, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)

    return F.sqrt(-2 * F.log(uniform(1))) * F.cos(2 * math.pi * uniform(13))


def augment_noise(df: DataFrame, columns: list[str], keys: list[str], std: float = 0.01,
                  seed: int = 42) -> DataFrame:
    """The rows and a copy of each with normal noise on `columns`; `is_noisy` tells them apart.

    `keys` name a row.
    """
    named = [F.col(k).cast("string") for k in keys]
    noisy = df.withColumns({c: F.col(c) + row_noise(*named, F.lit(c), F.lit(str(seed))) * std
                            for c in columns})
    return (df.withColumn("is_noisy", F.lit(False))
            .unionByName(noisy.withColumn("is_noisy", F.lit(True))))


def noisy_sequences(df: DataFrame, std: float = 0.01, seed: int = 42,
                    keys: list[str] = ["symbol", "date"]) -> DataFrame:
    """`df` with normal noise on every value of the sequences `X`."""
    named = [F.col(k).cast("string") for k in keys]
    return df.withColumn("X", F.transform("X", lambda step, i: F.transform(step, lambda v, j: (
        v + row_noise(*named, i.cast("string"), j.cast("string"), F.lit(str(seed))) * std))))


def augment_sequences(df: DataFrame, std: float = 0.01, seed: int = 42,
                      keys: list[str] = ["symbol", "date"]) -> DataFrame:
    """The rows and a copy of each with noise on its sequences."""
    return df.unionByName(noisy_sequences(df, std, seed, keys))
