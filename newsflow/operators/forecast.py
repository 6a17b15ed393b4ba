"""Autoregressive forecasts and regressions on sequences, a model per symbol.

The autoregression is fitted by conditional least squares on the differenced series, without a
constant unless asked for; exogenous columns enter differenced as further regressors. That is close
to, but not the same as, exact maximum likelihood of a regression with autoregressive errors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import linear
from newsflow.operators import prep, series
from newsflow.session import written

OK = "ok"


def differenced(df: DataFrame, columns: list[str], d: int = 1) -> DataFrame:
    """Add `d_<column>`, the `d`-th difference by date within the symbol, and the row number `_t`."""
    w = Window.partitionBy("symbol").orderBy("date")
    df = df.withColumn("_t", F.row_number().over(w))
    names = [f"d_{c}" for c in columns]
    df = df.withColumns({n: F.col(c).cast("double") for n, c in zip(names, columns)})
    for _ in range(d):
        df = df.withColumns({n: F.col(n) - F.lag(n, 1).over(w) for n in names})
    return df


def regression_rows(df: DataFrame, target: str = "close", p: int = 5, d: int = 1,
                    exog: list[str] = [], fraction: float = 0.8,
                    intercept: bool = False) -> DataFrame:
    """Add the training flag and the regressors `_u` of every row of a daily series.

    The regressors are 1 (with `intercept`), the `p` differences before, and the differenced
    exogenous columns of the same day. Two rows of a symbol on one day are an error.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    twice = F.raise_error(F.concat_ws(" ", F.lit("more than one row of"), "symbol", F.lit("on"),
                                      F.col("date").cast("string"))).cast("double")
    once = F.when(F.col("date") == F.lag("date").over(w), twice).otherwise(F.col(target).cast("double"))
    rows = differenced(series.split_fraction(df.withColumn(target, once), fraction=fraction), [target, *exog], d)
    lags = [F.lag(f"d_{target}", i).over(w) for i in range(1, p + 1)]
    constant = [F.lit(1.0)] if intercept else []
    return rows.withColumn("_u", F.array(*constant, *lags, *[F.col(f"d_{c}") for c in exog]))


def _sums(size: int, target: str) -> list[Column]:
    """Aggregates over the training rows: sums of products (upper triangle), with the target, and their number."""
    whole = (F.col("is_train") & F.col(f"d_{target}").isNotNull() & ~F.exists("_u", lambda u: u.isNull()))
    u, z = F.col("_u"), F.col(f"d_{target}")

    def total(product: Column) -> Column:
        return F.coalesce(F.sum(F.when(whole, product)), F.lit(0.0))

    return [F.array(*[total(u[i] * u[j]) for i in range(size) for j in range(i, size)]).alias("gram"),
            F.array(*[total(u[i] * z) for i in range(size)]).alias("moment"),
            F.count(F.when(whole, True)).alias("n")]


def normal_equations(rows: DataFrame, size: int, target: str = "close") -> DataFrame:
    """Sums of products of the training rows per symbol: one aggregate, one row per symbol."""
    return rows.groupBy("symbol").agg(*_sums(size, target))


def coefficients(equations: DataFrame, size: int) -> DataFrame:
    """Solve the normal equations of `size` regressors by elimination; adds `coef` and `status`.

    A symbol that cannot be fitted keeps its row, with a status and no coefficients.
    """
    few = F.col("n") <= size
    status = (F.when(few, F.concat(F.lit("too few rows: "), F.col("n").cast("string")))
              .when(~linear.finite(F.col("coef")), "no finite solution").otherwise(OK))
    return (equations.withColumn("coef", linear.solve(F.col("gram"), F.col("moment"), size))
            .withColumn("status", status)
            .withColumn("coef", F.when(F.col("status") == OK, F.col("coef"))))


def fit_ar(df: DataFrame, p: int = 5, d: int = 1, fraction: float = 0.8, exog: list[str] = [],
           model: str = "AR", target: str = "close", intercept: bool = False) -> DataFrame:
    """Multi-step forecast of the last part of every daily series from a fit on its first part.

    Returns symbol, date, model, actual, predicted, prev_close, status. Rows without the target, as on
    the days of a grid before the first price, are left out before the split. Predictions feed on earlier
    predictions: the recursion is a fold over the test days of a symbol, which has one row per business
    day at most. One failing symbol gets a status and no predictions.
    """
    size = int(intercept) + p + len(exog)
    rows = regression_rows(df.filter(F.col(target).isNotNull()), target, p, d, exog, fraction, intercept)
    w = Window.partitionBy("symbol").orderBy("date")
    rows = rows.withColumn("prev_close", F.lag(target, 1).over(w)).withColumn("_level0", F.col(target))
    for k in range(1, d):
        rows = rows.withColumn(f"_level{k}", F.col(f"_level{k - 1}") - F.lag(f"_level{k - 1}", 1).over(w))
    recent = F.array(*[F.lag(f"d_{target}", i).over(w) for i in range(p)]).cast("array<double>")
    rows = rows.withColumn("_start", F.struct(
        F.array(*[F.col(f"_level{k}") for k in range(d)]).cast("array<double>").alias("levels"),
        recent.alias("recent")))
    day = F.struct("date", F.col(target).alias("actual"), "prev_close",
                   F.array(*[F.col(f"d_{c}") for c in exog]).cast("array<double>").alias("exog"))
    test = F.collect_list(F.when(~F.col("is_train"), day))
    # one row per symbol; the windows have put a symbol's rows together already
    fitted = coefficients(rows.groupBy("symbol").agg(
        *_sums(size, target), F.array_sort(test).alias("test"),
        F.max_by(F.when(F.col("is_train"), F.col("_start")), F.when(F.col("is_train"), F.col("_t"))).alias("start")),
        size)
    start = F.col("start")
    steps = F.transform("test", lambda t: t["exog"])
    path = linear.recursion(steps, start["levels"], start["recent"], F.col("coef"), p, d, intercept)
    status = (F.when(F.col("status") != OK, F.col("status"))
              .when(~linear.finite(F.concat(start["levels"], start["recent"])), "too few rows before the test span")
              .when(~linear.finite(F.col("path")), "forecast not finite").otherwise(OK))
    done = (fitted.withColumn("path", F.when(F.col("status") == OK, path)).withColumn("status", status)
            .select("symbol", "status", "path", F.posexplode("test").alias("place", "t")))
    return done.select(
        "symbol", "t.date", F.lit(model).alias("model"), "t.actual",
        F.when(F.col("status") == OK, F.get("path", F.col("place"))).alias("predicted"), "t.prev_close", "status")


# Regression on sequences, one per symbol ------------------------------------------------------------

COMPARED = ("symbol string, date date, model string, actual double, predicted double, "
            "prev_close double, features string, status string")


def _regression(train: np.ndarray, y: np.ndarray, test: np.ndarray, ridge: float) -> tuple:
    """Predictions for `test` of a least-squares fit with a constant, and its status."""
    if len(train) <= train.shape[1] + 1:
        return None, f"too few rows: {len(train)}"
    u = np.column_stack([np.ones(len(train)), train])
    weight = ridge * np.eye(u.shape[1])
    weight[0, 0] = 0  # the constant is not drawn to 0
    try:
        found = np.linalg.lstsq(u.T @ u + len(u) * weight, u.T @ y, rcond=1e-12)[0]
    except np.linalg.LinAlgError as problem:
        return None, f"no solution: {problem}"
    predicted = np.column_stack([np.ones(len(test)), test]) @ found
    return (predicted, OK) if np.isfinite(predicted).all() else (None, "forecast not finite")


def compare_regressors(df: DataFrame, feature_sets: dict[str, list[str]], window: int = 5,
                       target: str = "close", noise: dict[str, float] | None = None,
                       selected: list[str] | None = None, ridge: float = 1e-6) -> DataFrame:
    """Next-value predictions of a regression per symbol and feature set, on the test rows.

    `df` is a daily series with `is_train`. Sequences are cut within the training and the test part and
    scaled by the training part of their symbol; predictions are scaled back. Models named in
    `selected` use, besides the target, the features of their set that `prep.select_features` picks on
    the training rows of the symbol; models in `noise` are trained on a disturbed copy of their
    sequences as well. A symbol that cannot be fitted keeps its rows, with a status and no predictions.

    A symbol has one row per day, so its series is small, and every symbol is a group of its own.
    """
    keys = ["symbol", "is_train"]
    w = Window.partitionBy(*keys).orderBy("date")
    # every model reads the series several times, so it is computed once
    based = written(df.withColumn("prev_close", F.lag(target, 1).over(w)), "regression")
    outputs = []
    for model, features in feature_sets.items():
        scaled = prep.scale_sequences(series.sequences(based, features, target, window, keys), len(features))
        rows = scaled.select("symbol", "date", "is_train", "X", "y", "y_min", "y_max", "prev_close")
        if noise and model in noise:
            extra = prep.noisy_sequences(rows.filter("is_train"), noise[model])
            rows = rows.unionByName(extra)
        if selected and model in selected:
            others = [f for f in features if f != target]
            picked = (prep.select_features(based.filter("is_train"), others, target).groupBy("symbol")
                      .agg(F.collect_set("feature").alias("picked")))
            rows = series.attach(rows, picked, ["symbol"])
        else:
            rows = rows.withColumn("picked", F.array(*[F.lit(f) for f in features]))
        outputs.append(rows.groupBy("symbol").applyInPandas(
            _symbol_regression(model, features, ridge), COMPARED))
    out = outputs[0]
    for more in outputs[1:]:
        out = out.unionByName(more)
    return out


def _symbol_regression(model: str, features: list[str], ridge: float):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date", kind="stable")
        picked = pdf["picked"].iloc[0]
        names = [f for f in features if picked is not None and f in set(picked)]
        columns = [features.index(f) for f in names]
        test = pdf[~pdf["is_train"]]

        def flat(rows: pd.DataFrame) -> np.ndarray:
            values = [[step[c] for step in x for c in columns] for x in rows["X"]]
            return np.array(values, dtype=float).reshape(len(rows), -1)

        train = pdf[pdf["is_train"]]
        x, y = flat(train), train["y"].to_numpy(float)
        whole = np.isfinite(x).all(axis=1) & np.isfinite(y)
        predicted, status = _regression(x[whole], y[whole], flat(test), ridge) if len(test) else (None, OK)
        spread = (test["y_max"] - test["y_min"]).where(test["y_max"] != test["y_min"], 1.0)
        back = None if predicted is None else (predicted * spread + test["y_min"]).astype(float)
        return pd.DataFrame({
            "symbol": test["symbol"], "date": test["date"], "model": model,
            "actual": (test["y"] * spread + test["y_min"]).astype(float), "predicted": back,
            "prev_close": test["prev_close"], "features": ", ".join(names), "status": status})
    return fit
