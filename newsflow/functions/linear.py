"""Small linear systems as expressions: elimination and recursions as folds over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.binding import let

#: A regressor whose share that earlier ones do not explain is below this gets the coefficient 0.
ALIASED = 1e-10


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def finite(values: Column) -> Column:
    """Whether no value is null, NaN or infinite."""
    return ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def solve(gram: Column, moment: Column, size: int) -> Column:
    """Coefficients of normal equations, of which `gram` has the upper triangle row by row.

    The system is scaled to a unit diagonal and eliminated pivot by pivot, a fold over its rows. A regressor
    that is constant 0 or a combination of earlier ones gets 0.
    """
    place = {}
    for i in range(size):
        for j in range(i, size):
            place[i, j] = place[j, i] = len(set(place.values()))

    def scaled(x: Column) -> Column:
        g, m, s = x["gram"], x["moment"], x["scale"]
        return F.array(*[F.array(*[g[place[i, j]] / (s[i] * s[j]) for j in range(size)], m[i] / s[i])
                         for i in range(size)])

    def eliminate(matrix: Column, k: Column) -> Column:
        row = F.get(matrix, k)
        pivot = F.transform(row, lambda v: F.when(F.get(row, k) > ALIASED, v / F.get(row, k)).otherwise(0.0))
        return let(pivot, lambda p: F.transform(matrix, lambda r, i: F.when(i == k, p).otherwise(
            F.zip_with(r, p, lambda a, b: a - F.get(r, k) * b))))

    def root(g: Column, i: int) -> Column:
        return F.when(g[place[i, i]] > 0, F.sqrt(g[place[i, i]])).otherwise(1.0)

    def found(x: Column) -> Column:
        done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), scaled(x), eliminate)
        return F.zip_with(F.transform(done, lambda r: F.get(r, F.lit(size))), x["scale"], lambda v, s: v / s)

    return let(F.struct(gram.alias("gram"), moment.alias("moment"),
                        F.array(*[root(gram, i) for i in range(size)]).alias("scale")), found)


def recursion(steps: Column, levels: Column, recent: Column, coef: Column, lags: int, order: int,
              intercept: bool = False) -> Column:
    """Forecasts of an autoregression with `lags` lags of the difference of an order, a fold over `steps`.

    A step is the array of its other regressors. `levels` are the last values of the series and of its
    differences below `order`, `recent` the last differences, the latest first. Each forecast difference is a lag of
    the next ones and is summed up to the level.
    """
    constant = [F.lit(1.0)] if intercept else []

    def step(state: Column, other: Column) -> Column:
        terms = F.concat(F.array(*constant, *[state["recent"][i] for i in range(lags)]).cast("array<double>"), other)

        def moved(value: Column) -> Column:
            ends, now = [], value
            for k in reversed(range(order)):
                now = state["levels"][k] + now
                ends.insert(0, now)
            return F.struct(
                F.array(*ends).cast("array<double>").alias("levels"),
                F.slice(F.concat(F.array(value), state["recent"]), 1, lags).alias("recent"),
                F.array_append(state["out"], now).alias("out"))

        return let(F.coalesce(dot(terms, coef), F.lit(float("nan"))), moved)

    start = F.struct(levels.cast("array<double>").alias("levels"), recent.cast("array<double>").alias("recent"),
                     F.array().cast("array<double>").alias("out"))
    return F.aggregate(steps, start, step)["out"]
