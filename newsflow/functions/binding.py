"""Bind an expression once so that lambdas can use it many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row.

    An expression captured by a lambda is evaluated for every array element, and the optimizer
    folds a preceding `withColumn` back into it; a lambda variable is not folded.
    """
    return F.transform(F.array(value), body)[0]
