"""Text conventions shared by the operators, and the session settings of those that run Python."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """`text` with A-Z in lower case, all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only: lower() does the same, faster
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of `text` in order; none for a null text."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.array_remove(F.split(spaced, " "), "")


def small_batches(spark: SparkSession) -> None:
    """Bound an Arrow batch by rows and bytes, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def names(taken: list[str], *wanted: str) -> list[str]:
    """Column names like `wanted` that do not clash with `taken`, whatever its case."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
