"""Row filters. Each is a plain predicate, so it reaches the scan when the source allows it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text

# Link parts of pages that are no articles, and the business news desks.
SKIPPED_LINKS = ("/videos/", "/cnn-underscored/")
BUSINESS_DESKS = ("Business", "Financial", "Market Place", "Business Day", "DealBook",
                  "Personal Investing")
SENTINEL_YEAR = "9999"


def filter_dates(df: DataFrame, column: str, start=None, end=None,
                 end_inclusive: bool = False) -> DataFrame:
    """Rows dated from `start` to `end`; the end is left out unless `end_inclusive`."""
    day = F.col(column)
    keep = day.isNotNull()
    if start is not None:
        keep &= day >= F.lit(start).cast("date")
    if end is not None:
        last = F.lit(end).cast("date")
        keep &= (day <= last) if end_inclusive else (day < last)
    return df.filter(keep)


def since(df: DataFrame, column: str, start) -> DataFrame:
    return filter_dates(df, column, start)


def drop_sentinel_dates(df: DataFrame, column: str) -> DataFrame:
    """Without rows whose date text stands for "no date"; rows without a date stay."""
    return df.filter(~F.coalesce(F.col(column).startswith(SENTINEL_YEAR), F.lit(False)))


def exclude_links(df: DataFrame, column: str,
                  parts: Iterable[str] = SKIPPED_LINKS) -> DataFrame:
    """Without rows whose link contains one of `parts`."""
    for part in parts:
        df = df.filter(~F.col(column).contains(part))
    return df


def filter_in(df: DataFrame, column: str, values: Iterable[str] = BUSINESS_DESKS) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def usable_text(df: DataFrame, column: str) -> DataFrame:
    """Rows with text other than blanks."""
    return df.filter(~text.is_blank(F.col(column)))


def split_undated(df: DataFrame, column: str = "record_date") -> tuple[DataFrame, DataFrame]:
    """(dated rows, rows without a date). The latter go to a quarantine output."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def bad_rows(df: DataFrame, column: str, order: list[str], n: int = 5) -> DataFrame:
    """A sample of `n` rows whose `column` is null, first by `order`."""
    return df.filter(F.col(column).isNull()).orderBy(*order).limit(n)
