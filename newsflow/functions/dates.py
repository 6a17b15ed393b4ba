"""Dates out of the text forms of the feeds. Bad input gives null, never an error.

Offset forms assume the session time zone UTC (see `session.SETTINGS`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns of the feeds.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
OFFSET = "yyyy-MM-dd'T'HH:mm:ssZ"
OFFSET_FORMS = (OFFSET, "yyyy-MM-dd'T'HH:mm:ssXXX")
INDEX_FORMS = ("MMMM d, yyyy", "M/d/yyyy")
DAY = "yyyy-MM-dd"
NO_DATE = "9999-12-31"


def parse_offset_date(col: Column, lenient: bool = False) -> Column:
    """Date of a timestamp with an offset; `lenient` also takes `Z` and `+00:00`."""
    forms = OFFSET_FORMS if lenient else (OFFSET,)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(col, F.lit(f))) for f in forms])


def parse_epoch_date(col: Column) -> Column:
    """UTC date of epoch seconds held as text."""
    seconds = F.when(col.rlike("^[0-9]{1,12}$"), col.try_cast("bigint"))
    return F.date_from_unix_date((F.floor(seconds / 86400)).cast("int"))


def format_date(col: Column) -> Column:
    """`yyyy-MM-dd` text of ISO text."""
    return F.date_format(F.try_to_timestamp(col), DAY)


def normalize_date(col: Column, lenient: bool = False) -> Column:
    """Date of ISO text with millis, of epoch seconds, or of `yyyy-MM-dd`.

    Text longer than ten characters must be ISO with millis; `lenient` takes any ISO timestamp.
    """
    if lenient:
        long_form = F.coalesce(F.to_date(F.try_to_timestamp(col, F.lit(ISO_MILLIS))),
                               F.to_date(F.try_to_timestamp(col)))
    else:
        long_form = F.to_date(F.try_to_timestamp(col, F.lit(ISO_MILLIS)))
    return (F.when(F.length(col) > 10, long_form)
            .when(col.rlike("^[0-9]+$"), parse_epoch_date(col))
            .otherwise(F.try_to_date(col, DAY)))


def parse_index_date(col: Column) -> Column:
    """Date of `March 7, 2025` or `3/7/2025`."""
    return F.coalesce(*[F.try_to_date(col, form) for form in INDEX_FORMS])


def calendar_date(col: Column) -> Column:
    """Calendar date of a timestamp, a date or ISO text."""
    return col.try_cast("date")


def year_in_name(col: Column) -> Column:
    """First four digits of a file name, null when it has none."""
    return F.nullif(F.regexp_extract(col, r"(\d{4})", 1), F.lit("")).cast("int")


_ISO = r"^(\d{4})-?(\d{2})-?(\d{2})(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(?:Z|[+-]\d{2}(?::?\d{2}){0,2})?)?$"


def iso_millis(col: Column) -> Column:
    """The local time of an ISO timestamp with milliseconds and without offset; null for anything else."""
    part = [F.regexp_extract(col, _ISO, i) for i in range(1, 8)]
    time = [F.when(p == "", "00").otherwise(p) for p in part[3:6]]
    written = F.concat(F.concat_ws("-", *part[:3]), F.lit("T"), F.concat_ws(":", *time), F.lit("."),
                       F.rpad(F.substring(part[6], 1, 3), 3, "0"))
    valid = F.try_to_timestamp(F.substring(written, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
    return F.when(col.rlike(_ISO) & valid, written)
