"""Cleaning of headlines, summaries and article bodies."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.binding import let

# Patterns of the headline and summary scrub, applied in this order.
URL = r"http[s]?://\S+"
BRACKETED = r"\[.*?\]|\(.*?\)"
BLANKS = r"\s+"

# Characters of Python's str.splitlines and str.strip.
RARE_BREAKS = "\r\v\f\x1c\x1d\x1e\x85\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}"
LINE_BREAK = f"\r\n|[{RARE_BREAKS}]"
LINE_BLANKS = (" \t\x1f\xa0\N{OGHAM SPACE MARK}" + "".join(map(chr, range(0x2000, 0x200B)))
               + "\N{NARROW NO-BREAK SPACE}\N{MEDIUM MATHEMATICAL SPACE}\N{IDEOGRAPHIC SPACE}")

# Quotes around an article, marker line, indent of body lines and dateline.
QUOTES = "“”\""
MARKER = "Related article"
INDENT = "^(?:\t{3}| {12})"
DATELINE = "(?U)^(?:[A-Za-z\\s\u001f]+)?\\bCNN(?: Business)?[\\s\u001f]*-[\\s\u001f]*"


# What a dot in a pattern does not match, and characters that no text has.
DOT_STOPS = r"\n\r\x{85}\x{2028}\x{2029}"
MARKS = "\ufdd0\ufdd1"
PAIRS = ["[]", "()"]


def _unclosed(opening: str, closing: str) -> str:
    """A pair within a line, or (group 1) an opening without its end and the rest of its line.

    What follows an opening that is never closed is consumed with it, as no later one of its kind can be closed
    in that line either: every character is looked at once.
    """
    inside = rf"\{opening}[^\{closing}{DOT_STOPS}]*+"
    return rf"{inside}\{closing}|({inside})"


def scrub(col: Column) -> Column:
    """Drop URLs, tags and bracketed parts, then make every run of blanks one blank.

    Every step is bound once and takes time linear in the text, also in texts of unmatched openings.
    """
    def untagged(c: Column) -> Column:
        return F.when(c.contains("<"), F.regexp_replace(c, F.lit(_unclosed("<", ">")), F.lit("$1"))).otherwise(c)

    plain = let(F.regexp_replace(col, F.lit(URL), F.lit("")), untagged)
    return F.regexp_replace(let(plain, _drop_brackets), F.lit(BLANKS), F.lit(" "))


def _drop_brackets(col: Column) -> Column:
    """Drop bracketed parts; only texts with an opening that its line never closes go line by line."""
    def left_open(opening: str, closing: str) -> Column:
        rest = F.regexp_replace(col, F.lit(_unclosed(opening, closing)), F.lit("$1"))
        return col.contains(opening) & rest.contains(opening)

    dropped = F.regexp_replace(col, F.lit(BRACKETED), F.lit(""))
    return (F.when(~(col.contains("[") | col.contains("(")), col)
            .when(reduce(or_, [left_open(*pair) for pair in PAIRS]), _drop_in_lines(col)).otherwise(dropped))


def _drop_in_lines(col: Column) -> Column:
    """Drop bracketed parts of each line, from an opening to the next closing character.

    An opening character after the last closing one of its line matches nothing, yet the pattern would
    look through the rest of the line for each. These are hidden from it, so that the time is linear.
    """
    def hide_after(line: Column, opening: str, closing: str, mark: str) -> Column:
        rest = F.substring_index(line, closing, -1)
        end = F.when(line.contains(closing), F.char_length(line) - F.char_length(rest)).otherwise(0)
        return let(F.struct(line.alias("line"), end.alias("end")), lambda x: F.concat(
            F.substring(x["line"], F.lit(1), x["end"]),
            F.translate(F.substring(x["line"], x["end"] + 1, F.char_length(x["line"])), opening, mark)))

    def hidden(line: Column) -> Column:
        for (opening, closing), mark in zip(PAIRS, MARKS):
            line = hide_after(line, opening, closing, mark)
        return line

    hide = F.array_join(F.transform(F.split(col, f"(?<=[{DOT_STOPS}])"), hidden), "")
    openings = "".join(p[0] for p in PAIRS)
    shown = F.translate(F.regexp_replace(hide, F.lit(BRACKETED), F.lit("")), MARKS, openings)
    # a text that has the marks itself is taken as it is
    return F.when(reduce(or_, [col.contains(m) for m in MARKS]),
                  F.regexp_replace(col, F.lit(BRACKETED), F.lit(""))).otherwise(shown)


def _replace_if(col: Column, parts: Iterable[str], pattern: str, to: str) -> Column:
    """Replace `pattern` in texts that contain one of `parts`, as every match does."""
    return let(col, lambda c: F.when(
        reduce(or_, [c.contains(p) for p in parts]),
        F.regexp_replace(c, F.lit(pattern), F.lit(to))).otherwise(c))


def clean_body(col: Column) -> Column:
    """Body text of a crawled article: indented lines only, without related-article teasers.

    A marker line also takes the line after it, whatever that is. One left-to-right replacement
    carries that state, so a marker that was taken as "the line after" starts nothing.
    """
    blanks = f"[{LINE_BLANKS}]*"
    teaser = f"(?dm)^{blanks}{MARKER}{blanks}(?:\n[^\n]*)?(?:\n|\\z)"
    # both replacements are rare, and looking for a substring is much cheaper than a pattern
    body = _replace_if(F.btrim(col, F.lit(QUOTES)), RARE_BREAKS, LINE_BREAK, "\n")
    body = _replace_if(body, [MARKER], teaser, "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(INDENT))
    text = F.array_join(F.transform(lines, lambda line: F.btrim(line, F.lit(LINE_BLANKS))), " ")
    return F.regexp_replace(text, F.lit(DATELINE), F.lit(""))


def is_blank(col: Column) -> Column:
    """True for null and for text of blanks only."""
    return F.coalesce(~col.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(True))


def pick_text(summary: Column, headline: Column) -> Column:
    """The text to score: the summary, or the headline when the summary is blank."""
    return let(summary, lambda s: F.when(~is_blank(s), s).otherwise(F.coalesce(headline, F.lit(""))))


def combine_text(body: Column, parts: Column | None = None) -> Column:
    """The body and the optional text array joined by blanks; nulls are skipped."""
    attached = F.lit("") if parts is None else F.concat_ws(" ", parts)
    return F.concat_ws(" ", body, attached)


def append_texts(body: Column, texts: Column) -> Column:
    """The body and the texts of its attachments on lines of their own; empty ones are skipped."""
    attached = F.filter(texts, lambda t: t.isNotNull() & (t != ""))
    return F.concat_ws("\n", F.nullif(body, F.lit("")), attached)
