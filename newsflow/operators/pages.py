"""Fields and texts out of stored web pages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.binding import let
from newsflow.functions.dates import iso_millis
from newsflow.functions.html import (attribute, closing_tag, inside, links, opening_tag, stripped, texts_of,
                                     tokens, unescape)


@dataclass(frozen=True)
class Element:
    """A tag with classes; `exact` asks for these classes in this order and no others."""

    tag: str
    classes: str = ""
    exact: bool = False

    def opens(self, token: Column) -> Column:
        """Whether a token is the opening tag of such an element."""
        tag, wanted = opening_tag(token, self.tag), [F.lit(c) for c in self.classes.split()]
        if not wanted:
            return tag
        given = F.filter(F.split(F.coalesce(attribute(token, "class"), F.lit("")), r"\s+"), lambda c: c != "")
        fits = given == F.array(*wanted) if self.exact else F.size(F.array_except(F.array(*wanted), given)) == 0
        return F.when(tag, fits).otherwise(False)

    def inside(self, found: Column) -> Column:
        """The tokens inside the first such element; null where there is none."""
        return inside(found, self.tag, self.opens)


# What stands for a missing title, body and date, and where pages keep their parts.
NO_TITLE = "No title"
NO_CONTENT = "No content"
NO_DATE = "9999-12-31"
TITLE = Element("h1")
ARTICLE_BODY = Element("div", "article__content")
PUBLISHED = "article:published_time"
RELEASE_HEADING = Element("div", "heading col-xs-12 col-sm-8 col-md-8")
RELEASE_DATE = Element("p", "article__time")
RELEASE_TITLE = Element("h3", "title")
RELEASE_TIME = Element("p", "releaseTime")
RELEASE_BODY = Element("div", "col-xs-12 col-sm-8 col-md-8", exact=True)


def _joined(found: Column) -> Column:
    return F.array_join(texts_of(found), "")


def _stripped(found: Column) -> Column:
    return F.array_join(F.transform(texts_of(found), stripped), "")


def _paragraphs(body: Column) -> Column:
    """Texts of the paragraphs among tokens; a paragraph ends where the next one starts."""
    def of(found: Column, starts: Column) -> Column:
        def paragraph(start: Column, nth: Column) -> Column:
            after = F.coalesce(F.get(starts, nth + 1), F.size(found)) - start - 1
            length = F.when(F.get(found, start).endswith("/>"), 0).otherwise(after)
            return let(F.slice(found, start + 2, length), lambda part: let(
                F.array_position(F.transform(part, lambda x: closing_tag(x, "p")), True).cast("int"),
                lambda end: _stripped(F.slice(part, F.lit(1), F.when(end == 0, F.size(part)).otherwise(end - 1)))))
        return F.transform(starts, paragraph)

    def places(found: Column) -> Column:
        marked = F.transform(found, lambda x, i: F.when(opening_tag(x, "p"), i))
        return F.filter(marked, lambda i: i.isNotNull())

    return F.array_join(let(body, lambda found: let(places(found), lambda starts: of(found, starts))), "\n")


def article_fields(html: Column, body: Element = ARTICLE_BODY) -> Column:
    """Struct of title, body text and date of an article page."""
    def fields(found: Column) -> Column:
        published = F.filter(found, lambda x: F.when(
            opening_tag(x, "meta"), (attribute(x, "property") == PUBLISHED) & attribute(x, "content").isNotNull())
            .otherwise(False))
        time = unescape(attribute(F.get(published, F.lit(0)), "content"))
        return F.struct(
            F.coalesce(stripped(_joined(TITLE.inside(found))), F.lit(NO_TITLE)).alias("title"),
            F.coalesce(_joined(body.inside(found)), F.lit(NO_CONTENT)).alias("content"),
            F.coalesce(iso_millis(stripped(time)), F.lit(NO_DATE)).alias("date"))
    return let(tokens(html), fields)


def release_fields(html: Column, heading: Element = RELEASE_HEADING, body: Element = RELEASE_BODY) -> Column:
    """Struct of date, title, release time and paragraphs of a press release or speech page.

    The first three count only inside the heading; paragraphs are joined by line breaks.
    """
    def fields(found: Column) -> Column:
        kinds = {"date": RELEASE_DATE, "title": RELEASE_TITLE, "release_time": RELEASE_TIME}
        top = let(heading.inside(found), lambda t: F.struct(*[
            _stripped(kind.inside(t)).alias(name) for name, kind in kinds.items()]))
        return let(top, lambda t: F.struct(
            *[t[name].alias(name) for name in kinds],
            F.coalesce(_paragraphs(body.inside(found)), F.lit("")).alias("content")))
    return let(tokens(html), fields)


def _replace_page(df: DataFrame, html: str, fields: Callable[[Column], Column]) -> DataFrame:
    """Replace the page column by the fields of a struct."""
    kept = [c for c in df.columns if c != html]
    return df.select(*kept, fields(F.col(html)).alias("_page")).select(*kept, "_page.*")


def extract_articles(df: DataFrame, html: str, body: Element = ARTICLE_BODY) -> DataFrame:
    """Replace the page by `title`, `content` and `date`; missing parts get their sentinels."""
    return _replace_page(df, html, lambda page: article_fields(page, body))


def extract_releases(df: DataFrame, html: str, heading: Element = RELEASE_HEADING,
                     body: Element = RELEASE_BODY) -> DataFrame:
    """Replace the page by `date`, `title`, `release_time` and `content`."""
    return _replace_page(df, html, lambda page: release_fields(page, heading, body))


def extract_links(df: DataFrame, url: str, html: str, suffix: str = ".pdf") -> DataFrame:
    """One row per distinct absolute link of a page whose target ends with `suffix`."""
    kept = [c for c in df.columns if c != html]
    return df.select(*kept, F.explode(links(F.col(url), F.col(html), suffix)).alias("link"))
