"""Pages read by the standard library's parser: what the expressions of the package are compared with."""

from __future__ import annotations

from datetime import datetime
from html.parser import HTMLParser

from newsflow.operators.pages import (ARTICLE_BODY, NO_CONTENT, NO_DATE, NO_TITLE, PUBLISHED, RELEASE_BODY,
                                      RELEASE_DATE, RELEASE_HEADING, RELEASE_TIME, RELEASE_TITLE, TITLE, Element)


def matches(kind: Element, tag: str, classes: list[str]) -> bool:
    wanted = kind.classes.split()
    return tag == kind.tag and (classes == wanted if kind.exact else set(wanted) <= set(classes))


class _Capture:
    """Text of the first element of a kind, looked for only inside another capture if given."""

    def __init__(self, kind: Element, inside: _Capture | None = None):
        self.kind, self.inside = kind, inside
        self.depth, self.found = 0, False
        self.texts: list[str] = []

    def opens(self, tag: str, classes: list[str]) -> None:
        if self.depth:
            self.depth += tag == self.kind.tag
        elif not self.found and (self.inside is None or self.inside.depth) and (
                matches(self.kind, tag, classes)):
            self.found, self.depth = True, 1

    def closes(self, tag: str) -> None:
        if self.depth and tag == self.kind.tag:
            self.depth -= 1


class _Page(HTMLParser):
    """Collects captures, the paragraphs of one of them, and the first value of a meta property.

    Comments, scripts and styles are no text. A paragraph ends where the next one starts.
    """

    def __init__(self, captures: list[_Capture], body: _Capture, meta: str = ""):
        super().__init__(convert_charrefs=True)
        self.captures, self.body, self.meta = captures, body, meta
        self.published: str | None = None
        self.paragraphs: list[list[str]] = []
        self.in_paragraph = self.hidden = False
        self.pending: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.end_text()
        values = dict(attrs)
        self.hidden = tag in ("script", "style")
        if tag == "meta" and self.published is None and values.get("property") == self.meta:
            self.published = values.get("content")
        for capture in self.captures:
            capture.opens(tag, (values.get("class") or "").split())
        if tag == "p":
            self.in_paragraph = bool(self.body.depth)
            if self.in_paragraph:
                self.paragraphs.append([])

    def handle_endtag(self, tag):
        self.end_text()
        self.hidden = False
        for capture in self.captures:
            capture.closes(tag)
            if capture.inside is not None and not capture.inside.depth:
                capture.depth = 0  # what is open in an element ends with it
        if tag == "p" or not self.body.depth:
            self.in_paragraph = False

    def handle_comment(self, data):
        self.end_text()

    handle_decl = unknown_decl = handle_pi = handle_comment

    def handle_data(self, data):
        self.pending.append(data)

    def end_text(self):
        """A text reaches from tag to tag, whatever parts the parser gives it in."""
        data, self.pending = "".join(self.pending), []
        if self.hidden or not data:
            return
        for capture in self.captures:
            if capture.depth:
                capture.texts.append(data)
        if self.in_paragraph:
            self.paragraphs[-1].append(data)

    def read(self, html: str | None) -> None:
        self.feed(html or "")
        self.close()
        self.end_text()


def _iso_millis(text: str | None) -> str:
    """The local time of a timestamp with millis and without offset."""
    try:
        return datetime.fromisoformat(text.strip()).replace(tzinfo=None).isoformat(
            timespec="milliseconds")
    except (AttributeError, ValueError):
        return NO_DATE


def _stripped(texts: list[str]) -> str:
    return "".join(t.strip() for t in texts)


def article_of(html: str | None, body: Element = ARTICLE_BODY) -> tuple:
    """Title, body text and date of an article page."""
    title, content = _Capture(TITLE), _Capture(body)
    page = _Page([title, content], content, PUBLISHED)
    page.read(html)
    return ("".join(title.texts).strip() if title.found else NO_TITLE,
            "".join(content.texts) if content.found else NO_CONTENT,
            _iso_millis(page.published))


def release_of(html: str | None, heading: Element = RELEASE_HEADING,
               body: Element = RELEASE_BODY) -> tuple:
    """Date, title, release time and paragraphs of a press release or speech page.

    The first three count only inside the heading; paragraphs are joined by line breaks.
    """
    top, content = _Capture(heading), _Capture(body)
    fields = [_Capture(kind, inside=top) for kind in (RELEASE_DATE, RELEASE_TITLE, RELEASE_TIME)]
    page = _Page([top, *fields, content], content)
    page.read(html)
    return (*[_stripped(f.texts) if f.found else None for f in fields],
            "\n".join(_stripped(p) for p in page.paragraphs))
