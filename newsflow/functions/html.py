"""Tags, texts and links of stored pages, as native expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.binding import let
from newsflow.functions.text import LINE_BLANKS, RARE_BREAKS

# Comments, scripts and styles with what is in them, tags (quotes count after an equals sign only), and texts.
_TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*+>.*?(?:</script\b[^>]*+>|\z)"
          r"|<style\b[^>]*+>.*?(?:</style\b[^>]*+>|\z)"
          r"|</?[a-z](?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>"
          r"|<(?:/?[a-z]|[/!?])[^>]*+(?:>|\z)|(?:[^<]++|<(?![a-z/!?]))++")
_TEXT = r"(?i)^(?:[^<]|<(?![a-z/!?]))"
_ATTRIBUTE = r"[^\s=/>\"'<]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]++|&"
_ENTITIES = json.dumps(html5)  # names as the language defines them, some without a semicolon
#: Characters that references to 128 to 159 stand for.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_WINDOWS = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0))


def tokens(html: Column) -> Column:
    """A page as an array of comments, scripts, styles, tags and texts, in order; empty for a null page."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKEN), F.lit(0))


def opening_tag(token: Column, tag: str) -> Column:
    return token.rlike(rf"(?i)^<{tag}(?=[\s/>])")


def closing_tag(token: Column, tag: str) -> Column:
    return token.rlike(rf"(?i)^</{tag}(?=[\s/>])")


def attribute(token: Column, name: str) -> Column:
    """The value of the first attribute of that name as it is written, without quotes; null without one."""
    start = rf"(?is)^{name}\s*=\s*"
    named = F.filter(F.regexp_extract_all(token, F.lit(_ATTRIBUTE), F.lit(0)), lambda a: a.rlike(start))
    return F.regexp_replace(F.regexp_replace(F.get(named, F.lit(0)), F.lit(start), F.lit("")),
                            F.lit(r"(?s)^([\"'])(.*)\1$"), F.lit("$2"))


def inside(found: Column, tag: str, opens: Callable[[Column], Column]) -> Column:
    """The tokens inside the first element of kind `tag` whose opening tag satisfies `opens`; null without one.

    A fold counts how deep elements of that tag are nested until the element ends, or the page does.
    """
    def depth(token: Column) -> Column:
        return (F.when(opening_tag(token, tag) & ~token.endswith("/>"), 1).when(closing_tag(token, tag), -1)
                .otherwise(0))

    def step(state: Column, token: Column) -> Column:
        return F.when(state["open"] == 0, state).otherwise(let(state["open"] + depth(token), lambda now: F.struct(
            now.alias("open"), (state["n"] + (now > 0).cast("int")).alias("n"))))

    def content(all_: Column, start: Column) -> Column:
        rest = F.slice(all_, start + 1, F.size(all_))
        begin = F.struct(F.when(F.get(all_, start - 1).endswith("/>"), 0).otherwise(1).alias("open"), F.lit(0).alias("n"))
        return let(rest, lambda r: F.slice(r, F.lit(1), F.aggregate(r, begin, step)["n"]))

    return let(found, lambda all_: let(
        F.array_position(F.transform(all_, opens), True).cast("int"),
        lambda start: F.when(start > 0, content(all_, start))))


def texts_of(found: Column) -> Column:
    """The texts among tokens with their references decoded."""
    return F.transform(F.filter(found, lambda x: x.rlike(_TEXT)), unescape)


def stripped(col: Column) -> Column:
    """`col` without white space of any kind at its ends."""
    return F.btrim(col, F.lit(LINE_BLANKS + RARE_BREAKS + "\n"))


def _numbered(reference: Column) -> Column:
    digits = F.regexp_extract(reference, r"^&#(?:[xX])?0*([0-9a-fA-F]*)", 1)
    is_hex = reference.rlike("^&#[xX]")

    def character(n: Column) -> Column:
        char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        none = (n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
                | (n % 65536 >= 65534))
        return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(none, "")
                .otherwise(F.translate(char, _C1, _WINDOWS)))

    base = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)
    number = F.when(digits == "", F.lit("0")).when(F.length(digits) <= 7, base).otherwise("9999999")
    return let(number.cast("int"), character)


def _named(reference: Column) -> Column:
    """An entity by its name, or by the longest beginning of it that is a name."""
    table = F.from_json(F.lit(_ENTITIES), "map<string,string>")

    def found(name: Column) -> Column:
        shorter = F.transform(F.sequence(F.length(name) - 1, F.lit(2), F.lit(-1)), lambda n: F.concat(
            F.try_element_at(table, F.substring(name, F.lit(1), n)), F.substring(name, n + 1, F.length(name))))
        first = F.get(F.filter(shorter, lambda x: x.isNotNull()), F.lit(0))
        return F.coalesce(F.try_element_at(table, name), F.when(F.length(name) > 2, first), reference)

    return let(F.substring(reference, F.lit(2), F.length(reference)), found)


def unescape(text: Column) -> Column:
    """`text` with its character references decoded, each once."""
    parts = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    decoded = F.transform(parts, lambda x: F.when(~x.startswith("&") | (x == "&"), x)
                          .when(x.startswith("&#") & x.rlike("^&#(?:[0-9]|[xX][0-9a-fA-F])"), _numbered(x))
                          .otherwise(_named(x)))
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR = r"(?is)<a\s(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_HREF = r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_BASE = r"^([A-Za-z][A-Za-z0-9+.-]*:)//([^/?#]*)([^?#]*)"
_DOTS = r"(?:^|/)\.\.?(?:/|$)"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, F.lit(_HIDDEN), F.lit(""))


def _target(anchor: Column) -> Column:
    quoted = [F.nullif(F.regexp_extract(anchor, _HREF, i), F.lit("")) for i in (1, 2, 3)]
    return F.replace(F.coalesce(*quoted, F.lit("")), F.lit("&amp;"), F.lit("&"))


def hrefs(html: Column) -> Column:
    """Link targets of a page in order, as they are written; anchors without one give none."""
    anchors = F.regexp_extract_all(visible(html), F.lit(_ANCHOR), F.lit(0))
    return F.transform(F.filter(anchors, lambda a: a.rlike(_HREF)), _target)


def _without_dots(path: Column) -> Column:
    """Resolve `.` and `..` in a path that starts with a slash."""
    parts = F.split(path, "/")
    resolved = F.aggregate(
        parts, F.slice(F.array(F.lit("")), 1, 0),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .when(part == ".", done).otherwise(F.array_append(done, part)))
    closing = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.when(path.rlike(_DOTS), F.concat(F.array_join(resolved, "/"), closing)).otherwise(path)


def url_join(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page `base`."""
    scheme, host, path = (F.regexp_extract(base, _BASE, i) for i in (1, 2, 3))
    site = F.concat(scheme, F.lit("//"), host)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    tail = F.regexp_extract(link, r"([?#].*)$", 1)
    own_path = F.regexp_replace(link, F.lit(r"[?#].*$"), F.lit(""))
    return (F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
            .when(link == "", base)
            .when(link.startswith("//"), F.concat(scheme, link))
            .when(link.startswith("/"), F.concat(site, _without_dots(own_path), tail))
            .when(link.startswith("?"), F.concat(site, path, link))
            .when(link.startswith("#"), F.concat(F.regexp_replace(base, F.lit("#.*$"), F.lit("")), link))
            .otherwise(F.concat(site, _without_dots(F.concat(folder, own_path)), tail)))


def links(base: Column, html: Column, suffix: str = ".pdf") -> Column:
    """Distinct absolute links of a page whose written target ends with `suffix` in any case."""
    wanted = F.filter(hrefs(html), lambda h: F.lower(h).endswith(suffix.lower()))
    return F.array_distinct(F.transform(wanted, lambda h: url_join(base, h)))
