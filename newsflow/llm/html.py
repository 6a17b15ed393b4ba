"""Main text of web pages: the maximum-scoring stretch of a page's words and tags.

A page is read as a row of tokens. Visible words score positive and tags negative; the weights are
log-odds counted on labelled pages, those that mark their own article. One linear scan finds the
contiguous stretch with the largest sum. Elements that are never article text (menus, footers, players,
articles that are readers' comments and the like) are one token each, and their text is left out wherever they
stand. Forms, dialogs and those known by their class, id or role only are left out where the class or id names nothing else and the elements of this name
hold at most half of the page's words. An element where such a word is part of a longer name stays; its
words score lower, and the scan decides.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.text import names, small_batches

#: Pages that the weights are counted on, about.
SAMPLE = 2000

# Elements whose text is not the article's, elements that part blocks, names of parts.
BOILERPLATE = frozenset("""head nav footer aside button select option menu iframe object svg
canvas audio video fieldset noscript template textarea""".split())
WRAPPING = ("form", "dialog")  # may also be put around a whole page: they are parts, judged by what they hold
BLOCKS = frozenset("""address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3
h4 h5 h6 header hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("""area base br col embed hr img input link meta source track wbr""".split())
PARTS = frozenset("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter notice
notices popup promo promotion related respond share sharing sidebar social sponsor sponsored subscribe
toolbar widget""".split())
# With names of parts only these stand in names that mean the part itself ("site-footer", "ad-slot").
PLAIN = frozenset("""area bar block box bottom button buttons container group item items left link links list
right site slot top unit wrap wrapper""".split())
CONTENT = frozenset("article body content entry post story text".split())
FAINT = 0.25  # what a word counts in an element whose name holds that of a part
BORDER = -2.0  # score of entering or leaving such elements, unless the pages tell
ROLES = frozenset("navigation banner contentinfo complementary search alert".split())
REGIONS = ("article", "main")

# Fixed values for elements that end without an end tag, as in HTML.
WALLS = frozenset("table caption td th object template".split())  # most end tags reach no further out
LISTS = frozenset("ul ol menu dl".split())
ROWS = frozenset("caption tbody thead tfoot tr td th".split())  # parts of the table they are in
STRONG = BLOCKS | BOILERPLATE  # end tags of other elements do not end these
#: What a start tag ends, of the elements in its list, table or cell.
ENDS = ({name: ("p",) for name in """address article aside blockquote center details dialog div dl fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table
ul""".split()} | {"li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"),
                  "option": ("option",), "optgroup": ("option", "optgroup"), "td": ("td", "th", "caption"),
                  "th": ("td", "th", "caption"), "tr": ("tr", "td", "th", "caption")}
        | {name: ("tbody", "thead", "tfoot", "tr", "caption") for name in ("tbody", "thead", "tfoot")})

_TOKEN = re.compile(
    r"(?P<hidden><!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:\"[^\"<]*+\"|'[^'<]*+'|[^>])*+)>"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


@dataclass
class Part:
    """An element with a class or id that names parts: `whole`, or within longer names only."""

    parent: int
    name: str
    whole: frozenset[str]
    inside: bool


@dataclass
class Page:
    """Tokens of a page: class of each, words of each, the text of visible ones, and the part each is in."""

    kinds: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)
    part: list[int] = field(default_factory=list)
    parts: list[Part] = field(default_factory=list)
    regions: int = 0

    def add(self, kind: str, size: int, text: str | None, inside: bool, part: int = -1) -> None:
        self.kinds.append(kind)
        self.sizes.append(size)
        self.texts.append(text)
        self.inside.append(inside)
        self.part.append(part)

    def judged(self) -> Page:
        """The page with each part left out, faint or as it was.

        A name that more than half of the words are under says nothing: its parts stay, unless they stand
        outside of an article or main part that has a tenth of the page's words.
        """
        if not self.parts:
            return self
        held, total, region = [0] * len(self.parts), 0, 0
        named: list[frozenset[str]] = []  # names of a part and those around it; "" for longer names
        for p in self.parts:
            around = named[p.parent] if p.parent >= 0 else frozenset()
            named.append(around | (p.whole or {""}))
        for kind, size, inside, part in zip(self.kinds, self.sizes, self.inside, self.part):
            if kind == "word":
                total += size
                region += size if inside and (part < 0 or named[part] == {""}) else 0
                if part >= 0:
                    held[part] += size
        for i in range(len(held) - 1, -1, -1):
            if self.parts[i].parent >= 0:
                held[self.parts[i].parent] += held[i]
        under = Counter()
        for i, p in enumerate(self.parts):
            for name in named[i] - (named[p.parent] if p.parent >= 0 else frozenset()):
                under[name] += held[i]
        gone, faint = [], []
        for p in self.parts:
            most = any(2 * under[name] > total for name in p.whole or ("",))
            beside = not p.inside and 10 * region >= max(total, 1)
            gone.append((p.parent >= 0 and gone[p.parent]) or (bool(p.whole) and (beside or not most)))
            faint.append((p.parent >= 0 and faint[p.parent]) or not (p.whole or most))
        out, begun, was_faint = Page(regions=self.regions), -1, False
        for kind, size, text, inside, part in zip(self.kinds, self.sizes, self.texts, self.inside, self.part):
            new, begun = part > begun, max(part, begun)  # parts are numbered as they begin
            parent = self.parts[part].parent if part >= 0 else -1
            if part >= 0 and gone[part]:
                if new and (parent < 0 or not gone[parent]):
                    out.add(f"-{self.parts[part].name}", 1, None, inside)
                continue
            is_faint = part >= 0 and faint[part]
            if is_faint != was_faint:
                out.add("~", 1, None, inside)
            was_faint = is_faint
            out.add("faint" if is_faint and kind == "word" else kind, size, text, inside)
        return out


class OpenElements:
    """The open elements of a page. Elements whose end tag is missing end as in HTML: with a sibling of
    their kind, or with the end tag of what they stand in."""

    def __init__(self):
        self.names: list[str] = []
        self.where: dict[str, list[int]] = {}  # places by name, and of walls, lists and strong elements

    def __len__(self) -> int:
        return len(self.names)

    def _last(self, key: str) -> int:
        places = self.where.get(key)
        return places[-1] if places else -1

    def _keys(self, name: str) -> list[str]:
        return [name, *[key for key, kinds in (("/wall", WALLS), ("/list", LISTS), ("/strong", STRONG))
                        if name in kinds]]

    def _cut(self, size: int) -> None:
        while len(self.names) > size:
            for key in self._keys(self.names.pop()):
                self.where[key].pop()

    def before(self, name: str) -> None:
        """Ends what the start tag `name` ends."""
        if name in ROWS:
            bound = self._last("table")
        else:
            bound = max(self._last("/wall"), self._last("/list"))
        places = [at for at in map(self._last, ENDS.get(name, ())) if at > bound]
        if places:
            self._cut(min(places))

    def start(self, name: str) -> None:
        for key in self._keys(name):
            self.where.setdefault(key, []).append(len(self.names))
        self.names.append(name)

    def end(self, name: str, within: int) -> None:
        """Ends the last `name` and all in it. What is open up to the place `within` is left out: the end
        tag of that element counts wherever it stands."""
        at = self._last(name)
        bound = self._last("table" if name in ROWS or name == "table" else "/wall")
        if name == "li":
            bound = max(bound, self._last("/list"))
        if at < max(bound, 0) or (name not in STRONG and at != within and self._last("/strong") > at):
            return
        self._cut(at)


def _boilerplate(name: str, rest: str, inside: bool) -> bool:
    if name in BOILERPLATE or (name == "header" and not inside):
        return True
    return name not in ("html", "body", *REGIONS) and any(
        key.lower() == "role" and value.strip("\"'").lower() in ROLES for key, value in _NAMED.findall(rest))


def _is_comment(rest: str) -> bool:
    """Whether the class or id of an article says that it is a reader's comment."""
    items = [set(re.findall("[a-z]+", item)) for key, value in _NAMED.findall(rest) if key.lower() != "role"
             for item in value.strip("\"'").lower().split()]
    return any(words & {"comment", "comments"} and words <= PARTS | PLAIN for words in items)


def _naming(name: str, rest: str) -> frozenset[str] | None:
    """The parts that a tag, class, id or role names as a whole; none if only longer names hold them, or beside a
    name of content; null if no part is named."""
    if name in ("html", "body", *REGIONS):
        return None
    whole, longer, content = set(), name in WRAPPING, False
    if name in WRAPPING:
        whole.add(name)
    for key, value in _NAMED.findall(rest):
        role = value.strip("\"'").lower()
        if key.lower() == "role" and role in WRAPPING:
            whole.add(role)
            longer = True
        for item in value.strip("\"'").lower().split() if key.lower() != "role" else ():
            words = set(re.findall("[a-z]+", item))
            found = words & PARTS
            if found and words <= PARTS | PLAIN:
                whole |= found
            longer |= bool(found)
            content |= not found and not words.isdisjoint(CONTENT)
    return frozenset(() if content else whole) if longer else None


def read_page(source: str) -> Page:
    """The tokens of a page. An element that may be left out ends with its end tag, where HTML ends it
    without one, or where the body, the article or the main part begins or ends."""
    page, inside, opened, skipped = Page(), 0, OpenElements(), -1  # place of the left-out element
    named: list[tuple[int, int]] = []  # places and numbers of the open parts
    comments: list[int] = []  # of the open articles and main parts, the place of the comment they are in, or -1
    end = source.rfind(">") + 1  # no tag begins after the last one ends
    for token in _TOKEN.finditer(source[:end]):
        name = (token["name"] or "").lower()
        if token["hidden"]:
            continue
        if not name:
            if skipped < 0:
                text = html.unescape(token["text"])
                page.add("word", len(text.split()), text, inside > 0, named[-1][1] if named else -1)
            continue
        close, rest = bool(token["close"]), token["rest"] or ""
        lasts = not close and name not in VOID and not rest.endswith("/")
        was = skipped
        if name in ("body", *REGIONS):
            skipped, named = -1, []
        if close:
            opened.end(name, skipped if skipped >= 0 or not named else named[-1][0])
        else:
            opened.before(name)
        at, own = len(opened), -1
        if at <= skipped:
            skipped = -1
        while named and at <= named[-1][0]:
            place, number = named.pop()
            own = number if close and place == at else -1  # its own end tag
        if lasts:
            opened.start(name)
        if skipped >= 0 or (close and was >= 0 and name not in ("body", *REGIONS) and at == was):
            continue
        part = own if own >= 0 else named[-1][1] if named else -1
        if name in REGIONS and close and comments and comments.pop() >= 0:
            skipped = comments[-1] if comments else -1
            continue
        if name in REGIONS and not close:
            comments.append(comments[-1] if comments else -1)
            if comments[-1] < 0 and name == "article" and _is_comment(rest):
                page.add("-comment", 1, None, inside > 0, part)
                comments[-1] = at
            if comments[-1] >= 0:
                skipped = comments[-1]
                continue
        if name in REGIONS:
            inside = max(0, inside + (-1 if close else 1))
            page.regions += inside == 1 and not close
        elif not close and name not in VOID and _boilerplate(name, rest, inside > 0):
            page.add(f"-{name}", 1, None, inside > 0, part)
            if lasts:
                skipped = at
            continue
        elif not close and name not in VOID and (whole := _naming(name, rest)) is not None:
            page.parts.append(Part(part, name, whole, inside > 0))
            part = len(page.parts) - 1
            if lasts:
                named.append((at, part))
        page.add(f"<{name}", 1, None, inside > 0, part)
    if source[end:] and skipped < 0:
        text = html.unescape(source[end:])
        page.add("word", len(text.split()), text, inside > 0, named[-1][1] if named else -1)
    return page.judged()


@dataclass
class Weights:
    """Scores of a word and of tags by name; a tag that was never seen scores `other`."""

    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)
    other: float = -0.1


def weigh(counts: dict[str, tuple[int, int]]) -> Weights:
    """Log-odds of token classes from (inside, outside) counts: words at least 0.5, tags -2 to -0.01.

    The bounds keep the signs, and let a few words outweigh an advert in the middle of an article.
    Without labelled pages the default weights stand.
    """
    inside = sum(a for a, _ in counts.values())
    outside = sum(b for _, b in counts.values())
    if not inside or not outside:
        return Weights()
    odds = {k: float(np.log((a + 0.5) / (inside + 1)) - np.log((b + 0.5) / (outside + 1)))
            for k, (a, b) in counts.items()}
    word = max(odds.pop("word", 1.0), 0.5)
    return Weights(word, {k: min(max(v, -2.0), -0.01) for k, v in odds.items()})


def best_stretch(scores: np.ndarray) -> tuple[int, int]:
    """[first, end) of the contiguous stretch with the largest sum; empty when nothing is positive."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    lowest = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - lowest))
    if sums[end] <= lowest[end]:
        return 0, 0
    return int(np.flatnonzero(sums[:end + 1] == lowest[end])[0]), end


def main_text(source: str | None, weights: Weights) -> str:
    """The blocks of the best stretch, one a line."""
    page = read_page(source or "")
    tags = weights.tags
    first, end = best_stretch(np.array([
        weights.word * n if k == "word" else weights.word * FAINT * n if k == "faint"
        else tags.get(k, BORDER if k == "~" else weights.other)
        for k, n in zip(page.kinds, page.sizes)]))
    blocks, parts = [], []
    for kind, text in zip(page.kinds[first:end], page.texts[first:end]):
        if text is not None:
            parts.append(text)
        elif kind == "<br":
            parts.append(" ")
        elif kind[0] == "-" or kind[1:] in BLOCKS:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def fit_weights(pages: DataFrame, key: str = "page_id", source: str = "html", size: int = SAMPLE) -> Weights:
    """Weights from about `size` pages, those whose hash of `key` and length is below a bound; from all if there are fewer.

    The bound follows from the number of pages, so pages are chosen and counted where they are read. Of these, the pages with exactly one article or main element label their own tokens: inside or
    outside. Tasks count; the counts have a row per tag name that is found on three pages or more.
    """
    small_batches(pages.sparkSession)
    share = min(1.0, size / max(pages.count(), 1))
    bound = min(int(share * (1 << 64)) - (1 << 63), (1 << 63) - 1)
    chosen = (pages.filter(F.xxhash64(key, F.octet_length(source)) <= bound)
              .select(F.coalesce(source, F.lit("")).alias("source")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, pages_with = (Counter(), Counter()), Counter()
            for text in batch.column(0).to_pylist():
                page = read_page(text)
                if page.regions != 1:
                    continue
                kinds = ["word" if k == "faint" else k for k in page.kinds]
                pages_with.update(set(kinds))
                for kind, n, inside in zip(kinds, page.sizes, page.inside):
                    seen[not inside][kind] += n
            kinds = list(pages_with)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([seen[0][k] for k in kinds], pa.int64()),
                 pa.array([seen[1][k] for k in kinds], pa.int64()),
                 pa.array([pages_with[k] for k in kinds], pa.int64())],
                names=["kind", "inside", "outside", "pages"])

    rows = (chosen.mapInArrow(count, "kind string, inside long, outside long, pages long").groupBy("kind")
            .agg(*[F.sum(c).alias(c) for c in ("inside", "outside", "pages")])
            .filter("pages >= 3 OR kind = 'word'").collect())
    return weigh({r["kind"]: (r["inside"], r["outside"]) for r in rows})


def extract_text(pages: DataFrame, weights: Weights, source: str = "html") -> DataFrame:
    """`pages` without `source`, with `text` and `n_chars` (its code points).

    A null or empty page has an empty text. Pages are read one by one, so repeated rows get equal
    texts. Columns named like the new ones are replaced.
    """
    small_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars", source.lower())]
    schema = pages.select(kept).schema.add("text", "string").add("n_chars", "long")
    (page,) = names(kept, "page")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(s, weights) for s in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.select(*kept, pages[source].alias(page)).mapInArrow(extract, schema)
