"""HTML extraction."""

import numpy as np
import pytest

from newsflow.llm import html


def _page(body, head="<title>Title</title><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


MENU = '<nav><ul><li><a href="/a">one</a></li><li><a href="/b">two</a></li></ul></nav>'
FOOT = "<footer>&copy; somebody and some more words that say nothing</footer>"
ARTICLE = "<article><h1>A &amp; B</h1><p>First  para\n graph.<br>Goes on.</p><p><b>Bold</b> end&#33;</article>"
WANT = "A & B\nFirst para graph. Goes on.\nBold end!"


@pytest.mark.parametrize("body, want", [
    (MENU + ARTICLE + FOOT, WANT),
    (MENU + '<div class="ad">buy this</div>' + ARTICLE + '<div id="comments"><p>me too</p></div>', WANT),
    (ARTICLE.replace("<p><b>", '<aside>see also</aside><form><input>send</form><p><b>'), WANT),
    (ARTICLE + '<script>var t="</p><p>no";</script><!-- <p>never</p> -->', WANT),
    ("<p>x &lt;b&gt; &am &nbsp;y</p>", "x <b> &am y"),
    ('<div class="menu">unclosed menu<article><p>text of it</p></article>', "text of it"),
    ("<form>" + ARTICLE + "</form>", WANT), ("<form><div>" + ARTICLE.replace("article", "div") + "</div></form>", WANT),
    ('<div role="dialog"><p>Text of a story in a window.</p><p>More of it.</p></div>', "Text of a story in a window.\nMore of it."),
    (ARTICLE + '<article class="comment"><p>me too</p><article class="comment reply"><p>no</p></article><p>so</p></article>', WANT),
    ('<article class="comment"><p>me too</p></article>' + ARTICLE + '<article id="comment-3"><p>and me', WANT),
    (ARTICLE[:-10] + '<p>Part.</p><article class="comments-area">me</article><p>Rest.</p></article>', WANT + "\nPart.\nRest."),
    (ARTICLE + '<div role="form"><p>write to us</p></div>', WANT),
    ("<p>a < b and c</p>", "a < b and c"), ('<p title="a>b">quoted</p>', "quoted"),
    ("<script>only", ""), ("", ""), (MENU, "")])
def test_main_text(body, want):
    assert html.main_text(_page(body), html.Weights()) == want


def test_texts_without_markup_and_cut_pages():
    assert html.main_text("just words", html.Weights()) == "just words"
    assert html.main_text(_page(ARTICLE)[:-40], html.Weights()).startswith("A & B\nFirst")
    assert html.main_text("<" * 3000 + "p" * 3000, html.Weights()) != ""
    assert html.main_text(None, html.Weights()) == ""


def test_best_stretch():
    r = np.random.default_rng(0)
    for _ in range(200):
        scores = r.integers(-4, 5, r.integers(0, 12)).astype(float)
        first, end = html.best_stretch(scores)
        best = max([0.0, *[scores[i:j].sum() for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]])
        assert scores[first:end].sum() == best


def test_weights_keep_their_signs():
    weights = html.weigh({"word": (900, 100), "<p": (50, 2), "<li": (0, 40), "-nav": (0, 10)})
    assert weights.word > 0 and all(-2 <= w < 0 for w in weights.tags.values())
    assert weights.tags["<li"] < weights.tags["<p"]
    assert html.weigh({}) == html.Weights()


def test_extract_text(spark):
    rows = [(1, "u", _page(MENU + ARTICLE + FOOT)), (1, "u", _page(MENU + ARTICLE + FOOT)), (2, None, None),
            (None, "u", ""), (3, "u", _page("<article><p>" + "word " * 50000 + "</p></article>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = html.fit_weights(pages)
    got = html.extract_text(pages.withColumnRenamed("url", "TEXT"), weights)
    assert got.columns == ["page_id", "text", "n_chars"]
    found = sorted(((r.page_id or 0, r.n_chars, r.text[:40]) for r in got.collect()))
    assert found == [(0, 0, ""), (1, len(WANT), WANT[:40]), (1, len(WANT), WANT[:40]), (2, 0, ""),
                     (3, 249999, ("word " * 8))]
    assert html.extract_text(pages.limit(0), html.fit_weights(pages.limit(0))).collect() == []


def test_given_pages_keep_their_articles_only(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = html.extract_text(pages, html.fit_weights(pages)).join(pages.select("page_id", "html"), "page_id")
    for row in texts.collect():
        inside = row.html.split("<article>")[1].split("</article>")[0]
        words = html.html.unescape(inside.replace("<", " <").replace(">", "> ")).split()
        want = [w for w in words if w not in ("<p>", "</p>", "<b>", "</b>", "<br>", "<h1>", "</h1>")]
        assert row.text.split() == want


@pytest.mark.parametrize("body, want", [
    ('<article><p class="notice">Note<p>Real one</p><p>Real two</p></article>', "Real one\nReal two"),
    ('<article><p>Real one<p class="notice">Note<p>Real two<p>Real three</article>',
     "Real one\nReal two\nReal three"),
    ('<article><p class="notice">Note <b>this<div>Real one</div><p>Real two</article>', "Real one\nReal two"),
    ('<article><ul><li class="ad">Buy<ul><li>now<li>here</ul><li>One<li>Two</ul><p>Three</article>',
     "One\nTwo\nThree"),
    ('<article><ul><li>One<li class="ad">Buy</ul><p>Two and more words</article>', "One\nTwo and more words"),
    ('<article><dl><dt class="ad">Buy<dd>One<dt>Two<dd class="ad">Now</dl>Three and four</article>',
     "One\nTwo\nThree and four"),
    ('<article><table><tr class="ad"><td>Buy<p>it<td>now<tr><td class="ad">Ad<td>One<tr><td>Two</table>'
     "Three and four</article>", "One\nTwo\nThree and four"),
    ('<article><table><tr><td class="ad"><table><tr><td>Buy<tr><td>now</table>it<td>One</table>Two words'
     "</article>", "One\nTwo words"),
    ('<article><div><nav>menu without end</div><p>One</p></article>', "One"),
    ('<article><p>One <span class="ad">buy</p><p>Two</p></article>', "One\nTwo"),
    ('<article><div class="ad"><div>buy</div></p></b>now</div>One and more</article>', "One and more")])
def test_left_out_elements_end_without_end_tags(body, want):
    assert html.main_text(_page(body), html.Weights()) == want


LONG = "<p>" + " ".join(f"word{i}" for i in range(60)) + "</p>"
TEXT = LONG[3:-4]


@pytest.mark.parametrize("body, want", [
    (f'{MENU}<div class="content has-sidebar">{LONG}{LONG}</div>{FOOT}', [TEXT, TEXT]),
    (f'<div class="entry-content social-share-enabled">{LONG}</div>', [TEXT]),
    (f'<div class="entry-content social">{LONG}</div><p>end', [TEXT, "end"]),
    (f'<div class="widget">{LONG}<div class="ad">buy</div>{LONG}</div>', [TEXT, TEXT]),
    (f"<article>{f'<div class=\"elementor-widget elementor-widget-text-editor\">{LONG}</div>' * 6}</article>",
     [TEXT] * 6),
    (f'<article>{LONG}<div class="elementor-widget-text-editor">{LONG}</div>{LONG}</article>', [TEXT] * 3),
    (f'<article>{LONG}{LONG}<div class="elementor-widget-text-editor">{LONG}</div></article>', [TEXT] * 3),
    (f"<article>{f'<div class=widget>{LONG}</div>' * 5}</article>", [TEXT] * 5),
    (f'<article>{LONG}</article><div id="comments">{LONG * 5}</div>', [TEXT]),
    (f'<article>{LONG}<div class="ad-slot">buy</div>{LONG}<div class="share-buttons">x</div></article>',
     [TEXT, TEXT]),
    (f'<div class="my-cookie-hint">We bake</div>{LONG}<div class="site-footer">me</div>', [TEXT]),
    (f'<div class="sidebar"><div class="widget">a <p class="ad">b</div>c</div>{LONG}', [TEXT]),
    (f'<div role="navigation">{LONG}</div><p>rest', ["rest"])])
def test_elements_are_left_out_by_whole_names_of_small_parts(body, want):
    assert html.main_text(_page(body), html.Weights()).split("\n") == want
