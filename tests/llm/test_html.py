"""Main text of pages."""

import html
import random
import re

import numpy as np
import pytest

from strata.llm import queries
from strata.llm.html import SURGE, WINDOW, between_surge_and_dive, extract_text, main_text, page_lines

LONG = "This paragraph is long enough to be a surge in the distribution of text over the lines of a page, on its own."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style>", ""),
        ("plain text only", "plain text only"),
        ("<article><p>a &amp; b &lt;c&gt; &#233;&nbsp;d</p></article>", "a & b <c> é d"),
        ("<ARTICLE><P>One<P>Two<br>lines</ARTICLE>", "One\nTwo lines"),
        ("<main><h1>T</h1><p>x\n  y\t z</p></main><footer>f</footer>", "T\nx y z"),
        ("<nav><a href=x>m</a></nav><div class='ad'>buy</div><article>in</article><aside>s</aside>", "in"),
        ("<article><header><h1>T</h1><p>by</p></header><p>a <a href='q>r'>li<b>n</b>k</a> &lt; 3</p></article>", "T\na link < 3"),
        ("<article><p>a</p><div class='cookie-notice'>c</div><form>f<input></form><p>b</p></article>", "a\nb"),
        ("<article><p>a</p><div id=comments><article class=comment><p>no</p></article></div></article>", "a"),
        ("<article><p>a</p><!-- <p>b</p> --><p>c", "a\nc"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <a href=", "cut"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one\ntwo\nx\ny"),
        ("<article><p>1 < 2 and a<b</p></article>", "1 < 2 and a"),
        ("<div role=navigation>n</div><article>t</article><div role='contentinfo'>f</div>", "t"),
        ("<body class='has-sidebar'><div class='sidebar'>s</div><div class='content'><p>t</p></div></body>", "t"),
        ("<article><noscript>n</noscript><svg><text>s</text></svg><p hidden>h</p><p>t</p></article>", "t"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_surge_and_dive_without_an_article():
    menu = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(9))
    page = f"<ul>{menu}</ul><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><ul>{menu}</ul><p>tiny</p>"
    assert main_text(page) == "\n".join(["Title", LONG, "Short.", LONG])
    assert main_text("<p>short page</p>") == "short page"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>a <svg class='i' viewBox='0 0 1 1'/> b</p><p>c</p></article>", "a b\nc"),
        ("<article><p>a <SVG /> b</p><svg><text>no</text></svg><p>c</p></article>", "a b\nc"),
        ("<article><p>a <math/> b</p><p>c <svg><path d='x'/></svg> d</p></article>", "a b\nc d"),
        ("<article><p>a</p><svg width=1><path d='x'><p>b</p></article>", "a\nb"),
    ],
)
def test_text_after_an_icon_stays(page, text):
    assert main_text(page) == text


def test_plain_boilerplate_beside_an_unmarked_text_goes():
    menu, foot = [f"Menu {i}" for i in range(5)], [f"Notice {i}" for i in range(5)]
    text = ["Title", LONG, "Short.", "Shorter.", "Short again.", "More.", LONG, "The end."]
    got = main_text("".join(f"<p>{x}</p>" for x in menu + text + foot)).split("\n")
    # A window has three lines, so one short line of either side comes along.
    assert got == ["Menu 4", *text, "Notice 0"]
    page = "".join(f"<p>{x}</p>" for x in menu) + "<article>" + "".join(f"<p>{x}</p>" for x in ["a", "b", "c", "d", LONG, *"efgh"]) + "</article>"
    assert main_text(page).split("\n") == ["a", "b", "c", "d", LONG, *"efgh"]


def test_short_lines_and_long_pages_stay():
    blocks = [f"p{i}" if i % 3 else LONG for i in range(3000)]
    page = "<nav>m</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article><footer>f</footer>"
    assert main_text(page) == "\n".join(blocks)


def test_deep_and_broken_markup_ends():
    assert main_text("<div>" * 3000 + "x") == "x"
    assert main_text("<b>" * 3000 + "x" + "</i>" * 3000) == "x"
    assert page_lines("</p></div>" * 100) == ([], [], [])


@pytest.mark.parametrize(
    "page, text",
    [
        ("<form><nav>n</nav><article><p>a</p><form>f</form></article></form>", "a"),
        (f"<form id=aspnet><p>{LONG}</p><p>b</p></form><p>c</p>", f"{LONG}\nb\nc"),
        ("<form><div class=content><p>a</p></div><input></form><p>x</p>", "a"),
        ("<div class='page-with-sidebar'><article>a</article></div>", "a"),
        ("<div class='layout sidebar-right'><p>a</p></div><div class='sidebar'>s</div>", "a"),
        ("<div class='node node-promoted'><article>a</article></div>", "a"),
        ("<p>skip</p><div class='sidebar'><article>all the text</article></div>", "all the text"),
        ("<article class='post ad-free'>a</article><article class='ad'>no</article>", "a"),
        ("<body class='box hidden md:block'><p class='is hidden x'>a</p><p data-x hidden>h</p></body>", "a"),
        ("<body hidden><p title='so hidden it is'>a</p></body>", "a"),
        ("<div class='overlay'><p>nothing else</p></div>", "nothing else"),
        ("<article>the text<div class='widget'><article>a teaser</article></div></article>", "the text"),
        ("<article>a</article><div class='site-footer'>f</div><div class='relatedPosts'><article>r</article></div>", "a"),
    ],
)
def test_no_article_is_lost_under_a_dropped_ancestor(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>one</p></article><p>advert</p><article><p>second</p></article>", "one\nsecond"),
        (f"<div class=entry>{LONG}</div><hr><div class=content>b</div><p>f</p>", f"{LONG}\nb"),
        (f"<section class=content>{LONG}</section><p>x</p><p>y</p><p>z</p><section class=content>{LONG}</section>", f"{LONG}\n{LONG}"),
        (f"<article>{LONG}</article><article class='teaser-box'>t</article><article class=comment>c</article>", LONG),
        (f"<article>{LONG}</article><article><a href=x>Another article</a></article>", LONG),
        ("<p>x</p><article class=teaser><p>the only one</p></article>", "the only one"),
    ],
)
def test_an_article_in_several_parts(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "name",
    "user-comments reader-comments comments-wrapper comment-thread commentlist fb-comments CommentList ad-slot ad-container google-ad "
    "advertisement-wrapper adSlot consent-manager share-this related-content sub-menu left-sidebar sidebar-left cookie-consent-bar "
    "copyright-notice site-footer post-comments".split(),
)
def test_names_of_what_is_not_the_text(name):
    for page in (f"<article><p>a</p><div class='{name}'>no</div><p>b</p></article>", f"<article><p>a</p><section id={name}><p>no</p></section><p>b</p></article>"):
        assert main_text(page) == "a\nb"


@pytest.mark.parametrize("name", "ad-free has-comments no-sidebar commentary adventure shared-history widgetry comments-open noticeable header-image menuhin".split())
def test_names_that_only_look_like_it(name):
    assert main_text(f"<article><p>a</p><div class='{name}'>b</div></article>") == "a\nb"
    assert main_text(f"<article class='post {name}'>a</article>") == "a"


def test_content_called_after_an_advert():
    assert main_text("<div class='entry-content ad-layout'><p>a</p><div class=ad>no</div></div>") == "a"
    assert main_text("<div class='content comments'><p>no</p></div><div class=content>a</div>") == "a"


def test_no_marked_part_is_lost():
    three = "".join(f"<p>Plain line {i} of some length, not a menu.</p>" for i in range(3))
    page = f"<article><p>{LONG}</p></article>{three}<article><p>The end.</p></article>"
    assert main_text(page) == f"{LONG}\nThe end."
    page = "<article>a</article>" + three * 4 + "<article>b</article>" + three + "<article>c</article>"
    assert main_text(page) == "a\nb\nc"


def test_headings_before_an_unmarked_text_stay():
    page = f"<p>menu</p><p>menu</p><h1>Title</h1><h2>Sub</h2><p>Short.</p><p>Shorter.</p><p>{LONG}</p><p>{LONG}</p>"
    assert main_text(page) == "\n".join(["Title", "Sub", "Short.", "Shorter.", LONG, LONG])


def plain_lines(weights, headings):
    """Surge and dive by definition: one window after the other."""
    n = len(weights)
    windows = {e: sum(weights[max(0, e - WINDOW + 1) : e + 1]) for e in range(n + WINDOW - 1)}
    most = max(windows.values())
    if not most:
        return []
    kept, e = [], 0
    while e < len(windows):
        if not windows[e]:
            e += 1
            continue
        stop = e
        while stop in windows and windows[stop]:
            stop += 1
        lines = list(range(e, stop - WINDOW + 1))
        surges = [w for w in range(e, stop) if windows[w] >= min(SURGE, most)]
        if surges and most >= SURGE:
            inner = [i for i in lines if surges[0] - WINDOW < i <= surges[-1] and weights[i]]
            begin = min([inner[0]] + [i for i in lines if headings[i] and i < inner[0]])
            kept += range(begin, inner[-1] + 1)
        elif surges:
            kept += lines
        e = stop
    return kept


def test_windows_against_their_definition():
    rng = random.Random(6)
    for _ in range(3000):
        n = rng.randrange(1, 30)
        weights = [rng.choice([0, 0, rng.randrange(20), rng.randrange(60), SURGE]) for _ in range(n)]
        headings = [w > 0 and rng.random() < 0.1 for w in weights]
        assert between_surge_and_dive(np.array(weights), np.array(headings)) == plain_lines(weights, headings)


def test_query_against_the_pages_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = queries.op9_html_text(spark, sf).collect()
    assert {r.page_id for r in out} == set(pages) and len(out) == len(pages)
    for r in out:
        article = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        article = re.sub(r"<[^>]*\Z", "", article)
        parts = re.split(r"</?(?:p|h1)[^>]*>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, _html int, text string"
    rows = [(1, None, None, 5, "old"), (None, "u", "<p>x</p>", None, None), (1, None, None, 5, "old")]
    out = extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(1, None, 5, ""), (1, None, 5, ""), (None, "u", None, "x")], key=str)
    assert extract_text(spark.createDataFrame([], schema)).count() == 0
