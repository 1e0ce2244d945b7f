"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one for each block element. Text lengths are
summed over sliding windows of lines; the text begins where the sums surge to
the threshold and ends after the last sum that reaches it before they dive to
zero, and everything between is kept. Lines of menus, headers, footers,
sidebars, notices, adverts, forms and comments carry no length, nor does link
text. Where the page marks its article, the marking enters the distribution as
weight: a marked line is a surge by itself, however short, and lines outside
carry none, so the same windows find every marked part and what lies between
parts is a dive.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import free_name

WINDOW = 3  # lines in a window
SURGE = 86  # characters in a window that begin a text

# HTML element names.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes", "xmp", "template", "svg", "math", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
FOREIGN = {"svg", "math"}  # may close themselves
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
    "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
DROPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "button", "select", "search", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
IMPLIED_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# ARIA roles and words of class and id names of what is not the text.
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
# Words that say so wherever they stand in a name ("left-sidebar", "ad-slot", "fb-comments").
COMMENT_WORDS = {"comment", "comments", "commentlist", "commenting", "commenter", "commenters", "disqus"}
AD_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "sponsor", "sponsored", "sponsors"}
LAYOUT_WORDS = {"sidebar", "sidebars", "nav", "navbar", "navigation", "menu", "menus"}
STRONG_WORDS = COMMENT_WORDS | AD_WORDS | LAYOUT_WORDS | {
    "breadcrumb", "breadcrumbs", "consent", "cookie", "cookies", "gdpr", "newsletter", "pagination", "paywall", "popup", "modal", "masthead",
}
# Words that say so in a name made of them and ``QUALIFIERS`` alone ("site-footer", "related-content").
DROPPED_NAMES = STRONG_WORDS | {
    "banner", "disclaimer", "discussion", "footer", "header", "notice", "notification", "overlay", "promo", "promoted", "promotion",
    "related", "replies", "reply", "respond", "share", "sharing", "signup", "social", "subscribe", "subscription", "toolbar", "topbar",
    "widget", "widgets",
}
COMMENT_NAMES = COMMENT_WORDS | AD_WORDS | {"reply", "replies", "related", "promo"}
QUALIFIERS = {
    "area", "article", "articles", "bar", "block", "bottom", "box", "buttons", "column", "container", "content", "copyright", "entry", "form",
    "global", "holder", "inner", "item", "items", "left", "legal", "link", "links", "list", "main", "manager", "outer", "page", "panel", "post",
    "posts", "primary", "right", "secondary", "section", "site", "slot", "stories", "story", "this", "thread", "top", "unit", "wrap", "wrapper",
}
# Words that make a name say something about the element, not what it is ("ad-free", "has-comments").
ABOUT = {"with", "without", "has", "no", "not", "is", "js", "free", "open", "closed", "enabled", "disabled", "allowed", "off", "on"}
# Names of elements that lay out a page and are called after its sidebar or menu too.
LAYOUTS = {"layout", "page", "site", "wrapper", "container", "row", "grid", "columns"}
TEASER_NAMES = {"preview", "previews", "recommended", "teaser", "teasers", "trending"}
MAIN_NAMES = {
    "article", "article-body", "article-content", "article-text", "articlebody", "content", "content-body", "entry",
    "entry-content", "main", "main-content", "maincontent", "post", "post-body", "post-content", "story", "story-body",
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+|[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_BREAKOUT = re.compile(
    r"(?=</?(?:b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr|ol|p|pre"
    r"|ruby|s|small|span|strong|strike|sub|sup|table|tt|u|ul|var|article|section|main|header|footer|nav|aside)(?=[\s/>]))|\Z",
    re.I,
)
_NAME_PART = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")

# FORM_DROP: in a form outside the main text; NAME_DROP: in an element dropped for its name.
KEEP, DROP, HEADING_ONLY, FORM_DROP, NAME_DROP = 0, 1, 2, 3, 4
FORMS = {"form", "fieldset"}


def _names(value: str) -> tuple[set[str], set[str]]:
    """Names of a class or id attribute, and the words in them that say that the
    element is not the text: a strong word anywhere in a name, others where a name
    is made of them and qualifiers. A name that lengthens another one of the
    element ("node node-promoted") is a variant of it."""
    whole = value.split()
    lower = {w.lower() for w in whole}
    dropped: set[str] = set()
    for w in whole:
        parts = {p.lower() for p in _NAME_PART.split(w) if p}
        if parts & ABOUT or any(w.lower().startswith((o + "-", o + "_")) for o in lower):
            continue
        said = parts & DROPPED_NAMES
        dropped |= said if said and parts <= said | QUALIFIERS else parts & STRONG_WORDS
    if lower & LAYOUTS:
        dropped -= LAYOUT_WORDS
    if lower & MAIN_NAMES:  # a main text is called after something else only by a whole name
        dropped &= lower
    return lower, dropped


def _judge(name: str, attrs: str, in_main: bool, forms: bool = False, names: bool = True) -> tuple[int, int]:
    """(KEEP, DROP or HEADING_ONLY; 1 if the element marks the main text, -1 a teaser, else 0).
    ``forms``: keep forms; ``names``: heed class and id names of what is not the text."""
    if name in ("html", "body") or forms and name in FORMS:
        return KEEP, 0
    if name in DROPPED:
        return DROP, 0
    found: dict[str, str] = {}
    for k, a, b, c in _ATTR.findall(attrs) if attrs else ():
        found.setdefault(k.lower(), a or b or c)
    role = found.get("role", "").lower()
    if role in DROPPED_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return DROP, 0
    whole, dropped = _names(found.get("class", "") + " " + found.get("id", ""))
    if name == "header":
        return (HEADING_ONLY if in_main else DROP), 0
    main = -1 if any(TEASER_NAMES & set(_NAME_PART.split(w)) for w in whole) else 1
    if name in ("article", "main") or role in ("main", "article"):
        return (DROP, 0) if dropped & COMMENT_NAMES else (KEEP, main)
    if dropped and names:
        if dropped == {"header"} and in_main:
            return HEADING_ONLY, 0
        return (DROP if dropped & COMMENT_NAMES else NAME_DROP), 0
    return KEEP, main if whole & MAIN_NAMES or found.get("itemprop", "").lower() == "articlebody" else 0


def page_lines(page: str) -> tuple[list[str], list[int], list[int]]:
    """Lines of a page outside dropped elements, each with the length of its
    link text and the number of the outermost main element around it (0: none;
    negative: a teaser, or one inside an element that is dropped for its name)."""
    return _parse(page)[:3]


def _parse(page: str, forms: bool = False, names: bool = True) -> tuple[list[str], list[int], list[int], list[bool], int]:
    """What ``page_lines`` gives, whether a line is a heading, and the length of
    the unlinked text dropped in forms."""
    lines: list[str] = []
    headings: list[bool] = []
    linked: list[int] = []
    zones: list[int] = []
    open_: list[tuple[str, int, int]] = []  # (name, judgement, zone)
    text: list[str] = []
    unclosed: set[str] = set()  # svg, math: no end tag follows
    state, zone, count, links, link_chars, in_forms = KEEP, 0, 0, 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            lines.append(line)
            linked.append(min(link_chars, len(line)))
            zones.append(zone)
            headings.append(any(name in HEADINGS for name, _, _ in open_))
        text.clear()
        link_chars = 0

    def add(piece: str) -> None:
        nonlocal link_chars, in_forms
        if state == KEEP and piece:
            text.append(piece)
            if links:
                link_chars += len(" ".join(html.unescape(piece).split()))
        elif state == FORM_DROP and not links:
            in_forms += len(" ".join(html.unescape(piece).split()))

    def top() -> tuple[int, int]:
        return (open_[-1][1], open_[-1][2]) if open_ else (KEEP, 0)

    at = 0
    while (m := _TAG.search(page, at)) is not None:
        add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            add(" ")
        if name in VOID:
            continue
        if m["end"]:
            if name == "a":
                links = 0
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    del open_[k:]
                    state, zone = top()
                    break
                if name not in BLOCK and open_[k][0] in BLOCK:
                    break  # an inline end tag does not end a block
                if name in ("p", "li", "dd", "dt") and open_[k][0] in ("div", "article", "section", "main", "body", "nav", "aside", "td"):
                    break
            continue
        if name in FOREIGN and m["attrs"].endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?|\Z", re.I)
            stop = None if name in unclosed else end.search(page, at)
            if name in FOREIGN and not (stop and stop.group()):
                unclosed.add(name)
                stop = _BREAKOUT.search(page, at)  # HTML goes on at the next HTML element
            at = stop.end()
            continue
        if m["attrs"].endswith("/") and name not in BLOCK:
            continue
        if name == "a":
            links = 1
        ended = IMPLIED_END.get(name) or (IMPLIED_END["p"] if name in BLOCK else None)
        if ended:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] in ended:
                    del open_[k:]
                    state, zone = top()
                    break
                if open_[k][0] in BLOCK:
                    break
        was, (judged, marks) = state, _judge(name, m["attrs"], zone != 0, forms, names)
        if judged == DROP and name in FORMS:
            judged = FORM_DROP
        if was == DROP:
            judged = DROP
        elif was in (FORM_DROP, NAME_DROP):
            # A marked article in a form or in an element dropped for its name is still one;
            # a class name marks it in a form outside the main text only.
            by_tag = name in ("article", "main") or "role" in m["attrs"].lower()
            reopens = judged == KEEP and marks and (by_tag or was == FORM_DROP and not zone)
            if not reopens and judged not in (DROP, NAME_DROP):
                judged = was
        elif was == HEADING_ONLY and judged == KEEP:
            judged = KEEP if name in HEADINGS else HEADING_ONLY
        if name not in BLOCK and judged == was:
            continue  # inline elements matter only where they are dropped
        if marks and judged == KEEP and (not zone or was == NAME_DROP):
            count += 1
            zone = -count if marks < 0 or any(j == NAME_DROP for _, j, _ in open_) else count
        open_.append((name, judged, zone))
        state = judged
    add(page[at:])
    flush()
    return lines, linked, zones, headings, in_forms


def main_text(page: str | None) -> str:
    """The main text of one page, its lines joined by one newline."""
    if not page:
        return ""
    lines, linked, zones, headings, in_forms = _parse(page)
    if not any(zones) and in_forms > sum(map(len, lines)) - sum(linked):
        lines, linked, zones, headings, _ = _parse(page, forms=True)  # the form is the page
    if not lines:  # better what is named like a sidebar than nothing
        lines, linked, zones, headings, _ = _parse(page, forms=True, names=False)
    if not lines:
        return ""
    length, unlinked = np.array([len(x) for x in lines], np.int64), np.array(linked, np.int64)
    unlinked = length - unlinked
    marked = _marked(length, unlinked, np.array(zones))
    # What marks a line as the article makes it a surge by itself.
    weight = np.where(marked, np.maximum(length, SURGE), 0) if marked.any() else unlinked
    kept = between_surge_and_dive(weight, np.array(headings) & ~marked.any())
    return "\n".join(lines[i] for i in kept if weight[i] or not marked.any())


def _marked(length: np.ndarray, unlinked: np.ndarray, zone: np.ndarray) -> np.ndarray:
    """The lines of the parts that mark the article: all of them, but for teasers
    and for lists of links beside the longest."""
    aside = np.bincount(np.where(zone < 0, -zone, 0), weights=np.where(zone < 0, length, 0))
    if aside.max() > length[zone > 0].sum():  # the article is in an element named like a sidebar or teaser
        zone = np.where(zone == -aside.argmax(), -zone, zone)
    zone = np.maximum(zone, 0)
    if not zone.any():
        return zone > 0
    totals = np.bincount(zone, weights=length)
    whole = 2 * np.bincount(zone, weights=unlinked) >= totals
    totals[0], whole[0] = 0, False
    whole[totals.argmax()] = True
    return whole[zone]


def between_surge_and_dive(weight: np.ndarray, heading: np.ndarray) -> list[int]:
    """Numbers of the lines between surge and dive points of the distribution.

    The sums over windows of WINDOW lines rise from zero and fall back to it; of
    each such stretch the lines from the first window that reaches SURGE to the
    last one are kept, less lines without weight at either end, and the lines from
    the stretch's first heading before them on. Where no window reaches SURGE, the
    stretches with the greatest sum are kept whole.
    """
    sums = np.convolve(weight, np.ones(WINDOW, np.int64))  # sums[i]: lines i - WINDOW + 1 to i
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (sums > 0).astype(np.int8), [0]))))
    most = int(sums.max())
    least = min(SURGE, most)
    kept: list[int] = []
    for start, stop in edges.reshape(-1, 2).tolist():
        first, last = start, stop - WINDOW + 1  # the stretch's lines
        surging = np.flatnonzero(sums[start:stop] >= least) + start
        if not most or not len(surging):
            continue
        if least == SURGE:
            a, b = max(first, int(surging[0]) - WINDOW + 1), min(last, int(surging[-1]) + 1)
            weighted = np.flatnonzero(weight[a:b]) + a
            a, b = int(weighted[0]), int(weighted[-1]) + 1
            before = np.flatnonzero(heading[first:a])
            first, last = (first + int(before[0]) if len(before) else a), b
        kept += range(first, last)
    return kept


def extract_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """The columns of ``pages`` without its html, and the main text ``out``.

    A NULL or empty page gives the empty text, as does one without text
    outside what is dropped. Repeated rows give a row each; an empty table
    gives no rows. An input column already called ``out`` is replaced. Pages are
    read whole, one at a time, whatever their length.
    """
    kept = [c for c in pages.columns if c not in (html_col, out)]
    source = pages.select(*kept, F.col(html_col).cast("string").alias(free_name(pages, "_html")))
    schema = pages.select(*kept, F.lit("").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(kept))]
            columns = [batch.column(i) for i in range(len(kept))] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=kept + [out])

    return source.mapInArrow(run, schema)
