"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element, in page order.  Scripts,
styles, comments and the containers that hold menus, site headers, footers,
sidebars, notices, adverts, forms and reader comments (by element, role, or a
name in class or id) give no lines.  Each line weighs the length of its
text that isn't link text.  The weights are summed over sliding windows of
lines; the text starts where the sum surges over the threshold and ends where it
dives to nothing, and all lines between such points are kept, short ones
included.  The threshold is the same on all pages, but at most half of the page's
largest window, so that a short article is found as well.

Where the page declares an article (``article``, ``main``), the larger surge
decides between its lines and those outside: lines of the other side weigh
nothing.  A surge inside the article reaches back to the lines of text before it,
as the article's start is known.  The text of a form counts only on a page that
has no other text: then the form wraps the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_LINES = 3
SURGE = 80            # characters in a window

# What the HTML elements are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr").split())
UNSEEN = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "select", "title")
BOILER = frozenset("nav footer aside form button menu dialog fieldset legend datalist option audio video".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
BOILER_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert newsletter subscribe subscription signup login sidebar side rail widget menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer comment comments commentlist disqus respond replies reply share sharing "
    "social related recommended popular trending popup modal overlay disclaimer masthead topbar toolbar skip").split())
HEADER_WORDS = frozenset("header masthead".split())
#: What an article element inside or beside the main one may be instead.
NOT_ARTICLE_WORDS = frozenset("ad ads advert comment comments reply respond related recommended promo sponsored teaser".split())
CONTENT = frozenset(("article", "main"))

DROP = re.compile(r"<!--.*?(?:-->|$)|<(" + "|".join(UNSEEN) + r")\b[^>]*>.*?(?:</\1\s*>|$)|<[!?][^>]*>", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>")
MARKED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Words that say where or what kind of box a name means; with them a name of boilerplate stays one.
BOX_WORDS = frozenset((
    "area bar block body bottom box btn button card cell col column container content div feed field fixed footer form group "
    "header inner item items left link links list main module page panel position posts primary right row secondary section "
    "site slot small sticky strip text top unit wrap wrapper zone").split())
DOUBT = 4             # lines under a name that boilerplate words are only a part of weigh a quarter


def _named(value: str, words: frozenset) -> int:
    """What the names in a class or id say: 2 if one of them means ``words``, 1 if one only mentions them, else 0."""
    most = 0
    for name in value.split():
        own = {w.lower() for w in WORD.findall(name) if len(w) > 1}
        if own & words:
            most = max(most, 2 if own <= words | BOX_WORDS else 1)
    return most


FORM = "form"


def _verdict(tag: str, attributes: str, in_content: bool) -> tuple[int, bool]:
    """(2 boilerplate, 1 perhaps, 0 not; article) of a container by its element and attributes."""
    if (tag in BOILER and tag != FORM) or (tag == "header" and not in_content):
        return 2, False
    content, doubt = tag in CONTENT, 0
    if attributes:
        for name, value in MARKED.findall(attributes):
            value = value.strip("\"'")
            name = name.lower()
            if name == "role":
                if value.lower() in BOILER_ROLES - {FORM}:
                    return 2, False
                content |= value.lower() in CONTENT
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return 2, False
            elif name == "itemprop":
                content |= value.lower() == "articlebody"
            elif tag not in ("html", "body"):
                says = _named(value, NOT_ARTICLE_WORDS if content else BOILER_WORDS)
                if not content and not in_content:
                    says = max(says, _named(value, HEADER_WORDS))
                if says == 2:
                    return 2, False
                doubt = max(doubt, says)
    return doubt, content


def _is_form(tag: str, attributes: str) -> bool:
    return tag == FORM or any(n.lower() == "role" and v.strip("\"'").lower() == FORM for n, v in MARKED.findall(attributes or ""))


#: What holds for the lines inside an element: they are boilerplate, perhaps boilerplate, in the article, in a form.
NOTHING = (False, False, False, False)


def lines_of(html: str) -> tuple[list[tuple[str, int, bool, bool]], bool]:
    """Lines (text, weight, inside the declared article, inside a form) and whether the page declares an article."""
    html = DROP.sub(" ", html)
    lines: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, tuple]] = []
    linked = links = at = 0
    dropped, doubtful, content, in_form = NOTHING
    paragraph = 0                                     # verdict of the open p
    declared = False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                weight = max(0, len(text) - linked)
                lines.append((text, weight // DOUBT if (doubtful or paragraph == 1) and not content else weight, content, in_form))
            parts.clear()
        linked = 0

    for m in TAG.finditer(html):
        if m.start() > at and not dropped and paragraph < 2:
            piece = html[at:m.start()]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        at = m.end()
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br" and not dropped:
                parts.append(" ")
            continue
        flush()
        links = paragraph = 0
        if tag == "p" and not closing and attributes:
            paragraph = _verdict(tag, attributes, content)[0]
        if tag in VOID or tag == "p":
            continue
        if closing:
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
        else:
            if tag in CONTENT and not declared:       # the article doesn't lie inside a menu that somebody forgot to close
                while stack and stack[-1][1][0]:
                    stack.pop()
                dropped, doubtful, content, in_form = stack[-1][1] if stack else NOTHING
            boiler, article = _verdict(tag, attributes, content)
            declared |= article
            stack.append((tag, (dropped or boiler == 2, doubtful or boiler == 1, content or article, in_form or _is_form(tag, attributes))))
        dropped, doubtful, content, in_form = stack[-1][1] if stack else NOTHING
    if not dropped and paragraph < 2:
        parts.append(html[at:])
    flush()
    return lines, declared


def main_lines(weights: list[int], window: int = WINDOW_LINES, surge: int = SURGE, anchored: bool = False) -> list[bool]:
    """Which lines lie between a surge point and the dive point after it.

    ``anchored``: the lines begin where the text does, so a surge reaches back
    over the lines of text right before it.
    """
    n = len(weights)
    sums = [sum(weights[i:i + window]) for i in range(n)]
    surge = max(1, min(surge, max(sums, default=0) // 2))
    keep = [False] * n
    i = done = 0
    while i < n:
        if sums[i] < surge or not weights[i]:
            i += 1
            continue
        start = end = i
        if anchored:
            start = next((j + 1 for j in range(i - 1, done - 1, -1) if not sums[j]), done)
            start = next(j for j in range(start, i + 1) if weights[j])
        while end < n and sums[end]:                  # dives where a whole window holds nothing
            end += 1
        while not weights[end - 1]:
            end -= 1
        keep[start:end] = [True] * (end - start)
        i = done = end
    return keep


def largest(weights: list[int]) -> int:
    """Weight of the largest stretch between a surge point and its dive point."""
    most = now = 0
    for w, kept in zip(weights, main_lines(weights), strict=True):
        now = now + w if kept else 0
        most = max(most, now)
    return most


def chosen(lines: list[tuple[str, int, bool]], declared: bool) -> list[bool]:
    """Which of the lines (text, weight, inside the article) are the main text."""
    if not declared:
        return main_lines([w for _, w, _ in lines])
    inside, outside = [w if i else 0 for _, w, i in lines], [0 if i else w for _, w, i in lines]
    within = largest(inside) >= largest(outside)
    own = [k for k, (_, _, i) in enumerate(lines) if i == within]      # a window never reaches over lines of the other side
    found = main_lines([lines[k][1] for k in own], anchored=within)
    keep = [False] * len(lines)
    for k, kept in zip(own, found, strict=True):
        keep[k] = kept
    return keep


def extract(html: str) -> str:
    """Main text of a page: its kept lines joined by blank lines ('' if there are none)."""
    lines, declared = lines_of(html)
    prose = [(text, w, i) for text, w, i, form in lines if not form]
    kept = chosen(prose, declared)
    if not any(kept):                                 # nothing but forms: they wrap the page
        prose = [(text, w, i) for text, w, i, _ in lines]
        kept = chosen(prose, declared)
    return "\n\n".join(text for (text, _, _), k in zip(prose, kept, strict=True) if k)


def extract_text(df: DataFrame, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``carry`` columns, ``text`` and ``n_chars`` (code points) per row.

    Defined cases: null or empty html, or a page without main text, gives the
    empty text; nulls in other columns pass through; repeated rows are kept;
    pages of any length are read whole; an empty table gives an empty result;
    extra columns are ignored unless carried.
    """
    rows = df.select(*[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)], F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    schema = rows.drop("_html").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [extract(h.as_py()) for h in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    [f.name for f in schema])

    return rows.mapInArrow(run, schema).select(*[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)], "text", "n_chars")
