"""Main text of web pages by line-block distribution (operator 13).

1. *Strip markup.* A page becomes lines, one per block element; inline tags vanish, and
   character references are decoded. Parts that are never the article (menus, headers,
   footers, side bars, notices, adverts, forms, scripts, styles, reader comments) are cut
   out and leave ``WINDOW`` empty lines, so that no window spans them.
2. *Sum text lengths over windows* of ``WINDOW`` lines. Only text outside links has a
   length. Where a page marks its article (``<article>``, ``<main>``), a line inside
   weighs at least ``SURGE`` and a line outside nothing, so that the shortest paragraph
   of an article is still above the line and the longest advert outside it is not.
3. *Surge and dive points.* Text starts at the line where the window sum first reaches
   the surge value (half the page's largest sum, if no sum reaches it) and ends where the
   sum falls to zero; lines in between are kept, also short ones, but for lines of links
   at either end.

A page is parsed in one forward pass; every page is a row of its own, nothing is shuffled.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import map_arrow

WINDOW = 3          # lines of a window
SURGE = 80          # characters in a window where running text begins

_MARK = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])")
_NAME = re.compile(r"[^\s/>]+")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_CAPITAL = re.compile(r"[A-Z]")
_PART = re.compile(r"[^a-z0-9]+")

RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
DROPPED = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "noscript", "template",
           "button", "select", "datalist", "svg", "math", "object", "canvas", "audio",
           "video", "iframe", "map"}
MAIN = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCK = HEADING | MAIN | DROPPED - {"button", "select", "svg", "math"} | {
    "address", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "header", "hgroup", "hr", "html", "legend", "li", "ol",
    "p", "pre", "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
# a new one of these ends an open one of the same list
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
            "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog",
         "alertdialog", "alert", "form", "menu", "menubar"}
# first or last part of a class or id that names a part beside the article
HINTS = {"ad", "ads", "adsense", "advert", "adverts", "advertisement", "sponsor", "sponsored",
         "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice",
         "notices", "notification", "alert", "popup", "modal", "newsletter", "subscribe",
         "subscription", "signup", "login", "menu", "nav", "navbar", "navigation", "breadcrumb",
         "breadcrumbs", "sidebar", "aside", "widget", "header", "masthead", "footer",
         "copyright", "comment", "comments", "disqus", "replies", "respond", "share", "sharing",
         "social", "related", "recommended", "recommendations", "pagination", "pager", "toolbar"}
COMMENTS = {"comment", "comments", "reply", "replies"}
NOT_A_PART = {"has", "with", "no", "without"}       # "with-sidebar" is no side bar


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), references.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _hinted(names: str, hints: set[str]) -> bool:
    for name in names.split():
        name = _CAPITAL.sub(lambda m: "-" + m[0], name) if not name.isupper() else name
        parts = [p for p in _PART.split(name.lower()) if p]
        if parts and parts[0] not in NOT_A_PART and (parts[0] in hints or parts[-1] in hints):
            return True
    return False


def _is_dropped(name: str, raw: str) -> bool:
    """Whether an element and all in it stand beside the article."""
    if name in DROPPED:
        return True
    if not raw or raw.isspace() or name in ("html", "body"):
        return False
    a = _attributes(raw)
    names = f"{a.get('class', '')} {a.get('id', '')}"
    if "hidden" in a or a.get("aria-hidden") == "true" \
            or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    if name in MAIN:
        return _hinted(names, COMMENTS)
    return a.get("role", "").lower() in ROLES or _hinted(names, HINTS)


def _tokens(page: str):
    """(text, tag, attributes, closing) in page order; text has no tag. Linear: a quote
    that is never closed does not hide the ``>`` of its tag."""
    at, end = 0, len(page)
    last = {q: page.rfind(q) for q in "\"'"}
    while at < end:
        m = _MARK.search(page, at)
        if m is None:
            yield page[at:], None, "", False
            return
        if m.start() > at:
            yield page[at:m.start()], None, "", False
        if m[0] == "<!--":
            stop = page.find("-->", m.start() + 2)
            at = end if stop < 0 else stop + 3
            continue
        if m[0][1] in "!?":
            stop = page.find(">", m.end())
            at = end if stop < 0 else stop + 1
            continue
        closing = m[0][1] == "/"
        name = _NAME.match(page, m.end() - 1)
        i = name.end()
        while True:
            i = _PLAIN.match(page, i).end()
            if i >= end or page[i] == ">":
                break
            i = page.find(page[i], i + 1) + 1 if last[page[i]] > i else i + 1
        tag = name[0].lower()
        at = i + 1
        if i >= end:                    # the page ends inside the tag: there is no such tag
            return
        yield "", tag, page[name.end():i], closing
        if tag in RAW and not closing:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            if stop is None:
                return
            at = stop.start()


class _Lines:
    """Collects the lines of a page: text, length outside links, inside the article."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool]] = []
        self.text: list[str] = []
        self.linked = 0

    def end_line(self, main: bool) -> None:
        if not self.text:
            return
        line = " ".join(references.unescape("".join(self.text)).split())
        if line:
            own = len(line) - self.linked
            self.lines.append((line, own if 5 * own > len(line) else 0, main))
        self.text, self.linked = [], 0

    def gap(self) -> None:
        self.lines.extend([("", 0, False)] * WINDOW)


class _Open:
    """The open elements of a page, with the place of the innermost of each name."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []   # element, dropped, begins an article
        self.places: dict[str, list[int]] = {}
        self.dropped = self.main = self.headers = 0

    def push(self, name: str, drop: bool, begins: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, drop, begins))
        self.dropped += drop
        self.main += begins
        self.headers += drop and name == "header" and self.main > 0

    def pop(self) -> tuple[str, bool]:
        name, drop, begins = self.stack.pop()
        self.places[name].pop()
        self.headers -= drop and name == "header" and self.main > 0
        self.dropped -= drop
        self.main -= begins
        return name, drop

    def depth(self, names: tuple[str, ...], stops: tuple[str, ...] = ()) -> int | None:
        """Place of the innermost open element of ``names`` that no ``stops`` shields."""
        at = max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)
        shield = max((self.places[n][-1] for n in stops if self.places.get(n)), default=-1)
        return at if at > shield else None

    def only_header(self) -> bool:
        """Everything dropped around is a ``<header>`` inside an article."""
        return self.main > 0 and self.dropped == self.headers

    def heading(self) -> bool:
        return bool(self.stack) and self.stack[-1][0] in HEADING


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """The lines of a page, markup stripped; dropped parts leave ``WINDOW`` empty lines."""
    out, open_ = _Lines(), _Open()

    def close(to: int | None) -> None:
        while to is not None and len(open_.stack) > to:
            inside = open_.main > 0
            name, drop = open_.pop()
            if not drop and not open_.dropped and name in BLOCK:
                out.end_line(inside)

    for text, tag, raw, closing in _tokens(page):
        if tag is None:
            # in a header of the article only its headings belong to the text
            if not open_.dropped or (open_.heading() and open_.only_header()):
                out.text.append(text)
                if open_.places.get("a"):
                    out.linked += len(" ".join(text.split()))
            continue
        if closing:
            if tag in HEADING and open_.dropped and open_.only_header():
                out.end_line(True)
            close(open_.depth((tag,), ("table",) if tag in ("td", "th", "tr", "li", "p") else ()))
            continue
        if tag in ("br", "td", "th"):
            out.text.append(" ")
        if tag in BLOCK:
            close(open_.depth(("p",), ("table", "button", "td", "th")))
            if not open_.dropped:
                out.end_line(open_.main > 0)
        if tag in SIBLINGS:
            close(open_.depth(ALIKE.get(tag, (tag,)), SIBLINGS[tag]))
        elif tag == "a":
            close(open_.depth(("a",), ("table", "td", "th")))
        if tag in VOID:
            continue
        drop = tag == "header" or tag in RAW or _is_dropped(tag, raw)
        if drop and not open_.dropped and tag in BLOCK:
            out.gap()
        open_.push(tag, drop, tag in MAIN and not drop and not open_.dropped)
    close(0)
    out.end_line(False)
    return out.lines


def text_blocks(lines: list[tuple[str, int, bool]], window: int = WINDOW,
                surge: int = SURGE) -> list[str]:
    """Lines between the surge and dive points of the window sums."""
    article = any(main for _, _, main in lines)
    weight = [max(n, surge) if main else 0 if article else n for _, n, main in lines]
    n = len(weight)
    sums, total = [0] * n, 0
    for i in range(n - 1, -1, -1):
        total += weight[i] - (weight[i + window] if i + window < n else 0)
        sums[i] = total
    top = max(sums, default=0)
    if not top:
        return []
    at_least = min(surge, (top + 1) // 2)
    out, i = [], 0
    while i < n:
        if sums[i] < at_least:
            i += 1
            continue
        first = i
        while i < n and sums[i]:
            i += 1
        last = i - 1
        while not weight[first]:        # links before the surge belong to no text
            first += 1
        while not weight[last]:
            last -= 1
        out += [line for k, (line, _, _) in enumerate(lines[first:last + 1], first)
                if line and (weight[k] or not article)]
    return out


def main_blocks(page: str | None) -> list[str]:
    """Blocks of the main text of one page, in page order."""
    return text_blocks(lines_of(page)) if page else []


def _extract(batches):
    for b in batches:
        found = [main_blocks(p) for p in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"),
             pa.array(found, pa.list_(pa.string()))], names=["page_id", "url", "blocks"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page: ``page_id, url, blocks`` (array of strings, page order).

    Blocks are block elements of the article (headings, paragraphs, list items, table
    rows); white space inside a block, line breaks and no-break blanks included, is one
    blank; character references are decoded.

    Needs ``page_id``, ``url`` and ``html``; other columns are ignored. Defined cases: a null or empty
    html, or a page of links alone, has no blocks; null page_id and url are passed on; rows
    that repeat each get their row; an element left open ends with its parent, a comment
    or script left open takes the rest of the page (as browsers do), a tag cut off by the
    end of the page is no text; very long pages are read whole, in linear time and one at
    a time; an empty table gives no rows. There are no ties: blocks keep the page's order.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_arrow(rows, _extract, f"page_id {kind}, url string, blocks array<string>", 200)


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the blocks joined by two line feeds."""
    text = F.array_join("blocks", "\n\n")
    return extract_pages(pages).select("page_id", "url", text.alias("text"),
                                       F.length(text).cast("long").alias("n_chars"))


# The given pages have one article each, of headings and paragraphs.
ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS part
  FROM pages),
b AS (
  SELECT page_id, url, list_filter(list_transform(
    string_split_regex(part, '</?(?:h1|p)>'),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(
           regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '</?b>', '', 'g'),
           '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''),
         '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM a),
c AS (
  SELECT page_id, url, regexp_replace(coalesce(array_to_string(blocks, chr(10) || chr(10)), ''),
                                      '&amp;?', '&', 'g') AS text
  FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
"""
