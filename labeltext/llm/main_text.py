"""Main text of web pages by line-block distribution.

Markup is stripped so that every block of the page with text is a line; what is never an article
(menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts) leaves no
line. The text lengths of the lines are summed over a sliding window: where the sum reaches
``SURGE``, or the page's largest sum if that is less, a region of text has begun; where it is
zero, the region ends. The region starts at its surge, or at the last heading before it that
no dive parts from it. All lines of a region are kept, whatever their size, so table rows, short
sections and the text around an advert stay.

Links count nothing towards the sums, so menus that aren't marked never surge and long ones end
a region. If the page marks its article, the sums run over the lines outside the marks too, but
those count nothing, so that they part what is marked into regions; the mark vouches for the
lines inside, so links count there too. A region of marked lines begins where the last one ended
and is kept whole if it surges; marked teasers that stand apart from the article don't.

A class or id that names what is no article is believed unless the block holds the page's first
heading or a marked main part, or, where the name may also be that of a wrapper (``search``,
``social``, ``header``), a marked article or at least half of the page's text.

Character references are decoded, white space inside a line becomes one space, lines are
joined by an empty line. Null html gives an empty text. Each row is judged by itself; columns
besides page_id, url and html are ignored."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Lines of a window, and the characters in a window that make a surge.
WINDOW, SURGE = 3, 80
# The share of the page's text from which on a block isn't taken away for a doubtful name.
MOST = 0.5

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*+)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "title"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "ruby", "rt", "rp",
}
NEVER = {"nav", "aside", "footer", "form", "button", "select", "dialog", "head", "menu"}
ARTICLE = {"article", "main"}
# Words in class, id or role that mark what is no article.
AWAY = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup",
    "promo", "related", "replies", "respond", "share", "sharing", "sidebar", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "contentinfo", "complementary", "search",
}
# Those of them that no wrapper of an article has, however long the block is.
SURELY = {"comment", "comments", "disqus", "replies", "respond", "consent", "cookie", "cookies"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
WORD = re.compile(r"[a-z]+")


class Line(NamedTuple):
    """A line's text, the characters of links in it, whether it is a heading, and whether a
    mark of the article holds it."""

    text: str
    linked: int
    heading: bool
    marked: bool


def _away(tag: str, attributes: str, in_article: bool) -> str:
    """Whether a tag opens what is no article: '' if not, 'surely', or 'perhaps' if only a name
    says so that an article's wrapper might have too, 'named' if it is one of ``SURELY``."""
    if tag in NEVER or (tag == "header" and not in_article):
        return "surely"
    if tag in ARTICLE or tag in INLINE or tag in ("body", "html"):
        return ""
    words = {
        word for value in ATTRIBUTE.findall(attributes) for word in WORD.findall(value.lower())
    }
    return "named" if words & SURELY else "perhaps" if words & AWAY else ""


def _tags(page: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, '' or '/' , name, attributes) of the tags; comments have no name. What
    stands inside raw elements is part of their opening tag."""
    out, at = [], 0
    while m := TAG.search(page, at):
        close, name, attributes = m[1] or m[4] or "", (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        end = m.end()
        if name in RAW and not close and not attributes.endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, end)
            end, name = (stop.end(), "") if stop else (end, "")
        out.append((m.start(), end, close, name, attributes))
        at = end
    return out


def _ends(tags: list) -> dict[int, int]:
    """For each opening tag that has its closing tag, the closing tag's number."""
    opened: dict[str, list[int]] = {}
    found = {}
    for k, (_, _, close, name, _) in enumerate(tags):
        if name and not close and name not in VOID:
            opened.setdefault(name, []).append(k)
        elif close and opened.get(name):
            found[opened[name].pop()] = k
    return found


class _Blocks:
    """What the blocks of a page hold: text, the first heading, marked parts."""

    def __init__(self, page: str, tags: list, ends: dict[int, int]):
        gaps = [0] * (len(tags) + 1)
        for k in range(1, len(tags)):
            gaps[k + 1] = len(page[tags[k - 1][1] : tags[k][0]].strip())
        self.before = list(accumulate(gaps))
        self.ends = ends
        opened = [k for k, t in enumerate(tags) if not t[2]]
        heading = [k for k in opened if tags[k][3] == "h1" and k in ends][:1]
        self.main = heading + [k for k in opened if tags[k][3] == "main" and k in ends]
        self.main.sort()
        self.articles = [k for k in opened if tags[k][3] == "article" and k in ends]

    def _holds(self, k: int, those: list[int]) -> bool:
        at = bisect_left(those, k + 1)
        return at < len(those) and those[at] < self.ends[k]

    def wraps(self, k: int, away: str) -> bool:
        """Whether block ``k`` wraps the article, whatever its name says."""
        if away == "surely" or k not in self.ends:
            return False
        if self._holds(k, self.main):
            return True
        text = self.before[self.ends[k] + 1] - self.before[k + 1]
        return away == "perhaps" and (
            self._holds(k, self.articles) or text >= MOST * max(1, self.before[-1])
        )


def lines_of(page: str) -> tuple[list[Line], bool]:
    """The page's lines that may be text, and whether the page marks its article."""
    tags = _tags(page)
    ends = _ends(tags)
    blocks = _Blocks(page, tags, ends)
    marked = {k for k, t in enumerate(tags) if t[3] in ARTICLE and not t[2] and k in ends}
    lines: list[Line] = []
    parts: list[str] = []
    linked = 0
    skip_to = link_to = heading_to = -1
    skip_block = False
    inside: list[int] = []
    body = next((k for k, t in enumerate(tags) if t[3] == "body" and not t[2]), -1)

    at = 0
    for k, (start, end, close, name, attributes) in enumerate([*tags, (len(page), len(page), "", "html", "")]):
        shown = k > body and skip_to < 0 and not skip_block
        if shown and start > at:
            parts.append(page[at:start])
            if link_to >= 0:
                linked += len(page[at:start].strip())
        at = end
        if not name:
            continue
        if k >= link_to:
            link_to = -1
        block = name not in INLINE
        if name == "br":
            parts.append("\n")
            continue
        if block:
            if skip_block and not (close and name == "p" and skip_to >= 0):
                skip_block = False
            if text := " ".join(html.unescape("".join(parts)).split()):
                lines.append(Line(text, min(linked, len(text)), k <= heading_to, bool(inside)))
            parts, linked = [], 0
        if inside and k == inside[-1]:
            inside.pop()
        if skip_to >= 0:
            if k >= skip_to:
                skip_to = -1
            continue
        if close:
            continue
        if name in HEADINGS and k in ends:
            heading_to = ends[k]
        if k in marked:
            inside.append(ends[k])
        elif name == "a" and k in ends:
            link_to = ends[k]
        elif (away := _away(name, attributes, bool(inside))) and not blocks.wraps(k, away):
            if k in ends:
                skip_to = ends[k]
            elif block and name not in VOID:
                # Never closed: it ends with the next block.
                skip_block = True
    return lines, bool(marked)


def block_sums(lengths: list[int]) -> list[int]:
    """For each line, the lengths of it and the next lines of a window."""
    before = [0, *accumulate(lengths)]
    return [before[min(k + WINDOW, len(lengths))] - before[k] for k in range(len(lengths))]


def regions(lengths: list[int], surge: int = SURGE) -> list[tuple[int, int, int]]:
    """(last dive, surge point, dive point) of each region: the first line whose window reaches
    ``surge``, or the largest sum if that is less, and the next whose window holds nothing."""
    sums = block_sums(lengths)
    level = max(1, min(surge, max(sums, default=0)))
    found, start, last = [], -1, 0
    for k, total in enumerate(sums):
        if start < 0 and total >= level:
            start = k
        elif not total:
            if start >= 0:
                found.append((last, start, k))
            start, last = -1, k + 1
    return [*found, (last, start, len(sums))] if start >= 0 else found


def main_text(page: str) -> str:
    lines, marked = lines_of(page)
    kept: list[str] = []
    if marked:
        spans = regions([len(x.text) if x.marked else 0 for x in lines])
    else:
        spans = regions([len(x.text) - x.linked for x in lines])
    for last, start, end in spans:
        if marked:
            kept += [x.text for x in lines[last:end] if x.marked]
            continue
        while lines[start].linked == len(lines[start].text):
            start += 1
        headings = [k for k in range(last, start) if lines[k].heading]
        kept += [x.text for x in lines[headings[0] if headings else start : end]]
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").cast(pa.int64()),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )
