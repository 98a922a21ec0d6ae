"""Main text of web pages from text-to-tag ratios.

The standard library's parser is fed piece by piece and its events are turned into lines: the text
between two block-level tags. Each line has a text-to-tag ratio (its characters outside links over its
tags). Lines inside elements that are boilerplate by their nature (menus, footers, forms, adverts, reader
comments, ...) have ratio 0. Ratios are smoothed with a Gaussian; the smoothed ratio and its change are the
two features, and a threshold on their distance from the origin clusters the lines. A region grows from
content lines as far as ratios stay above 0. The element that holds the article, if the page marks one, cuts
off what reaches beyond it and closes gaps between regions inside it; it adds no region.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Elements that start and end a line.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never the article's.
DROPPED = frozenset("head title script style noscript template nav footer aside form menu dialog button select textarea iframe object svg canvas audio video math fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words of class and id names that mark boilerplate.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead "
    "topbar footer sidebar rail widget widgets related recommended share sharing social cookie cookies consent gdpr notice notices disclaimer newsletter subscribe subscription "
    "signup signin login popup modal overlay search pager pagination copyright banner toolbar skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
HOLDERS = frozenset(["article", "main"])
KERNEL = [math.exp(-(k * k) / 2) for k in range(-2, 3)]
PIECE = 1 << 16
#: Lines below this part of the threshold are flat; so many of them in a row end a region.
FLAT, FLAT_LINES = 0.1, 3


class Line:
    __slots__ = ("text", "tags", "linked", "dropped", "holder")

    def __init__(self, dropped: bool, holder: int):
        self.text, self.tags, self.linked, self.dropped, self.holder = [], 0, 0, dropped, holder


class Lines(HTMLParser):
    """Events to lines. An element that is never closed ends with the element around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, int, bool]] = []  # tag, dropped, number of the article element, in a link
        self.holders = 0
        self.line = Line(False, 0)

    def _state(self) -> tuple[bool, int, bool]:
        return self.open[-1][1:] if self.open else (False, 0, False)

    def _break(self) -> None:
        dropped, holder, _ = self._state()
        if self.line.text:
            self.lines.append(self.line)
        self.line = Line(dropped, holder)

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in BLOCKS:
                self._break()
            elif tag == "br":
                self.line.text.append("\n")
            self.line.tags += 1
            return
        if tag in BLOCKS:  # a block ends an open paragraph
            names = [o[0] for o in self.open]
            if "p" in names and tag not in ("td", "th", "tr", "tbody", "li", "dd", "dt", "option"):
                at = len(names) - 1 - names[::-1].index("p")
                if not any(n in BLOCKS for n in names[at + 1 :]):
                    del self.open[at:]
            if tag in ("li", "dd", "dt", "option", "td", "th", "tr") and names and self.open and self.open[-1][0] == tag:
                self.open.pop()
        dropped, holder, linked = self._state()
        if not dropped:
            dropped = self._boilerplate(tag, dict(attrs), holder)
        if tag in HOLDERS and not dropped and not holder:
            self.holders += 1
            holder = self.holders
        self.open.append((tag, dropped, holder, linked or tag == "a"))
        if tag in BLOCKS or dropped != self.line.dropped:
            self._break()
        self.line.tags += 1

    @staticmethod
    def _boilerplate(tag: str, attrs: dict, holder: int) -> bool:
        if tag in DROPPED or (tag == "header" and not holder):
            return True
        if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or (attrs.get("role") or "").lower() in ROLES:
            return True
        if tag in ("html", "body", "main") or tag not in BLOCKS and tag not in ("span", "a", "ins", "center"):
            return False
        words = set(re.split("[^a-z0-9]+", f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()))
        if words & COMMENTS:
            return True
        return tag not in HOLDERS and bool(words & (NAMES - {"header", "banner"} if holder else NAMES))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                break
            # inline end tags do not close blocks, and nothing inside closes the article
            if (tag not in BLOCKS and self.open[k][0] in BLOCKS) or (self.open[k][0] in HOLDERS and tag not in ("body", "html")):
                return
        else:
            return
        del self.open[k:]
        if tag in BLOCKS or self._state()[0] != self.line.dropped:
            self._break()

    def handle_data(self, data):
        self.line.text.append(data)
        if self._state()[2]:
            self.line.linked += len(data)


def smooth(values: list[float]) -> list[float]:
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for k, w in zip(range(i - 2, i + 3), KERNEL):
            if 0 <= k < len(values):
                total += w * values[k]
                weight += w
        out.append(total / weight)
    return out


def features(lines: list[tuple[str, Line]]) -> tuple[list[float], list[float]]:
    """Text-to-tag ratio of each line, and how far its smoothed ratio and the change of it lie from the origin."""
    ratios = [0.0 if x.dropped else max(0, len(t) - x.linked) / max(1, x.tags) for t, x in lines]
    level = smooth(ratios)
    ahead = [sum(level[i : i + 3]) / len(level[i : i + 3]) for i in range(len(level))]
    change = smooth([abs(a - s) for a, s in zip(ahead, level)])
    return ratios, [math.hypot(s, d) for s, d in zip(level, change)]


def regions(ratios: list[float], far: list[float]) -> list[tuple[int, int]]:
    """Runs of lines with a positive ratio of which the content cluster holds at least half, without their flat ends.

    Content lies beyond a threshold: half the mean of the lines that could be content, at most the spread of all. At an
    end of a run, three or more lines in a row that stay below a fraction of the threshold are no content.
    """
    own = [f for r, f in zip(ratios, far) if r > 0]
    if not own:
        return []
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    half = sum(own) / len(own) / 2
    threshold = min(half, spread) if spread else half
    found, start = [], None
    for i, r in enumerate([*ratios, 0.0]):
        if r > 0:
            start = i if start is None else start
        elif start is not None:
            inside = sum(r for r, f in zip(ratios[start:i], far[start:i]) if f >= threshold)
            if inside > 0 and 2 * inside >= sum(ratios[start:i]):
                found.append(_without_flat_ends(far, threshold * FLAT, start, i))
            start = None
    return found


def _without_flat_ends(far: list[float], low: float, start: int, end: int) -> tuple[int, int]:
    first = next(i for i in range(start, end) if far[i] >= low)
    last = next(i for i in range(end - 1, start - 1, -1) if far[i] >= low)
    return (first if first - start >= FLAT_LINES else start), (last + 1 if end - 1 - last >= FLAT_LINES else end)


def main_text(html: str | None) -> str:
    """Text of the content blocks of a page in page order, white space inside a block as one space."""
    parser = Lines()
    html = html or ""
    for start in range(0, len(html), PIECE):
        parser.feed(html[start : start + PIECE])
    parser.close()
    parser._break()
    lines = [(" ".join("".join(x.text).split()), x) for x in parser.lines]
    lines = [(t, x) for t, x in lines if t]
    ratios, far = features(lines)
    found = regions(ratios, far)
    if not found:
        return ""
    keep = {i for start, end in found for i in range(start, end)}
    for (_, a), (b, _) in zip(found, found[1:]):  # up to two lines between regions belong to them
        if b - a <= 2:
            keep.update(range(a, b))
    # a page that marks its article: regions end at its borders, and what lies between them belongs to it
    held = {lines[i][1].holder for i in keep} - {0}
    if held:
        ends = {h: [i for i in keep if lines[i][1].holder == h] for h in held}
        keep = {i for h, inside in ends.items() for i in range(min(inside), max(inside) + 1) if lines[i][1].holder == h}
    return " ".join(t for i, (t, x) in enumerate(lines) if i in keep and not x.dropped)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` for every row: the main text of the whole page, empty if there is none.

    Null and empty pages have the empty text. Rows are independent: null and repeated ids give a row each.
    Broken markup is read as far as the parser can; other columns are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def rows(source):
        for r in source:
            text = main_text(r["html"])
            yield r["id"], r["url"], text, len(text)

    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    out = arrow_map(slim, f"id {kind}, url string, text string, n_chars long", rows, size=200)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
