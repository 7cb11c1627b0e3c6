"""Main text of a page by the distribution of text over its lines.

Markup is stripped into lines: one per block element, white space within a block turned into one
space. Elements that never hold main text (menus, headers and footers of the page, sidebars,
notices, adverts, forms, scripts, styles, comments of readers) leave lines of weight 0 in their place,
one per block. Every other line weighs its text length less that of its links.

Elements are one more weight: on a page with text within ``article`` or ``main``, a line there weighs at
least a window's share of a dense one, and a line elsewhere a tenth of its length. Weights are summed over
sliding windows of lines: text starts where the sum surges to a share of the page's densest window and ends
where it dives below a smaller one, and every such stretch is main text. Short lines at its edges belong to
it if they lie in an element that holds its long ones, or are headings; others there (notices in a
plain ``div``) don't. Whole pages are read, nothing is cut.

Class names and ids count whole; of a hyphenated one every part must be listed or say nothing of the
content (``cookie-banner``, ``site-header``, but not ``no-sidebar`` or ``related-work``). An element that so
turns out to hold the page's only ``article`` or ``main`` and most of its text, or as a layout's part nearly
all its text, is no boilerplate after all. Pages are scanned in linear time, also broken ones: a tag with an
unclosed quote ends at the next ``>``, one without any is text.

Defined results: null or empty html gives an empty text, a null url stays null, repeated rows are
returned as often as they occur, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
OUTSIDE = frozenset(
    "nav aside footer form head script style noscript template iframe button select textarea menu svg dialog title "
    "object video audio canvas map noframes noembed xmp fieldset".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
# A start tag of these ends an open p, as HTML's parser does.
ENDS_P = BLOCKS - frozenset("caption body head html option optgroup tbody td tfoot th thead tr legend title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks that stand among paragraphs.
FLOW = HEADINGS | frozenset("p li dd dt ul ol dl blockquote pre address table tbody thead tfoot tr td th caption".split())
BOILER = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu sidebar side-bar "
    "aside footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal newsletter "
    "subscribe signup share sharing social related recommended comment comments respond reply replies disqus pagination pager "
    "widget toolbar skip".split()
)
# Parts of hyphenated names that say nothing of the content.
NEUTRAL = frozenset(
    "site page global top bottom left right main primary secondary box bar block list links link buttons button icons icon "
    "wrapper wrap container inner outer area section form posts articles stories items item slot unit text message modal".split()
)
# Names of readers' comments, and of parts of a layout that may by mistake hold the whole text.
READERS = frozenset("comment comments respond reply replies disqus".split())
LAYOUT = frozenset("aside banner header masthead sidebar side-bar skip toolbar widget form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

# Shares of the densest window at which text surges and dives, and the sum from which a window is dense.
SURGE, DIVE, ENOUGH = 0.3, 0.15, 600
# Divisor of weights outside content, and shares of a page's text that an element holds to be no boilerplate.
ELSEWHERE, MOST, NEARLY_ALL = 10, 0.5, 0.75

# Possessive, so that no piece of a page is tried twice. A quote opens a value only after "=".
_SKIP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_REST = re.compile(r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|(?<!=)[\"'])*+>")
# One attribute: its name, and its value if it has one. Matches follow each other from the tag's name on.
_ATTRIBUTE = re.compile(r"[\s/=]*+([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+")
_DIGITS = re.compile(r"&#(\d{8,})")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[\s_]+")


def boiler_name(attributes: str) -> str:
    """Listed part of a class name or id, or "hidden" or a role, by which an element is never main text; else empty."""
    seen = set()
    # White space and slashes at the end belong to no attribute.
    for name, *values in _ATTRIBUTE.findall(attributes.rstrip(" \t\n\r\f\v/=")):
        name, value = name.lower(), "".join(values).strip().lower()
        if name in seen:  # of attributes of one name the first counts
            continue
        seen.add(name)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "hidden"
        if name == "role":
            if value in ROLES:
                return "role"
        elif name in ("class", "id"):
            for word in _WORDS.split(value):
                if word in BOILER:
                    return word
                parts = word.split("-")
                listed = [x for x in parts if x in BOILER]
                if listed and all(x in BOILER or x in NEUTRAL for x in parts):
                    return listed[0]
    return ""


def is_boilerplate(attributes: str) -> bool:
    """Whether class, id or role name a part that is never main text."""
    return bool(boiler_name(attributes))


def tags(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, "/" or nothing, lower-case name and attributes of every tag; comments and the like have no name.
    Whoever reads on from another place sends it."""
    at, last_end, last_begin, quoted = 0, html.rfind(">"), html.rfind("<"), True
    while (start := html.find("<", at)) >= 0:
        found = _SKIP.match(html, start)
        if found:
            at = (yield start, found.end(), "", "", "") or found.end()
            continue
        found = _NAME.match(html, start)
        if not found:
            at = start + 1
            continue
        if start > last_end:
            # No tag ends any more: the last one begun is cut off, those before it are text.
            if start == last_begin:
                yield start, len(html), "", "", ""
                return
            at = start + 1
            continue
        end = _REST.match(html, found.end()) if quoted else None
        if end is None:
            # A quote without its end: from here on tags end at the next ">".
            quoted = False
        stop = end.end() if end else html.index(">", found.end()) + 1
        at = (yield start, stop, found[1], found[2].lower(), html[found.end() : stop - 1]) or stop


def decoded(text: str) -> str:
    """Character references decoded; numbers of any length, those beyond Unicode as U+FFFD."""
    return unescape(_DIGITS.sub(lambda m: "&#" + (m[1].lstrip("0") or "0")[:8], text))


class Line(NamedTuple):
    """A block of a page; a part that is never main text gives lines without text."""

    text: str
    weight: int  # length of text outside links
    inside: bool  # whether within content
    group: tuple[int, str]  # element around the block and kind of block
    heading: bool


GAP = Line("", 0, False, (-1, ""), False)


@dataclass
class Listed:
    """An element listed as boilerplate: its place and name, and the text outside links and the elements of
    content before it, then within it."""

    place: int
    word: str
    held: int
    contents: int

    def too_much(self, whole: int, bare: bool) -> bool:
        """Whether it holds the content of a page bare of it otherwise, or as part of a layout nearly all text."""
        if self.word in READERS or self.word in ("hidden", "role"):
            return False
        if bare and self.contents and self.held > MOST * whole:
            return True
        return self.word in LAYOUT and self.held >= ENOUGH and self.held > NEARLY_ALL * whole


def lines_of(html: str) -> list[Line]:
    """Blocks of a page in order."""
    lines, kept = _scan(html, frozenset())
    return _scan(html, kept)[0] if kept else lines


def _scan(html: str, kept: frozenset[int]) -> tuple[list[Line], frozenset[int]]:
    """Blocks of a page, taking the elements opened at the places ``kept`` for text, and the places of
    elements listed as boilerplate that hold too much of the page to be that."""
    out: list[Line] = []
    text: list[str] = []
    linked, anchors, opened = 0, 0, 0
    # Open elements: name, whether it or one around it is boilerplate, whether within content, and of the
    # innermost block its number, its name and the number of the block around it; the place in the stack of the
    # innermost block, and of listed elements their own.
    stack: list[tuple[str, bool, bool, int, str, int, int, Listed | None]] = []
    count: Counter[str] = Counter()
    listed: list[Listed] = []
    plain = contents = 0  # text outside links so far, and elements of content
    boiler, content = False, False
    # Blocks of the present run of boilerplate that have no line yet.
    skipped, marked = False, False
    at = 0

    def close_block():
        nonlocal linked, skipped, marked
        if skipped:
            if not marked:
                out.append(GAP)
            skipped = marked = False
        if text:
            line = _SPACE.sub(" ", decoded("".join(text))).strip()
            if line:
                block, around = (stack[-1][4], stack[-1][5]) if stack else ("", -1)
                kind = "text" if block in FLOW else block
                out.append(Line(line, max(0, len(line) - linked), content, (around, kind), block in HEADINGS))
            text.clear()
        linked = 0

    def mark():
        """A line of no weight for a boilerplate element, which stands for its first block too."""
        nonlocal marked
        out.append(GAP)
        marked = True

    def close_from(place: int):
        nonlocal boiler, content
        for name, *_, own in stack[place:]:
            count[name] -= 1
            if own:
                own.held, own.contents = plain - own.held, contents - own.contents
        del stack[place:]
        boiler, content = (stack[-1][1], stack[-1][2]) if stack else (False, False)

    size = len(html)
    source = tags(html)
    step = next(source, None)
    while True:
        end = step[0] if step else size
        if end > at:
            piece = html[at:end]
            if not anchors:
                plain += len(piece.strip())
            if boiler:
                skipped = skipped or not piece.isspace()
            else:
                text.append(piece)
                if anchors:
                    linked += len(piece)
        if not step:
            break
        begun, at, closing, name, attributes = step
        step = None
        if name in RAW and not closing:
            close_block()
            stop = re.compile(rf"</{re.escape(name)}\s*+>", re.I).search(html, at)
            at = stop.end() if stop else size
            step = _sent(source, at)
            continue
        step = next(source, None)
        if not name:
            continue
        if closing:
            if not count[name]:
                if name in BLOCKS:
                    close_block()
                continue
            place = len(stack) - 1
            while stack[place][0] != name:
                place -= 1
            if name in BLOCKS or stack[place][1] != boiler:
                close_block()
            if name != "p" and any(x[0] == "a" for x in stack[place:]) or name == "a":
                anchors = 0
            close_from(place)
            continue
        if name in VOID or attributes.endswith("/") and name in ("svg", "path", "use"):
            if name == "hr":
                close_block()
            elif name == "br":
                text.append(" ")
            continue
        if name in BLOCKS:
            close_block()
            if name in ENDS_P and stack and stack[-1][6] >= 0 and stack[stack[-1][6]][0] == "p":
                close_from(stack[-1][6])
                anchors = count["a"]
        word = name if name in OUTSIDE or name == "header" and not content else boiler_name(attributes) if attributes else ""
        outside = word and begun not in kept
        own = None
        if outside and name not in CONTENT and (name not in OUTSIDE or name in LAYOUT):
            own = Listed(begun, word, plain, contents)
            listed.append(own)
        if outside and not boiler:
            close_block()
            mark()
        boiler = boiler or bool(outside) and name not in ("html", "body")
        if name in CONTENT:
            content = True
            contents += 1
        if name == "a":
            anchors += 1
        opened += 1
        number, block, around = stack[-1][3:6] if stack else (-1, "", -1)
        if name in BLOCKS:
            # Lists, quotes and tables are of the element around them.
            number, block, around = number if name in FLOW else opened, name, number
        near = len(stack) if name in BLOCKS else stack[-1][6] if stack else -1
        count[name] += 1
        stack.append((name, boiler, content, number, block, around, near, own))
    close_block()
    close_from(0)
    bare = not any(x.inside for x in out)
    return out, frozenset(x.place for x in listed if x.too_much(plain, bare))


def _sent(source: Iterator, at: int):
    """The next tag from ``at`` on."""
    try:
        return source.send(at)
    except StopIteration:
        return None


def weights_of(lines: list[Line], window: int, enough: int) -> list[int]:
    """Weights of lines by their text and by the elements around them."""
    if not any(x.inside for x in lines):
        return [x.weight for x in lines]
    return [max(x.weight, -(-enough // window)) if x.inside else x.weight // ELSEWHERE for x in lines]


def main_text(html: str | None, window: int = 3, surge: float = SURGE, dive: float = DIVE, enough: int = ENOUGH) -> str:
    """Text between surges and dives of the lines' weights, blocks joined by a newline."""
    lines = lines_of(html or "")
    framed = any(x.inside for x in lines)
    weights = weights_of(lines, window, enough)
    sums = [sum(weights[i : i + window]) for i in range(len(lines))]
    peak = min(max(sums, default=0), enough)
    high, low = max(1, surge * peak), max(1, dive * peak)
    out: list[str] = []
    i = done = 0
    while i < len(lines):
        # Surge: the window that begins here holds text enough, beginning with its first line.
        if not weights[i] or sums[i] < high:
            i += 1
            continue
        end = next((j for j in range(i, len(lines)) if sums[j] < low), len(lines))
        strong = {x.group for x, w in zip(lines[i:end], weights[i:end]) if w >= high}

        def weak(j: int) -> bool:
            return weights[j] < high and lines[j].group not in strong

        # Short lines at the edges belong to a stretch if they are blocks among its long ones, or head them.
        while strong and (framed or not lines[i].heading) and weak(i):
            i += 1
        while strong and weak(end - 1):
            end -= 1
        first, last = i, end
        while first > done and lines[first - 1].text and lines[first - 1].group in strong:
            first -= 1
        while last < len(lines) and lines[last].text and lines[last].group in strong:
            last += 1
        # Links alone are text only between the lines of a stretch, and lines outside content only if dense.
        for j in range(first, last):
            if lines[j].text and (weights[j] or i <= j < end) and (not framed or lines[j].inside or weights[j] >= high):
                out.append(lines[j].text)
        i = done = last
    return "\n".join(out)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": [main_text(h) for h in batch["html"]]})


def extract(pages: DataFrame) -> DataFrame:
    """Page id, url, main text and its length in code points, one row per row of ``pages``."""
    rows = pages.select(
        F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    found = rows.mapInPandas(_extract, "page_id string, url string, text string")
    return found.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
