"""Main text of web pages by line-block distribution.

Markup is stripped into raw lines: the start or end of a block ends a line, that of a
container (``div``, ``section``, ``table`` ...) two, so that nested markup leaves empty
lines. The length of a line is that of its text; lines of links count as nothing, as do
lines that an element hints are no text. Lengths are summed over a sliding window: where
the sum rises from nothing a text surges, where it falls to nothing it dives, and what
lies between is a candidate.

What a candidate must hold follows from the page's own lengths: half of its characters
stand in lines of at least some length, and a candidate with a window of half of that is
text. What lies between such candidates is text too if it is mostly unlinked, as is what
stands beside them in their container, and a heading before them. Other short stretches
(menus, legal lines, side columns) are left out, whatever they are called. Elements are
hints: those that never hold main text leave a gap, candidates inside an article win over
others unless they have less text, and a container called a notice, a share bar or the
like is left out only if its lines are short by the same measure. Reader comments can be
as long as the text, so those are told by name alone.

Defined results: null or empty pages, and pages without text, give an empty text. Page
fragments, unclosed elements and unclosed comments are read to their end. Pages are
never cut, and are read once, whatever is unclosed in them. Rows are independent; the
text is a column expression, so extra columns and repeated rows need no care. An empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Lines in the sliding window, and in a gap.
WINDOW = 3

#: What a candidate's best window must hold, as a part of the length in lines of which or longer half of a page's characters stand.
ENOUGH = 0.5

#: Links in a row, in one line or in several, that make a list of links.
LINKS = 3

#: Characters that may be read again for quoted values that are never closed, as a multiple of the page.
REREAD = 8

_START = re.compile(r"(?i)<(?:(!--)|([!?])|(/?)([a-z][a-z0-9:-]*))")
_ATTRIBUTES = re.compile(r"""((?:"[^"]*"|'[^']*'|[^'">]++)*+)>""")
_MARKS = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")

#: Elements whose content is no markup and never text.
RAW = frozenset("script style noscript template svg iframe textarea select title".split())
#: Elements that are part of a line; all others end it.
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_TEXT = frozenset("nav footer aside form button dialog head menu".split())
ARTICLE = frozenset("article main".split())
ROOTS = frozenset("html body".split())
HEADINGS = frozenset("h1 h2 h3".split())

#: Elements that hold others; only these can be left out by their name.
CONTAINERS = frozenset("div section table ul ol dl header details figure center fieldset tbody object span".split())

#: Words in class, id or role of what is never main text.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr popup modal overlay nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget footer comment comments commentlist respond disqus newsletter login pagination pager contentinfo complementary".split()
)
#: These mark a container whose lines are short, or one outside articles.
HINTS = frozenset("notice notices notification alert banner promo promotion share sharing social related recommended subscribe subscription signup search".split())
HINTS_OUTSIDE = frozenset("header masthead topbar".split())

NOTHING, HINTED, NEVER = 0, 1, 2


def _hint(name: str, attributes: str, in_article: bool) -> int:
    """Whether an element holds no main text by its name, or only a hint says so."""
    if name in NEVER_TEXT or (name == "header" and not in_article):
        return NEVER
    if name not in CONTAINERS or "=" not in attributes:
        return NOTHING
    found = NOTHING
    for mark in _MARKS.findall(attributes):
        words = set(re.split(r"[\s_-]+", "".join(mark).lower()))
        if words & MARKED:
            return NEVER
        if words & HINTS or (not in_article and words & HINTS_OUTSIDE):
            found = HINTED
    return found


def tags_of(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, name, whether it closes, and attributes of each tag, in one pass; comments and raw elements have no name.

    A tag ends at the first ``>`` outside quoted values, or at the first at all if a value is never closed. Looking
    for such ends may go over a page ``REREAD`` times in all; then the first ``>`` ends a tag.
    """
    last, budget, at = page.rfind(">"), REREAD * len(page), 0
    while (found := _START.search(page, at)) is not None:
        start, end = found.span()
        if found[1]:
            close = page.find("-->", end)
            at = len(page) if close < 0 else close + 3
            yield start, at, "", False, ""
            continue
        if end > last:
            return
        if found[2]:
            at = page.index(">", end) + 1
            yield start, at, "", False, ""
            continue
        name = found[4].lower()
        quoted = _ATTRIBUTES.match(page, end) if budget > 0 else None
        if quoted is None:
            budget -= len(page) - end
            at = page.index(">", end) + 1
            attributes = page[end : at - 1]
        else:
            at, attributes = quoted.end(), quoted[1]
        if name in RAW and not found[3]:
            close = re.compile(rf"(?i)</{name}\s*>").search(page, at)
            at = len(page) if close is None else close.end()
            yield start, at, "", False, name
        else:
            yield start, at, name, found[3] == "/", attributes


class Line(NamedTuple):
    """A line of text and where it stands; ``low`` is the lowest level of containers since the line before, ``hinted`` the number of the container that a hint speaks against."""

    text: str
    linked: int = 0
    links: int = 0
    article: bool = False
    hinted: int = 0
    level: int = 0
    low: int = 0
    heading: bool = False


GAP = Line("")


def lines_of(page: str) -> list[Line]:
    """The raw lines of a page; between two texts stand as many empty ones as the markup between them says."""
    lines: list[Line] = []
    parts: list[str] = []
    linked = links = link = article = level = low = breaks = 0
    heading = paragraph = False
    hinted: list[tuple[int, int]] = []  # Levels and numbers of open containers that a hint speaks against.
    number = 0

    def end_line(weight: int = 1) -> None:
        nonlocal linked, links, low, breaks
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            # Lines that follow each other at once have no empty line between them.
            lines.extend([GAP] * min(WINDOW, breaks - 1))
            at = level + paragraph
            lines.append(Line(text, linked, links, article > 0, hinted[-1][1] if hinted else 0, at, min(low, at), heading))
            low, breaks = at, 0
        breaks += weight
        parts.clear()
        linked = links = 0

    def gap() -> None:
        end_line(WINDOW + 1)

    skipped, depth, at = "", 0, 0
    for start, end, name, closing, attributes in [*tags_of(page), (len(page), len(page), "", False, "")]:
        if not skipped and start > at:
            parts.append(page[at:start])
            if link:
                linked += start - at
        at = end
        if not name:
            if attributes and not skipped:
                end_line()
            continue
        if skipped:
            if name == skipped and name not in VOID:
                depth += -1 if closing else 1
            # An element that was never closed ends where an article begins.
            if depth == 0 or (name in ARTICLE and not closing):
                skipped = ""
                if name not in ARTICLE:
                    continue
            else:
                continue
        opens = not closing and name not in VOID and not attributes.endswith("/")
        hint = _hint(name, attributes, article > 0) if opens else NOTHING
        if hint == NEVER:
            gap()
            skipped, depth = name, 1
        elif name in ARTICLE:
            gap()
            article = max(0, article + (-1 if closing else 1))
        elif name == "a":
            link = 0 if closing else 1
            links += link
        elif name == "br" or name == "wbr":
            parts.append(" " if name == "br" else "")
        elif name in CONTAINERS and name != "span":
            gap() if hint == HINTED else end_line(2)
            paragraph = False
            level = level + 1 if opens else max(0, level - 1) if closing else level
            low = min(low, level)
            if hint == HINTED:
                number += 1
                hinted.append((level, number))
            elif hinted and level < hinted[-1][0]:
                hinted.pop()
                gap()
        elif name not in INLINE:
            end_line()
            if name not in ROOTS:
                paragraph = opens
                heading = opens and name in HEADINGS
            low = min(low, level)
    gap()
    return lines


def surges(lengths: list[int]) -> list[tuple[int, int]]:
    """The stretches between a surge and a dive: the window sum rises from 0 at the first and is 0 again after the last line."""
    padded = [0] * WINDOW + lengths + [0] * WINDOW
    sums = [sum(padded[i : i + WINDOW]) for i in range(len(padded) - WINDOW + 1)]
    out, start = [], None
    for i, (before, now) in enumerate(pairwise(sums)):
        if before == 0 and now > 0:
            start = i
        if before > 0 and now == 0 and start is not None:
            out.append((start, i + 1 - WINDOW))
            start = None
    return out


def _lengths(lines: list[Line], least: float) -> list[int]:
    """The length of each line. Lists of links outside articles count as nothing, as do containers hinted at unless a window of theirs holds ``least``."""
    hinted: dict[int, list[Line]] = {}
    for line in lines:
        if line.hinted:
            hinted.setdefault(line.hinted, []).append(line)
    text = {0} | {number for number, block in hinted.items() if _best_window(block) >= least}
    out = [len(line.text) if line.hinted in text else 0 for line in lines]
    start = 0
    for i in range(len(lines) + 1):
        # Empty lines between linked ones don't end their list.
        if i == len(lines) or lines[i].article or (lines[i].text and 2 * lines[i].linked <= len(lines[i].text)):
            if sum(max(1, line.links) for line in lines[start:i] if line.text) >= LINKS:
                out[start:i] = [0] * (i - start)
            start = i + 1
    return out


def _plain(block: list[Line]) -> int:
    """Characters of unlinked text."""
    return sum(len(line.text) - line.linked for line in block)


def typical(lines: list[Line]) -> int:
    """Half of a page's unlinked characters stand in lines of at least this length."""
    lengths = sorted((len(line.text) - line.linked for line in lines), reverse=True)
    half = sum(lengths) / 2
    for length in lengths:
        half -= length
        if half <= 0:
            return length
    return 0


def _best_window(block: list[Line]) -> int:
    lengths = [len(line.text) - line.linked for line in block]
    return max(sum(lengths[i : i + WINDOW]) for i in range(len(lengths)))


def _texts(found: list[list[Line]], least: float) -> list[list[Line]]:
    """Candidates whose best window holds ``least``, mostly unlinked ones between these, and beside these in their container or as a heading."""
    mostly = [2 * _plain(block) > sum(len(line.text) for line in block) for block in found]
    sure = [i for i, block in enumerate(found) if _best_window(block) >= least > 0]
    if not sure:
        return []
    keep = set(sure) | {i for i in range(sure[0], sure[-1]) if mostly[i]}
    inside = min(line.level for i in sure for line in found[i] if line.text) - 1
    first, last = sure[0] - 1, sure[-1] + 1
    # The lowest level between two candidates tells whether a container ended.
    while first >= 0 and mostly[first] and (found[first + 1][0].low >= inside or any(line.heading for line in found[first])):
        keep.add(first)
        first -= 1
    while last < len(found) and mostly[last] and found[last][0].low >= inside:
        keep.add(last)
        last += 1
    return [found[i] for i in sorted(keep)]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = lines_of(page)
    least = ENOUGH * typical(lines)
    found = [lines[a:b] for a, b in surges(_lengths(lines, least))]
    inside = [any(line.article for line in block) for block in found]
    chosen = [block for block, within in zip(found, inside, strict=True) if within]
    outside = [block for block, within in zip(found, inside, strict=True) if not within]
    # Articles with less text than one stretch beside them are teasers if they have links.
    if outside and sum(map(_plain, chosen)) < max(map(_plain, outside)):
        chosen = _texts([block for block, within in zip(found, inside, strict=True) if not (within and any(line.linked for line in block))], least)
    return " ".join(line.text for block in chosen for line in block if line.text)


def extract(page: Column) -> Column:
    """The main text of a page."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p.as_py()) for p in batch], pa.string())

    return extracted(page)
