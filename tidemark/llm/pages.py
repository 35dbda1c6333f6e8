"""Main text of HTML pages from flat text blocks and a decision tree.

A page is cut into blocks at the tags that start a new line; script, style and other unseen
content is left out, and character references are decoded. Each block is described by its
number of words and its link density, those of the blocks before and after it, and the boxes it
stands in: how plainly one is marked as page furniture (2 by tag, role or a class or id of its own, 1 by a form
or a word within a longer name, as in "with-sidebar"), one that is marked as the main part, and whether
it stands outside the main part of a page that has one. A main part inside a box of 1 is free of
that mark; one inside a box of 2 is none. A decision tree, grown on a small labelled table, then keeps or
drops each block: marks are columns among others, and where a page marks no main part, words
and neighbours decide. One map over the pages; a page's work grows with its length only, and
open boxes are kept as counts, so deep nesting costs nothing.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_map

HIDDEN = frozenset("script style noscript template head svg math iframe object canvas audio video select textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt rtc ruby s samp small span "
    "strike strong sub sup time tt u var wbr img picture source label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog button fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
# Words of class, id and role values that mark a box.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer menu nav navbar navigation newsletter notice popup promo promoted related replies "
    "search share sharing sidebar social sponsor sponsored subscribe toolbar widget contentinfo complementary respond "
    "alert disclaimer signup login masthead header modal overlay reactions".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*?)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|aria-label|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
MAIN, HIDE = 3, 4


def _box(tag: str, attributes: str) -> int:
    """1 or 2 for furniture (perhaps, plainly), ``MAIN``, ``HIDE`` for hidden content, 0 else."""
    if tag in HIDDEN:
        return HIDE
    if tag in FURNITURE_TAGS or tag == "header":
        return 1 if tag == "form" else 2
    mark = 0
    if attributes:
        for name, value in _NAMES.findall(attributes):
            name, value = name.lower(), value.strip("\"' ").lower()
            if name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
                return HIDE
            if name == "aria-hidden" and value == "true":
                return HIDE
            if name == "role" and value == "main":
                return MAIN
            if name in ("class", "id", "role"):
                if not FURNITURE_WORDS.isdisjoint(value.split()):
                    mark = 2
                elif not mark and not FURNITURE_WORDS.isdisjoint(_SPLIT.split(value)):
                    mark = 1
    if tag in MAIN_TAGS:
        return MAIN
    return 0 if tag in ("body", "html") else mark


def blocks(page: str) -> list[tuple[str, int, int, int, bool]]:
    """(text, words, words in links, furniture mark, in the main part) of each block in page order."""
    out = []
    parts: list[str] = []
    links: list[str] = []
    counts = [0, 0, 0, 0, 0]
    around = 0  # boxes of 1 that hold the outermost main part
    opened: list[tuple[str, int]] = []
    depth: dict[str, int] = {}
    anchor = 0
    at, size = 0, len(page)

    def close() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                linked = len(entities.unescape(" ".join(links)).split())
                mark = 2 if counts[2] else int(counts[1] > (around if counts[MAIN] else 0))
                out.append((text, len(text.split()), linked, mark, counts[MAIN] > 0))
            parts.clear()
            links.clear()

    while at < size:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and not counts[HIDE]:
            parts.append(text)
            if anchor:
                links.append(text)
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            close()
        if tag == "a":
            anchor = 0 if found[1] else 1
        if found[1]:
            if depth.get(tag):
                while opened:
                    name, box = opened.pop()
                    depth[name] -= 1
                    counts[box] -= 1
                    if name == tag:
                        break
            continue
        if tag in ("script", "style", "textarea", "title", "noscript", "iframe", "template"):
            end = page.lower().find(f"</{tag}", at) if size < 4096 else _end(page, tag, at)
            at = size if end < 0 else end
        if tag in VOID or tag in INLINE and not found[3]:
            continue
        if tag == "p" and depth.get("p") and opened[-1][0] == "p" or tag == "li" and opened and opened[-1][0] == "li":
            name, box = opened.pop()
            depth[name] -= 1
            counts[box] -= 1
        box = _box(tag, found[3].rstrip("/"))
        if box == MAIN and not counts[MAIN]:
            if counts[2]:
                box = 0
            else:
                around = counts[1]
        opened.append((tag, box))
        depth[tag] = depth.get(tag, 0) + 1
        counts[box] += 1
    close()
    return out


def _end(page: str, tag: str, at: int) -> int:
    found = re.compile(f"</{tag}", re.I).search(page, at)
    return found.start() if found else -1


# The labelled table, one block a row: words, link density, those of the block before and of
# the block after, furniture mark, in the main part, outside the main part of a page that has
# one; 1 = main text.
TABLE = [
    (1, 1.0, 0, 0.0, 1, 1.0, 2, 0, 1, 0), (1, 1.0, 1, 1.0, 8, 0.0, 2, 0, 1, 0), (8, 0.0, 1, 1.0, 9, 0.0, 2, 0, 1, 0),
    (30, 0.0, 6, 0.5, 12, 0.0, 2, 0, 1, 0), (12, 0.0, 40, 0.0, 0, 0.0, 2, 0, 1, 0), (25, 0.1, 80, 0.0, 30, 0.1, 2, 1, 0, 0),
    (60, 0.0, 90, 0.0, 40, 0.0, 2, 1, 0, 0), (3, 0.6, 50, 0.0, 80, 0.0, 2, 1, 0, 0), (1, 0.0, 30, 0.0, 60, 0.0, 2, 1, 0, 0),
    (5, 0.0, 9, 0.0, 2, 0.0, 2, 1, 0, 0), (40, 0.0, 0, 0.0, 0, 0.0, 2, 1, 0, 0), (18, 0.0, 3, 0.0, 0, 0.0, 2, 1, 0, 0),
    (9, 0.0, 9, 0.0, 60, 0.0, 0, 1, 0, 1), (60, 0.0, 9, 0.0, 90, 0.0, 0, 1, 0, 1), (1, 0.0, 60, 0.0, 40, 0.0, 0, 1, 0, 1),
    (40, 0.05, 1, 0.0, 5, 0.0, 0, 1, 0, 1), (5, 0.0, 40, 0.0, 12, 0.1, 0, 1, 0, 1), (2, 1.0, 40, 0.0, 30, 0.0, 0, 1, 0, 1),
    (6, 0.9, 80, 0.0, 70, 0.1, 0, 1, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (2, 0.0, 1, 1.0, 1, 0.0, 0, 1, 0, 1),
    (3, 0.3, 2, 1.0, 2, 1.0, 0, 1, 0, 1), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1), (4, 1.0, 0, 0.0, 3, 1.0, 0, 1, 0, 1),
    (1, 0.0, 2, 0.0, 1, 0.0, 0, 1, 0, 1), (3, 0.0, 8, 1.0, 0, 0.0, 0, 1, 0, 1), (12, 0.8, 15, 0.9, 9, 0.7, 0, 1, 0, 1),
    (15, 0.0, 1, 1.0, 1, 1.0, 0, 0, 1, 0), (40, 0.0, 8, 1.0, 9, 0.0, 0, 0, 1, 0), (3, 1.0, 2, 1.0, 3, 1.0, 0, 0, 1, 0),
    (8, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1, 0), (90, 0.0, 70, 0.0, 80, 0.0, 0, 0, 1, 0), (25, 0.0, 50, 0.0, 30, 0.0, 0, 0, 1, 0),
    (60, 0.1, 3, 0.0, 2, 0.0, 0, 0, 1, 0), (1, 0.0, 40, 0.0, 9, 0.0, 0, 0, 1, 0), (12, 0.0, 0, 0.0, 70, 0.0, 0, 0, 1, 0),
    (70, 0.0, 3, 0.0, 60, 0.0, 0, 0, 0, 1), (45, 0.1, 70, 0.0, 30, 0.0, 0, 0, 0, 1), (6, 0.0, 2, 1.0, 70, 0.0, 0, 0, 0, 1),
    (12, 0.0, 50, 0.0, 40, 0.0, 0, 0, 0, 1), (20, 0.2, 30, 0.0, 4, 1.0, 0, 0, 0, 1), (25, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (9, 0.0, 0, 0.0, 30, 0.0, 0, 0, 0, 1), (3, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 1), (2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.9, 2, 1.0, 40, 0.0, 0, 0, 0, 0), (14, 0.8, 30, 0.9, 20, 0.7, 0, 0, 0, 0), (3, 1.0, 50, 0.0, 2, 1.0, 0, 0, 0, 0),
    (1, 1.0, 0, 0.0, 60, 0.0, 0, 0, 0, 0), (9, 1.0, 16, 0.0, 0, 0.0, 0, 0, 0, 0), (16, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 1),
    (2, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (30, 0.7, 4, 1.0, 3, 1.0, 0, 0, 0, 0),
    (9, 0.0, 6, 1.0, 4, 0.0, 0, 0, 0, 0), (12, 0.0, 4, 1.0, 7, 0.0, 0, 0, 0, 0), (6, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0),
    (8, 0.0, 12, 1.0, 0, 0.0, 0, 0, 0, 0), (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (22, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (14, 0.1, 8, 0.9, 3, 0.0, 0, 0, 0, 0), (30, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (5, 0.0, 3, 0.0, 2, 0.0, 0, 0, 0, 0),
    (9, 0.0, 2, 0.0, 3, 0.0, 0, 0, 0, 0), (2, 0.0, 1, 0.0, 8, 0.0, 0, 0, 0, 0), (10, 0.0, 2, 0.0, 1, 1.0, 0, 0, 0, 0),
    (6, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0), (7, 0.0, 3, 0.0, 5, 0.0, 0, 0, 0, 0), (13, 0.0, 3, 0.0, 2, 0.0, 0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 0), (10, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (8, 0.0, 0, 0.0, 6, 0.0, 0, 0, 0, 0),
    (2, 0.0, 9, 0.0, 3, 0.0, 0, 0, 0, 0), (6, 0.0, 8, 0.0, 2, 0.0, 0, 0, 0, 0), (90, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 1),
    (60, 0.05, 1, 1.0, 1, 1.0, 0, 0, 0, 1), (48, 0.0, 6, 1.0, 3, 1.0, 0, 0, 0, 1), (7, 0.0, 2, 1.0, 45, 0.0, 0, 0, 0, 1),
    (5, 0.0, 6, 1.0, 25, 0.0, 0, 0, 0, 1), (30, 0.0, 5, 0.0, 35, 0.0, 0, 0, 0, 1), (22, 0.0, 30, 0.0, 2, 1.0, 0, 0, 0, 1),
    (18, 0.0, 25, 0.0, 20, 0.0, 0, 0, 0, 1), (40, 0.1, 20, 0.0, 3, 0.0, 0, 0, 0, 1), (8, 0.0, 30, 0.0, 6, 0.0, 0, 0, 0, 1),
    (14, 0.0, 1, 1.0, 30, 0.0, 0, 0, 0, 1), (20, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 1), (35, 0.1, 2, 0.0, 0, 0.0, 0, 0, 0, 1),
    (10, 0.0, 16, 0.0, 12, 0.0, 0, 0, 0, 1), (4, 0.0, 0, 0.0, 40, 0.0, 0, 0, 0, 1), (12, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (60, 0.0, 50, 0.0, 70, 0.0, 1, 0, 0, 1), (45, 0.0, 6, 0.0, 50, 0.0, 1, 0, 0, 1),
    (35, 0.05, 40, 0.0, 30, 0.0, 1, 0, 0, 1), (30, 0.0, 40, 0.0, 1, 1.0, 1, 0, 0, 1),
    (8, 0.0, 45, 0.0, 50, 0.0, 1, 0, 0, 1), (5, 0.0, 2, 1.0, 60, 0.0, 1, 0, 0, 1), (4, 0.0, 1, 1.0, 2, 1.0, 1, 0, 0, 0),
    (10, 0.0, 3, 1.0, 4, 0.0, 1, 0, 0, 0), (2, 0.0, 5, 0.0, 3, 0.0, 1, 0, 0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 1, 0, 0, 0),
    (12, 0.0, 2, 0.0, 3, 0.0, 1, 0, 0, 0), (8, 0.0, 4, 1.0, 0, 0.0, 1, 0, 0, 0), (20, 0.0, 1, 1.0, 2, 1.0, 1, 0, 0, 0),
    (70, 0.0, 60, 0.0, 80, 0.0, 2, 0, 0, 1), (55, 0.0, 45, 0.0, 50, 0.0, 2, 0, 0, 1),
    (50, 0.05, 60, 0.0, 42, 0.0, 2, 0, 0, 1), (90, 0.0, 6, 0.0, 80, 0.0, 2, 0, 0, 1),
    (60, 0.0, 70, 0.0, 2, 1.0, 2, 0, 0, 1), (4, 0.0, 1, 1.0, 2, 1.0, 2, 0, 0, 0), (12, 0.0, 3, 0.0, 2, 0.0, 2, 0, 0, 0),
    (25, 0.0, 2, 0.0, 3, 0.0, 2, 0, 0, 0), (9, 0.0, 0, 0.0, 5, 0.0, 2, 0, 0, 0), (30, 0.0, 4, 1.0, 2, 0.0, 2, 0, 0, 0),
    (2, 1.0, 1, 1.0, 3, 1.0, 2, 0, 0, 0), (8, 0.0, 2, 1.0, 60, 0.0, 2, 0, 0, 0), (20, 0.0, 60, 0.0, 0, 0.0, 2, 0, 0, 0),
    (15, 0.0, 12, 0.0, 18, 0.0, 2, 0, 0, 0), (6, 0.0, 50, 0.0, 50, 0.0, 2, 0, 0, 0),
    (60, 0.0, 50, 0.0, 70, 0.0, 1, 1, 0, 1), (45, 0.0, 6, 0.0, 50, 0.0, 1, 1, 0, 1), (40, 0.0, 40, 0.0, 2, 1.0, 1, 1, 0, 1),
    (7, 0.0, 3, 0.0, 50, 0.0, 1, 1, 0, 1), (30, 0.0, 45, 0.0, 30, 0.0, 1, 1, 0, 1), (5, 0.0, 2, 1.0, 3, 0.0, 1, 1, 0, 0),
    (12, 0.0, 2, 0.0, 3, 0.0, 1, 1, 0, 0), (2, 0.0, 12, 0.0, 9, 0.0, 1, 1, 0, 0), (3, 1.0, 40, 0.0, 2, 1.0, 1, 1, 0, 0),
    (20, 0.0, 2, 0.0, 2, 0.0, 1, 1, 0, 0), (9, 0.0, 3, 1.0, 0, 0.0, 1, 1, 0, 0), (60, 0.9, 5, 0.0, 50, 0.0, 0, 0, 0, 0),
    (40, 0.7, 30, 0.0, 60, 0.0, 0, 0, 0, 0), (90, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (45, 0.8, 0, 0.0, 0, 0.0, 0, 0, 0, 0),
    (50, 0.9, 60, 0.0, 70, 0.0, 1, 0, 0, 0), (60, 0.9, 60, 0.0, 70, 0.0, 2, 0, 0, 0),
    (60, 0.0, 0, 0.0, 50, 0.0, 0, 0, 0, 1), (50, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (80, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1),
    (40, 0.0, 0, 0.0, 3, 0.0, 0, 0, 0, 1), (90, 0.0, 120, 0.0, 100, 0.0, 0, 0, 0, 1),
    (33, 0.0, 90, 0.0, 6, 0.0, 0, 0, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (90, 0.0, 0, 0.0, 80, 0.0, 0, 1, 0, 1),
    (120, 0.1, 90, 0.0, 100, 0.0, 0, 1, 0, 1), (50, 0.9, 2, 1.0, 3, 0.0, 0, 1, 0, 1),
    (90, 0.0, 120, 0.0, 100, 0.0, 2, 1, 0, 0), (50, 0.0, 40, 0.0, 45, 0.0, 2, 1, 0, 0),
    (60, 0.0, 0, 0.0, 70, 0.0, 2, 1, 0, 0), (45, 0.9, 40, 0.0, 3, 0.0, 2, 1, 0, 0), (60, 0.0, 0, 0.0, 0, 0.0, 1, 1, 0, 1),
    (60, 0.0, 0, 0.0, 50, 0.0, 1, 0, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    (100, 0.0, 120, 0.0, 100, 0.0, 1, 1, 0, 1), (60, 0.0, 50, 0.0, 70, 0.0, 0, 0, 1, 0),
    (100, 0.0, 120, 0.0, 100, 0.0, 0, 0, 1, 0), (60, 0.0, 0, 0.0, 50, 0.0, 0, 0, 1, 0),
    (45, 0.0, 3, 1.0, 3, 0.0, 0, 0, 1, 0), (60, 0.0, 0, 0.0, 0, 0.0, 2, 0, 1, 0), (80, 0.0, 90, 0.0, 70, 0.0, 2, 0, 1, 0),
    (16, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0), (11, 0.0, 4, 1.0, 3, 1.0, 0, 0, 0, 0), (20, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 1),
    (22, 0.0, 0, 0.0, 20, 0.0, 0, 0, 0, 1), (60, 0.0, 50, 0.0, 70, 0.0, 1, 0, 1, 0), (8, 0.0, 1, 1.0, 40, 0.0, 1, 0, 1, 0),
    (3, 1.0, 2, 1.0, 2, 1.0, 1, 0, 1, 0),
    # Short articles: a main part of one, two or three short blocks, and its short title.
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (4, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (7, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (8, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (9, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (10, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 0, 0.0, 6, 0.0, 0, 1, 0, 1), (6, 0.0, 3, 0.0, 0, 0.0, 0, 1, 0, 1),
    (4, 0.0, 0, 0.0, 9, 0.0, 0, 1, 0, 1), (9, 0.0, 4, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 4, 0.0, 5, 0.0, 0, 1, 0, 1),
    (2, 0.0, 0, 0.0, 3, 0.0, 0, 1, 0, 1), (8, 0.0, 6, 0.0, 7, 0.0, 0, 1, 0, 1), (7, 0.0, 2, 1.0, 2, 0.0, 0, 1, 0, 1),
    (3, 0.0, 2, 1.0, 4, 0.0, 0, 1, 0, 1), (9, 0.0, 3, 1.0, 6, 0.0, 0, 1, 0, 1), (10, 0.0, 8, 0.0, 3, 1.0, 0, 1, 0, 1),
    (6, 0.0, 9, 0.0, 2, 1.0, 0, 1, 0, 1), (4, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1), (8, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1),
]


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 12):
    """A tree of (column, border, left, right) that lowers Gini impurity most; leaves are 0 or 1."""
    share = labels.mean() if len(labels) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = (share * (1 - share) - 1e-9, None)
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for border in (values[1:] + values[:-1]) / 2:
            left = rows[:, column] < border
            gini = sum(m.mean() * (p := labels[m].mean()) * (1 - p) for m in (left, ~left))
            if gini < best[0]:
                best = (gini, (column, float(border), left))
    if best[1] is None:
        return int(share >= 0.5)
    column, border, left = best[1]
    return column, border, grow(rows[left], labels[left], depth - 1), grow(rows[~left], labels[~left], depth - 1)


def train(table=TABLE):
    data = np.array(table, "float64")
    return grow(data[:, :-1], data[:, -1])


def decide(tree, row) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


def main_text(page: str | None, tree) -> str:
    """The kept blocks, joined by a space. NULL or empty pages give ''."""
    found = blocks(page or "")
    has_main = any(b[4] for b in found)
    shape = [(0, 0.0), *((b[1], min(1.0, b[2] / b[1])) for b in found), (0, 0.0)]
    return " ".join(
        b[0]
        for i, b in enumerate(found, 1)
        if decide(tree, (*shape[i], *shape[i - 1], *shape[i + 1], b[3], b[4], has_main and not b[4]))
    )


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row; other columns are ignored."""
    tree = train() if tree is None else tree

    def run(batch: pa.RecordBatch):
        for begin in range(0, len(batch), 500):
            part = batch.slice(begin, 500)
            texts = [main_text(p, tree) for p in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return arrow_map(
        pages.select("page_id", "url", "html"),
        f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long",
        run,
    )
