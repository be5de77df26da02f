"""Main text of web pages by line-block distribution.

A page is read once into blocks: the lines of text that block elements delimit.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are told by element, role, class or id; they leave an empty
line each. A block weighs its characters outside links; on pages that mark their
text, one inside an ``article`` or ``main`` element weighs ``MARK`` more and
any other ``MARK`` less. Weights are summed over a sliding window of ``WINDOW``
lines. Where the sum surges to ``SURGE`` a text begins, where it dives to
nothing, or a line weighs less than nothing, the text ends, and every block
between is kept. A heading directly before a text belongs to it, and so do the
short lines between the two. On a page where nothing surges the fullest window
counts as the surge, so short texts are found too.

NULL, empty and broken pages give an empty text or what their text holds;
unclosed tags, attributes and comments do not stop the reader. Pages are read
one by one in Arrow batches, whole however long they are: repeated ids and
further columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80
MARK = 1000  # what the page's own mark of its text weighs, in characters
BETWEEN = "\n\n"  # what stands between two blocks of an extracted text

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.I) for name in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "video", "audio", "canvas")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DROPPED = frozenset("nav aside footer form menu dialog head button select datalist fieldset search".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promotions promoted banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars sidenav aside footer masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay disclaimer newsletter subscribe subscription signup login "
    "comment comments commentlist disqus reply replies respond responses share sharing social related recommended recommendations widget widgets skip".split()
)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSES_P = _BLOCK - {"body", "html", "head"}


@dataclass
class Block:
    text: str
    weight: int
    inside: int  # number of the innermost article or main element, 0 outside of any
    heading: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _is_boilerplate(name: str, attributes: dict[str, str], in_text: bool) -> bool:
    if name in _DROPPED or (name == "header" and not in_text):
        return True
    if name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    if attributes.get("role", "").lower() in _DROPPED_ROLES:
        return True
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for part in value.split():
            words = {w.lower() for w in _NAME_PARTS.findall(part)}
            if words & _DROPPED_NAMES or ("header" in words and not in_text and words & {"site", "page", "top", "main", "header"} == words):
                return True
    return False


def _tags(page: str) -> list[tuple[str, str, str, int, int]]:
    """(kind, name, attributes, start, end) of tags, comments and raw elements, in order."""
    found, at = [], 0
    while (m := _TOKEN.search(page, at)) is not None:
        name = (m[2] or m[5] or "").lower()
        closing = bool(m[1] or m[4])
        at = m.end()
        if not name:
            found.append(("skip", "", "", m.start(), at))
        elif closing:
            found.append(("close", name, "", m.start(), at))
        elif name in _RAW_END and not (m[3] or m[6] or "").rstrip().endswith("/"):
            at = _RAW_END[name].search(page, at).end()  # type: ignore[union-attr]
            found.append(("skip", name, "", m.start(), at))
        else:
            found.append(("open", name, m[3] or m[6] or "", m.start(), at))
    return found


def _closings(tags: list[tuple[str, str, str, int, int]]) -> dict[int, int]:
    """For each opening tag the one that closes it, where there is one."""
    opened: dict[str, list[int]] = {}
    pairs = {}
    for i, (kind, name, raw, *_) in enumerate(tags):
        if kind == "open" and name not in _VOID:
            opened.setdefault(name, []).append(i)
        elif kind == "close" and opened.get(name):
            pairs[opened[name].pop()] = i
    return pairs


def blocks(page: str) -> list[Block]:
    """The page's lines of text in order; an empty one for each dropped element."""
    tags = _tags(page)
    closings = _closings(tags)
    out: list[Block] = []
    pieces: list[str] = []
    linked = 0
    containers: list[tuple[int, int]] = []  # (number, index of the closing tag)
    n_containers = links = heading = 0
    headings_only = -1  # inside an article's header up to this tag

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text and (headings_only < 0 or heading):
            out.append(Block(text, max(0, len(text) - linked), containers[-1][0] if containers else 0, heading > 0))
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = unescape(raw)
        pieces.append(text)
        if links:
            linked += len(text.strip())

    at = i = 0
    while i <= len(tags):
        start = tags[i][3] if i < len(tags) else len(page)
        if start > at:
            add(page[at:start])
        if i == len(tags):
            break
        kind, name, raw, _, at = tags[i]
        while containers and containers[-1][1] <= i:
            flush()
            containers.pop()
        if kind == "open" and name not in _VOID:
            attributes = _attributes(raw) if raw.strip() else {}
            end = closings.get(i)
            if _is_boilerplate(name, attributes, bool(containers)):
                if name in _BLOCK:
                    flush()
                    out.append(Block("", 0, containers[-1][0] if containers else 0, False))
                if end is None:  # unclosed: up to the next block
                    end = next((j - 1 for j in range(i + 1, len(tags)) if tags[j][1] in _BLOCK), len(tags) - 1)
                    at = tags[end + 1][3] if end + 1 < len(tags) else len(page)
                else:
                    at = tags[end][4]
                i = end + 1
                continue
            if name in _BLOCK:
                flush()
            if name in ("article", "main") or attributes.get("role") in ("article", "main") or attributes.get("itemprop") == "articleBody":
                n_containers += 1
                containers.append((n_containers, end if end is not None else len(tags)))
            if name == "header" and end is not None:
                headings_only = end
            if name in _HEADINGS and end is not None:
                heading += 1
            if name == "a" and end is not None:
                links += 1
        elif kind == "close":
            if name in _BLOCK:
                flush()
            if name in _HEADINGS:
                heading = max(0, heading - 1)
            if name == "a":
                links = max(0, links - 1)
            if headings_only == i:
                headings_only = -1
        elif name in ("br", "wbr", "td", "th", "img", "input") and name != "wbr":
            pieces.append(" ")
        elif name in _BLOCK:
            flush()
        if kind in ("open", "close") and name in ("td", "th"):
            pieces.append(" ")
        i += 1
    flush()
    return out


def line_weights(lines: list[Block], mark: int = MARK) -> list[int]:
    """Characters outside links, moved by ``mark`` where the page marks its text; empty lines weigh nothing."""
    if not any(line.inside and line.weight for line in lines):
        return [line.weight for line in lines]
    return [line.weight + (mark if line.inside else -mark) if line.text else 0 for line in lines]


def surging(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first, last) lines of the texts: from a surge of the window's sum to its dive.

    The window starts at its line; lines below nothing add nothing to it. A text
    begins where the window reaches ``surge`` at a line that brings a quarter of
    it or more, so a short line before the text stays outside; if none does, the
    fullest window that starts at such a line is the surge. It ends before the first window that holds nothing
    and before a line below nothing.
    """
    ahead = [sum(max(0, w) for w in weights[i : i + window]) for i in range(len(weights))]
    least = max((reach for w, a in zip(weights, ahead) if w >= max(1, (reach := min(a, surge)) // 4)), default=surge)
    texts, begin = [], None
    for i, weight in enumerate(weights):
        if begin is None and ahead[i] >= least and weight >= max(1, least // 4):
            begin = i
        elif begin is not None and (weight < 0 or not ahead[i]):
            texts.append((begin, i - 1))
            begin = None
    if begin is not None:
        texts.append((begin, len(weights) - 1))
    return texts


def _with_heading(lines: list[Block], weights: list[int], first: int, window: int) -> int:
    """Where a text begins with the headings before it; ``window`` short lines may stand between."""
    def joins(i: int) -> bool:
        return i >= 0 and bool(lines[i].text) and weights[i] >= 0

    at = first - 1
    while joins(at) and not lines[at].heading and first - at < window:
        at -= 1
    if not joins(at) or not lines[at].heading:
        return first
    while joins(at - 1) and lines[at - 1].heading:
        at -= 1
    return at


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE, between: str = "\n", mark: int = MARK) -> str:
    """The page's main text, a line per block; ``between`` joins the blocks."""
    lines = blocks(page or "")
    weights = line_weights(lines, mark)
    kept: list[str] = []
    done = 0
    for first, last in surging(weights, window, surge):
        first = max(done, _with_heading(lines, weights, first, window))
        kept += [line.text for line in lines[first : last + 1] if line.text]
        done = last + 1
    return between.join(kept)


def extract(pages: DataFrame, html: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """The rows with ``text``, blocks joined by ``BETWEEN``, and ``n_chars``; columns of these names are replaced."""
    def batches(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in values:
            yield batch.map(lambda page: main_text(page, window, surge, BETWEEN))

    text = F.pandas_udf(batches, "string")(F.col(html))  # type: ignore[call-overload]
    return pages.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("bigint"))
