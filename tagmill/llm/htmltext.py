"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
# A body surges where a block reaches this part of the page's mean block.
SHARE = 32
# How much more than other text an article's counts, and the characters below which other text is no surge beside one.
HINT = 6
SURGE = 16
# Element names with a fixed meaning in HTML.
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
UNPARSED = frozenset("script style noscript textarea title iframe".split())
RAW = UNPARSED | frozenset("template svg object select button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FRAMES = frozenset("nav header footer aside form head menu dialog".split())
# Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion cookie cookies consent"
    " gdpr notice notices alert popup modal overlay menu menubar nav navbar navigation breadcrumb breadcrumbs sidebar rail widget"
    " footer header masthead comment comments respond reply replies disqus share sharing social related recommended newsletter"
    " subscribe signup login search pagination pager toolbar complementary contentinfo copyright".split()
)
# Words that leave a mark beside them what it is.
PLACES = frozenset(
    "area bar block body bottom box column container content field group inner item left link links list main outer page panel"
    " primary reader readers right row secondary section site slot thread top unit user users view widgets wrap wrapper zone".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>\"']*+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_UNPARSED_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in UNPARSED}
_LEGAL = re.compile(r"(?:©|\(c\)\s|copyright\b)", re.I)


class Line(NamedTuple):
    """A text block, the number of the outermost article it lies in or 0, and how many of its characters are links."""

    text: str
    home: int = 0
    linked: int = 0
    heading: bool = False


class Tag(NamedTuple):
    """A tag's bounds in the page, its name in lower case and its attributes; comments have no name."""

    start: int
    end: int
    name: str
    closing: bool
    given: str


def _attributes(tag: str) -> dict[str, str]:
    """Attribute values by name in lower case; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(tag):
        found.setdefault(name.lower(), "".join(values))
    return found


def _marked(given: dict[str, str], depth: int) -> bool:
    """Whether a word of class, id or role is a mark, or made of marks and places; an article may have a header."""
    words = " ".join(given.get(n, "") for n in ("class", "id", "role")).lower().split()
    marks = MARKS - {"header"} if depth else MARKS
    parts = [{p for p in re.split(r"[-_\d]+", word) if p} for word in words]
    return any(marks & p and p <= marks | PLACES for p in parts)


def _hidden(given: dict[str, str]) -> bool:
    shown = given.get("aria-hidden", "").strip().lower() != "true" and not _NOT_SHOWN.search(html.unescape(given.get("style", "")))
    return "hidden" in given or not shown


def tags(page: str) -> tuple[list[Tag], list[int | None]]:
    """All tags and comments of the page, and for each the place in the list of the tag that closes it, or None.

    One pass with a stack of open tags for each name, so unclosed elements cost no search.
    What stands in a script, a style or the like is no markup; it ends at its own end tag
    or with the page.
    """
    found: list[Tag] = []
    ends: list[int | None] = []
    opened: dict[str, list[int]] = {}
    at = 0
    while m := _TOKEN.search(page, at):
        name = (m.group(2) or "").lower()
        closing, given = bool(m.group(1)), m.group(3) or ""
        found.append(Tag(m.start(), m.end(), name, closing, given))
        ends.append(None)
        at = m.end()
        if closing:
            if opened.get(name):
                ends[opened[name].pop()] = len(found) - 1
        elif name in UNPARSED and not given.rstrip().endswith("/"):
            end = _UNPARSED_END[name].search(page, at)
            ends[-1] = len(found)
            found.append(Tag(*(end.span() if end else (len(page), len(page))), name, True, ""))
            ends.append(None)
            at = found[-1].end
        elif name and not given.rstrip().endswith("/"):
            opened.setdefault(name, []).append(len(found) - 1)
    return found, ends


def _longest_article(page: str, found: list[Tag], ends: list[int | None]) -> int:
    """The place of the page's longest article or main element, or -1."""
    sizes = [
        ((len(page) if end is None else found[end].start) - tag.end, -i)
        for i, (tag, end) in enumerate(zip(found, ends))
        if tag.name in ("article", "main") and not tag.closing
    ]
    return -max(sizes)[1] if sizes else -1


def lines(page: str) -> list[Line]:
    """The page's text blocks in order, one a line, with the empty lines that tags leave between them.

    Every block tag ends a line; two in a row part neighbours, each further one leaves
    an empty line.  Elements that hold no article text, by name or by class, leave
    ``WINDOW`` empty lines, as do the bounds of articles.  One that is never closed is
    skipped only if it may run to the end.  What holds the page's longest article is
    skipped only where it is hidden.
    """
    found: list[Line] = []
    parts: list[str] = []
    depth = articles = linked = at = i = 0
    bare = WINDOW
    link = heading = False
    known, ends = tags(page)
    longest = _longest_article(page, known, ends)

    def flush():
        nonlocal linked, bare
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append(Line(text, articles if depth else 0, linked, heading))
            bare = 0
        linked = 0

    while True:
        tag = known[i] if i < len(known) else None
        parts.append(page[at : tag.start if tag else len(page)])
        linked += len(parts[-1].strip()) if link else 0
        if tag is None:
            break
        at, name, closing = tag.end, tag.name, tag.closing
        i += 1
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            link = not closing
        inside = name in ("article", "main")
        skip = hidden = False
        if not closing and not tag.given.rstrip().endswith("/"):
            given = _attributes(tag.given) if tag.given and name not in ("html", "body") else {}
            hidden = name in RAW or _hidden(given)
            skip = hidden or (name in FRAMES and not (name == "header" and depth)) or _marked(given, depth)
        if skip:
            end = ends[i - 1]
            if end is None and name in RAW | {"footer"}:
                end = len(known)
            if end is not None and not hidden and i - 1 <= longest < end:
                end = None
            if end is not None:
                at = known[end].end if end < len(known) else len(page)
                i = end + 1
                if name in BREAKS or name not in RAW:
                    flush()
                    found.extend([Line("")] * WINDOW)
                continue
        if name in BREAKS:
            flush()
            bare += 1
            if bare > 2:
                found.append(Line(""))
            heading = name in HEADINGS and not closing
            if inside:
                before, depth = depth, max(0, depth + (-1 if closing else 1))
                if not before or not depth:
                    articles += not closing
                    found.extend([Line("")] * WINDOW)
    flush()
    return found


def weights(found: list[Line]) -> np.ndarray:
    """What each line adds to its blocks: its length, and nothing for lines of links or legal lines outside of articles.

    A page of nothing else counts them all.
    """
    sizes = np.array([len(line.text) for line in found], np.int64)
    light = [not line.home and (2 * line.linked > len(line.text) or bool(_LEGAL.match(line.text))) for line in found]
    weighed = np.where(np.array(light, bool), 0, sizes)
    return weighed if weighed.any() else sizes


def _chosen(bodies: list[tuple[int, int]], found: list[Line], sizes: np.ndarray, blocks: np.ndarray) -> list[tuple[int, int]]:
    """The bodies in articles or outside, by which holds more text, and those that surge on the other side.

    Articles count ``HINT`` times.  Beside them other text stays if a block of it has
    ``SURGE`` characters and a third of the page's highest.  Where other text holds
    more, articles stay but for cards, whose headline or most of whose text is a link.
    """
    sides: dict[int, list[tuple[int, int]]] = {}
    for a, b in bodies:
        sides.setdefault(found[a].home, []).append((a, b))
    text = {home: sum(int(sizes[a:b].sum()) for a, b in own) for home, own in sides.items()}
    outside, inside = text.get(0, 0), sum(n for home, n in text.items() if home)
    if not inside or not outside:
        return bodies
    if outside > HINT * inside:
        cards = set()
        for home, own in sides.items():
            held = [line for a, b in own for line in found[a:b] if line.text]
            leads = any(line.heading and 2 * line.linked > len(line.text) for line in held)
            if home and (leads or 2 * sum(line.linked for line in held) > text[home]):
                cards.add(home)
        return [body for body in bodies if found[body[0]].home not in cards]
    height = max(int(blocks[a : b + WINDOW - 1].max()) for a, b in sides[0])
    if height >= SURGE and 3 * height >= int(blocks.max()):
        return bodies
    return [body for body in bodies if found[body[0]].home]


def main_text(page: str | None) -> str:
    """Text between the surge and dive points of the line-block distribution.

    A block is the weight of ``WINDOW`` lines from a line on; lines of links weigh
    nothing.  Where the blocks rise from zero the text surges, where they fall back to
    zero it dives; between the first and the last line with weight lies one body, with
    what weighs nothing inside it.  A run of ``WINDOW`` or more lines without weight, a
    menu or what skipped elements leave, parts bodies.  On pages that mark up articles
    the bodies in and outside of them are weighed against each other.  All bodies from
    the first to the last with a block that reaches the page's own threshold, its mean
    block by ``SHARE``, are kept whole, however short those between are.
    """
    found = lines(page or "")
    sizes = weights(found)
    sums = np.concatenate([np.zeros(WINDOW, np.int64), np.cumsum(sizes), np.full(WINDOW - 1, sizes.sum(), np.int64)])
    # blocks[i] is the sum of the lines from i - WINDOW + 1 to i, so a line lies in blocks i to i + WINDOW - 1.
    blocks = sums[WINDOW:] - sums[:-WINDOW]
    full = np.concatenate([[False], blocks > 0, [False]])
    surges, dives = np.flatnonzero(~full[:-1] & full[1:]), np.flatnonzero(full[:-1] & ~full[1:])
    bodies = [(a, b - WINDOW + 1) for a, b in zip(surges.tolist(), dives.tolist())]
    if not bodies:
        return ""
    bodies = _chosen(bodies, found, sizes, blocks)
    threshold = float(blocks[blocks > 0].mean()) / SHARE
    firm = [k for k, (a, b) in enumerate(bodies) if found[a].home or blocks[a : b + WINDOW - 1].max() >= threshold]
    kept = bodies[firm[0] : firm[-1] + 1] if firm else []
    return "\n\n".join(line.text for a, b in kept for line in found[a:b] if line.text)


def extract_main_text(df: DataFrame, page: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``text``, the main text of every whole page.

    White space inside a block is one space; blocks are joined by an empty line.  NULL
    and empty pages, and pages without text, give an empty text; every row is kept and
    judged by itself; input columns named ``text`` are replaced.
    """
    keep = [c for c in (keep or df.columns) if c != "text"]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(p) for p in batch.column(len(keep)).to_pylist()]
                columns = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())], names=[*keep, "text"])

    return df.select(*keep, df[page].alias("_page")).mapInArrow(run, f"{kind}, text string")
