"""Slow, plain versions of the operators to compare with."""

import re
from html.parser import HTMLParser

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, size=5):
    w = WORD.findall(lower(text))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def roots(nodes, edges):
    """Smallest node reachable from each node."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def jaccard(docs, size=5, percent=75):
    """{id: (set size, component)} of {id: text}, through an index of all shingles."""
    sets = {i: frozenset(shingle_set(t, size)) for i, t in docs.items()}
    where, edges, first = {}, [], {}
    for i, s in sets.items():
        if s:
            edges.append((i, first.setdefault(s, i)))
    for s, i in first.items():
        shared = {}
        for g in s:
            for j in where.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            where[g].append(i)
        edges += [(i, j) for j, c in shared.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
    found = roots(sets, edges)
    return {i: (len(s), found[i]) for i, s in sets.items()}


KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def base_spans(text):
    found = []
    for place, (kind, pattern, group, least) in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), place, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def line_block_text(lines, window, share):
    """Text by the line-block distribution of a page without articles, sum by sum."""
    light = [2 * line.linked > len(line.text) for line in lines]
    size = [0 if x else len(line.text) for line, x in zip(lines, light)]
    if not any(size):
        size = [len(line.text) for line in lines]
    total = lambda i: sum(size[k] for k in range(i, i + window) if 0 <= k < len(size))
    starts = range(1 - window, len(lines))
    some = [total(i) for i in starts if total(i)]
    bodies, held = [], []
    for i in [*starts, None]:
        if i is not None and total(i):
            held.append(i)
        elif held:
            inside = [k for k in range(held[0], held[-1] + window) if 0 <= k < len(lines) and size[k]]
            bodies.append((inside[0], inside[-1], max(map(total, held)) * len(some) * share >= sum(some)))
            held = []
    firm = [b for b in bodies if b[2]]
    kept = [b for b in bodies if firm and firm[0] <= b <= firm[-1]]
    return "\n\n".join(line.text for a, b, _ in kept for line in lines[a : b + 1] if line.text)


class _Article(HTMLParser):
    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "h2", "h3", "li", "ul", "div", "article", "blockquote"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1", "h2", "h3", "li", "ul", "div", "article", "blockquote"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def article_text(page):
    """The blocks of a page's article elements, by the standard library's parser."""
    parser = _Article()
    parser.feed(page or "")
    parser.close()
    return "\n\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)
