"""Plain-Python versions of operators, for small tables."""

from __future__ import annotations

import html.parser
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def roots(pairs, nodes) -> dict:
    """Least node of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def near_duplicates(docs: list[tuple[int, str | None]], percent: int = 85):
    """doc_id -> (n_shingles, component_id); doc_ids are distinct."""
    sets = {i: shingles(t) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    pairs = set()
    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in where[x]:
                if j < i:
                    shared[j] += 1
        pairs |= {(j, i) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)}
    root = roots(pairs, sets)
    return {i: (len(sets[i]), root[i]) for i in sets}


def repeated_lines(docs: list[tuple[int, str | None]], least: int = 5) -> dict[int, list[int]]:
    """doc_id -> numbers of the lines that match an earlier line at Jaccard >= 0.8."""
    lines = [(i, k, frozenset(words(x))) for i, t in sorted(docs) for k, x in enumerate((t or "").split("\n"))] if docs else []
    where, gone = defaultdict(list), defaultdict(list)
    for at, (i, k, s) in enumerate(lines):
        if len(s) < least:
            continue
        shared = defaultdict(int)
        for w in s:
            for j in where[w]:
                shared[j] += 1
            where[w].append(at)
        if any(5 * n >= 4 * (len(s) + len(lines[j][2]) - n) for j, n in shared.items()):
            gone[i].append(k)
    return dict(gone)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans."""
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "phone": 10 <= len(digits) <= 15,
                    "card": 14 <= len(digits) <= 19 and luhn(digits)}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


class _Article(html.parser.HTMLParser):
    """The blocks inside <article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.now = 0, [], ""

    def cut(self, tag):
        if tag not in ("a", "b", "i", "em", "strong", "span", "code", "small", "br"):
            text = " ".join(self.now.split())
            if text:
                self.blocks.append(text)
            self.now = ""

    def handle_starttag(self, tag, attrs):
        self.cut(tag)
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        self.cut(tag)
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.now += data


def article_blocks(page):
    parser = _Article()
    parser.feed(page)
    parser.close()
    return parser.blocks
