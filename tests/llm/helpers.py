"""Plain versions of the operators' rules, and odd documents that every operator must take."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

LOWER = {i: i + 32 for i in range(65, 91)}
WORDS = "the of and river stone light under over green house walks slowly between many old trees near water".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ing", "ed", str(r.randrange(40))]) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, repeated rows and ids."""
    long_text = prose(1, 60_000)
    base = prose(2, 120)
    words = base.split()
    near = " ".join([*words[:110], "changed", *words[111:]])
    return [
        (1, base, "en", "a", 1),
        (2, base.upper(), "en", "a", 1),
        (3, near, "en", "b", 1),
        (4, None, "en", "b", None),
        (5, "", None, None, 0),
        (6, " \t\n ", "en", None, 4),
        (None, prose(3, 30), "en", "c", 1),
        (None, None, None, None, None),
        (7, long_text, "en", "a", 1),
        (8, "x" * 300_000, "en", "c", 1),
        (9, prose(4, 40), "en", "", 1),
        (9, prose(4, 40), "en", "", 1),
        (9, prose(5, 40), "en", "", 1),
        (10, "one two three", "en", "a", 1),
        (11, "One  Two\nTHREE", "en", "a", 1),
        (12, "Été \U0001f600 ▁▁ 日本語 <s> \x00 é", "fr", "é", 1),
        (13, "0 1 2 ++ -- @", "en", "a", 1),
    ]


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text: str | None) -> frozenset:
    w = split_words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def jaccard_components(rows: list[tuple]) -> list[tuple]:
    """(id, set size, least id of the component) of (id, text) rows, by counting shared shingles."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in having[g])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            having[g].append(i)
    least: dict[int, int | None] = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        ids = [x for x in (least.get(root), doc_id) if x is not None]
        least[root] = min(ids) if ids else None
    return [(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)]


def jaccard_links(rows: list[tuple]) -> list[tuple]:
    """(id, number of other rows that the row links with), every pair compared."""
    sets = [shingle_set(t) for _, t in rows]
    link = lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b)
    return [(doc_id, sum(link(sets[i], s) for j, s in enumerate(sets) if j != i)) for i, (doc_id, _) in enumerate(rows)]


def plain_pii(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) by the rules as they are written, with plain patterns."""
    text = text or ""
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m.group().split("."))) <= 255:
            out.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        doubled = [sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))]
        if 12 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], ["email", "ip", "card", "phone"].index(s[1])))
