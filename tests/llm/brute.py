"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def suffix_dedup(docs: list[tuple[int, str | None]], size: int = 50) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    raw = {d: (t or "").encode() for d, t in docs}
    for d in sorted(raw):
        for i in range(len(raw[d]) - size + 1):
            first.setdefault(raw[d][i:i + size], d)
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i:i + size]] < d:
                gone[i:i + size] = b"\1" * size
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text: str | None) -> set[tuple]:
    w = SPACE_WORD.findall(lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)}


def jaccard_components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in docs}
    groups: dict[frozenset, list[int]] = defaultdict(list)
    for d, s in sets.items():
        groups[frozenset(s)].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(x, y):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)

    lists: dict[tuple, list[frozenset]] = defaultdict(list)
    for s, ids in groups.items():
        if s:
            for d in ids:
                join(ids[0], d)
            for x in s:
                lists[x].append(s)
    for s, ids in groups.items():
        common = Counter(t for x in s for t in lists[x])
        for t, n in common.items():
            if 190 * n >= 90 * (len(s) + len(t)):
                join(ids[0], groups[t][0])
    return {d: (len(s), find(d)) for d, s in sets.items()}


def lm_base(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    toks = {d: [*SPACE_WORD.findall(lower(t or "")), None] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in toks}
    count = Counter(w for d, ws in toks.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    return {d: (held[d], len(ws), sum(count[w] > 0 for w in ws), n,
                sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for d, ws in toks.items()}


def lm_score(docs: list[tuple[int, str | None]], order: int = 3, discount: float = 0.75) -> dict[int, float]:
    toks = {d: [*SPACE_WORD.findall(lower(t or "")), None] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in toks}
    one, seen = Counter(), {n: Counter() for n in (2, 3)}       # a text's first word has only its start before it
    for d, ws in toks.items():
        if not held[d]:
            one.update(ws)
            for n in seen:
                padded = [None, *ws]
                seen[n].update(tuple(padded[i:i + n]) for i in range(len(padded) - n + 1))
    total, follow = Counter(), Counter()
    for n in seen:
        for gram, c in seen[n].items():
            total[gram[:-1]] += c
            follow[gram[:-1]] += 1
    n_all, v = sum(one.values()), len(one)

    def p(context, w):
        if not context:
            return (one[w] + 0.5) / (n_all + 0.5 * (v + 1))
        less = p(context[1:], w)
        if not total[context]:
            return less
        return (max(seen[len(context) + 1][(*context, w)] - discount, 0) + discount * follow[context] * less) / total[context]

    return {d: sum(math.log10(p((None, *ws)[max(0, i + 2 - order):i + 1], w)) for i, w in enumerate(ws)) for d, ws in toks.items()}


def near_components(docs, size, percent):
    """As jaccard_components, at any setting."""
    sets, lists = {}, defaultdict(list)
    for d, text in docs:
        w = SPACE_WORD.findall(lower(text or ""))
        sets[d] = {tuple(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()
        for x in sets[d]:
            lists[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for t, n in Counter(t for x in s for t in lists[x]).items():
            if 100 * n >= percent * (len(s) + len(sets[t]) - n):
                x, y = find(d), find(t)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}
