"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import re

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text, lower=False):
    t = text or ""
    if lower:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    return WORD.findall(t)


def repeats(rows, n):
    """{position in rows: (n_words, kept words, spans)}: every word covered by
    an n-word window that also starts earlier goes."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), {}
    for i in order:
        w = words(rows[i][1])
        gone = set()
        for s in range(len(w) - n + 1):
            k = tuple(w[s:s + n])
            if k in seen:
                gone.update(range(s, s + n))
            seen.add(k)
        out[i] = (len(w), [x for j, x in enumerate(w) if j not in gone], sorted(gone))
    return out


def shingles(text, k):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard_components(rows, k, num, den):
    """{doc_id: (set size, smallest id reachable by links)}."""
    sets = {d: shingles(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    by = {}
    for d, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(d)
    near = {(a, b) for own in by.values() for a in own for b in own if a < b}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}
