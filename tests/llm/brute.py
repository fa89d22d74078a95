"""Plain brute-force versions that the operators are compared with."""

from __future__ import annotations

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def grams(ws, n=5):
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if len(ws) >= n else frozenset([tuple(ws)])


def similar(a, b, threshold=0.8):
    both = len(a & b)
    return both > 0 and both >= threshold * len(a | b) - 1e-9


def classes(rows):
    """{id: (class, links)} for (id, text) rows."""
    sets = [(i, grams(words(t))) for i, t in rows]
    links, parent = collections.Counter(), {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            if similar(sets[x][1], sets[y][1]):
                links[x] += 1
                links[y] += 1
                a, b = find(sets[x][0]), find(sets[y][0])
                parent[max(a, b)] = min(a, b)
    return [(i, find(i), links[k]) for k, (i, _) in enumerate(sets)]


def removed_lines(rows):
    """{id: line numbers} of lines equal or similar to an earlier one, for (id, text) rows in order."""
    seen, out = [], collections.defaultdict(set)
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            g = grams(words(line))
            if g:
                if any(similar(g, s) for s in seen):
                    out[i].add(k)
                seen.append(g)
    return out


def covered(rows, n=50):
    """{id: word positions} inside n-word windows that another row has too."""
    where = collections.defaultdict(set)
    texts = [(k, i, words(t)) for k, (i, t) in enumerate(rows)]
    for k, _, w in texts:
        for s in range(len(w) - n + 1):
            where[tuple(w[s : s + n])].add(k)
    out = collections.defaultdict(set)
    for _, i, w in texts:
        for s in range(len(w) - n + 1):
            if len(where[tuple(w[s : s + n])]) > 1:
                out[i].update(range(s, s + n))
    return out


def stats(text, window=8):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = collections.Counter(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    cover = set()
    for k in range(len(w) - window + 1):
        if count[tuple(w[k : k + window])] > 1:
            cover.update(range(k, k + window))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)
