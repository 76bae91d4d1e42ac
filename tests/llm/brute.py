"""Plain reference computations over small tables."""

import re
import zlib

SPACES = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = split_words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def near_components(rows, k, percent):
    """{doc_id: smallest linked doc_id} for rows of (doc_id, text); compares
    every pair that shares a shingle."""
    sets = {d: shingles(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index, common = {}, {}
    for d, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(d)
    for d, s in sets.items():
        common.clear()
        for x in s:
            for e in index[x]:
                if e < d:
                    common[e] = common.get(e, 0) + 1
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return {d: find(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def crc(text):
    return zlib.crc32(text.encode())
