"""Brute-force versions that the tests compare with."""

from __future__ import annotations

import re
import unicodedata


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, width=5):
    w = words(lower(text))
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def brute_components(texts):
    """doc_id -> smallest doc_id reachable by links at a Jaccard similarity of 0.8."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 10 * min(len(x), len(y)) >= 8 * max(len(x), len(y)):
                same = len(x & y)
                if 100 * same >= 80 * (len(x) + len(y) - same):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def has_letter(text):
    return any(unicodedata.category(c)[0] == "L" for c in text or "")
