"""Plain versions of the operators over small lists of rows."""

from __future__ import annotations

import collections
import hashlib
import re

LOWER = {c: c + 32 for c in range(65, 91)}


def near_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def near_set(text, length):
    words = near_words(text)
    if len(words) < length:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + length]) for i in range(len(words) - length + 1))


def components(rows, length=2, percent=80):
    """{id: smallest id reachable} over all pairs, and set sizes."""
    sets = {i: near_set(t, length) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, window=13):
    wanted = collections.defaultdict(lambda: collections.defaultdict(set))
    for item, text in items:
        words = item_words(text)
        length = min(window, len(words))
        for i in range(len(words) - length + 1 if length else 0):
            wanted[length][tuple(words[i : i + length])].add(item)
    out = {}
    for doc, text in docs:
        words, hit, found = item_words(text), set(), set()
        for length, known in wanted.items():
            for i in range(len(words) - length + 1):
                if owners := known.get(tuple(words[i : i + length])):
                    found |= owners
                    hit.update(range(i, i + length))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def repeats(rows, length, copies="all"):
    """{id: (bytes, removed, spans, digest of the rest)}; ids are taken in ascending order."""
    data = sorted((i, (t or "").encode()) for i, t in rows)
    times = collections.Counter(d[p : p + length] for _, d in data for p in range(len(d) - length + 1))
    seen, out = set(), {}
    for i, d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            s = d[p : p + length]
            if times[s] > 1 if copies == "all" else s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out[i] = (len(d), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out
