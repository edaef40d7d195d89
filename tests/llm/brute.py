"""Plain single-process versions of the operators, written from their contracts."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(docs, items, size=10):
    """doc rows -> (doc_id, n_words, n_hit, n_items, sha, contaminated)"""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if w and item is not None:
            for i in range(max(1, len(w) - size + 1)):
                windows[tuple(w[i:i + size])].add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def near(docs, k, over, under):
    """doc rows -> (doc_id, n_shingles, component_id, kept); all pairs"""
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and under * len(a & b) >= over * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(sets[i]), least[top(i)], d == least[top(i)]) for i, (d, _) in enumerate(docs)]


def line_runs(docs, min_words):
    """doc rows -> {doc_id: kept lines}: every run of lines, of any length, with enough words and an earlier place"""
    lines = {d: t.split("\n") for d, t in docs if t is not None}
    first = {}
    runs = []
    for d in sorted(lines):
        own = lines[d]
        for i in range(len(own)):
            n = 0
            for j in range(i, len(own)):
                n += len(own[j].split())
                key = tuple(own[i:j + 1])
                first.setdefault(key, (d, i))
                if n >= min_words:
                    runs.append((d, i, j, key))
    gone = defaultdict(set)
    for d, i, j, key in runs:
        if first[key] < (d, i):
            gone[d].update(range(i, j + 1))
    return {d: [x for i, x in enumerate(own) if i not in gone[d]] for d, own in lines.items()}


def neighbours(rows, queries, n=10):
    """(vec_id, vector) rows -> {query: [(distance, vec_id)]}"""
    good = {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    return {q: sorted((math.dist(good[q], v), i) for i, v in good.items() if i != q)[:n] for q in queries if q in good}


def crc(text):
    return zlib.crc32((text or "").encode())
