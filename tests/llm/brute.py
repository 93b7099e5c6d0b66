"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter


def repeated_words(texts, window):
    docs = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(d) if i not in gone)
        out.append((len(d), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeated_bytes(texts, window):
    docs = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[hash(d[i:i + window])] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def near_documents(ids, texts, percent=75):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    posting = {}
    for i, s in enumerate(sets):
        for x in s:
            posting.setdefault(x, []).append(i)
    parent = list(range(len(ids)))
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in posting[x] if j > i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        r = find(parent, i)
        least[r] = min(least.get(r, x), x)
    return [(x, len(s), least[find(parent, i)]) for i, (x, s) in enumerate(zip(ids, sets))]
