"""Plain versions of the operators, one row at a time."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def op1(rows, window=50):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    big = float("inf")
    for d, ws in split:
        for i in range(len(ws) - window + 1):
            k = tuple(ws[i : i + window])
            first[k] = min(first.get(k, big), big if d is None else d)
    out = []
    for d, ws in split:
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (big if d is None else d):
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.append((d, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def op2(rows, window=200):
    seen = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        for i in range(len(b) - window + 1):
            k = b[i : i + window]
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = b"\x01" * window
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, k=5):
    ws = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())


def op8(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    ids = [float("inf") if d is None else d for d, _ in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), float("inf")), ids[i])
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[root(i)]
        out.append((d, len(sets[i]), None if c == float("inf") else c, ids[i] == c))
    return out
