"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def jaccard_classes(rows, percent=75):
    """{doc_id: (set size, smallest reachable id)}"""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def removed_windows(rows, width, by_words):
    """{doc_id: (tokens, removed, spans, kept bytes)}; ids are unique or null."""
    tokens = {}
    for i, t in rows:
        raw = (t or "").encode()
        tokens[i] = raw.split() if by_words else raw
    owner = {}
    for i in sorted(x for x in tokens if x is not None):
        for a in range(len(tokens[i]) - width + 1):
            owner.setdefault(tuple(tokens[i][a:a + width]), i)
    out = {}
    for i, own in tokens.items():
        gone = [False] * len(own)
        for a in range(len(own) - width + 1):
            if i is not None and owner[tuple(own[a:a + width])] < i:
                gone[a:a + width] = [True] * width
        kept = [w for w, g in zip(own, gone) if not g]
        spans = sum(g and not (n and gone[n - 1]) for n, g in enumerate(gone))
        out[i] = (len(own), sum(gone), spans, b" ".join(kept) if by_words else bytes(kept))
    return out


def exact_groups(rows):
    """{doc_id: (keep_id, group size, kept, sha256)} for unique ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = {}
    for text, ids in groups.items():
        for i in ids:
            out[i] = (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
    return out


def top_k(rows, is_query, k, scale=256):
    """[(query_id, rank, vec_id, score)]"""
    import math

    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok[i] = [math.floor(scale * x) for x in v]
    out = []
    for q in ok:
        if is_query(q):
            best = sorted((-sum(x * y for x, y in zip(ok[q], ok[c])), c) for c in ok if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)
