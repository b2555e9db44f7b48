"""Plain forms of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 63


def words(text):
    return WORD.findall(text or "")


def order(doc_id):
    return LAST if doc_id is None else doc_id


def exact(rows):
    """(doc_id, keep_id, group_size, kept, digest) per row of (doc_id, text)."""
    groups = {}
    for n, (doc_id, text) in enumerate(rows):
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(normal, []).append((-len(text or ""), order(doc_id), n, doc_id))
    out = [None] * len(rows)
    for normal, members in groups.items():
        keep = min(members)
        for _, _, n, doc_id in members:
            out[n] = (doc_id, keep[3], len(members), n == keep[2], hashlib.sha256(normal.encode()).hexdigest())
    return out


def repeated_words(rows, window):
    """(doc_id, n_words, n_removed, digest)."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key, at = tuple(w[i : i + window]), (order(doc_id), i)
            first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (order(doc_id), i):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeated_bytes(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, digest)."""
    first = {}
    for doc_id, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            key = b[i : i + length]
            first[key] = min(first.get(key, LAST), order(doc_id))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < order(doc_id):
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def similar(rows, similarity=0.8):
    """(doc_id, class_id, n_links) of every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common and common >= similarity * (len(a) + len(b) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), (LAST, None)), (order(doc_id), doc_id), key=lambda x: x[0])
    return [(doc_id, least[root(i)][1], links[i]) for i, (doc_id, _) in enumerate(rows)]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def unigram(rows):
    """(doc_id, n_tokens, n_known, train_tokens, base_score)."""
    tokens = [[*words((t or "").translate(_LOWER)), None] for _, t in rows]
    count = Counter(w for (d, _), ws in zip(rows, tokens, strict=True) if not held_out(d, 10, 0) for w in ws)
    n, v = sum(count.values()), len(count)
    score = [sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws) for ws in tokens]
    return [(d, len(ws), sum(count[w] > 0 for w in ws), n, s) for (d, _), ws, s in zip(rows, tokens, score, strict=True)]
