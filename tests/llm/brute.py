"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def substring_dedup(rows, window=13):
    """[(doc_id, n_words, n_removed, kept)] of [(doc_id, text)]."""
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def suffix_dedup(rows, length):
    """[(doc_id, n_bytes, n_removed, n_spans, kept)]; rows of one doc_id never repeat one another."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            if i is not None:
                s = b[k:k + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        drop, seen = [False] * len(b), set()
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            if i is not None and (first[s] < i or s in seen):
                drop[k:k + length] = [True] * length
            seen.add(s)
        spans = sum(d and not (k and drop[k - 1]) for k, d in enumerate(drop))
        out.append((i, len(b), sum(drop), spans, bytes(x for x, d in zip(b, drop) if not d)))
    return out


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else (tuple(w[k:k + n]) for k in range(len(w) - n + 1)))


def jaccard(rows, n=4, percent=85):
    """[(doc_id, n_shingles, component_id)]; rows are linked, not ids."""
    sets = [shingles(t, n) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = find(k)
            ids[r] = min(ids.get(r, i), i)
    return [(i, len(sets[k]), ids.get(find(k))) for k, (i, _) in enumerate(rows)]


def base_counts(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    repeat = set()
    for k in range(len(w) - 7):
        if c[tuple(w[k:k + 8])] > 1:
            repeat |= set(range(k, k + 8))
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), dup, len(repeat)


UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")


def holds(text, item, window=13, subs=2, shortest=8):
    """Does the text hold the benchmark item?  Short ones whole: word by word, or over characters without spaces."""
    a, b = (words((x or "").translate(LOWER)) for x in (text, item))
    if not b:
        return False
    if len(b) < shortest and UNSPACED.search(item):
        return item.strip(" \t\n\x0b\x0c\r").translate(LOWER) in (text or "").translate(LOWER)
    if len(b) < window:
        return any(a[k:k + len(b)] == b for k in range(len(a) - len(b) + 1))
    if len(a) < window:
        return False
    ids: dict = {}
    a, b = (np.array([ids.setdefault(x, len(ids)) for x in w]) for w in (a, b))
    rows = np.lib.stride_tricks.sliding_window_view(a, window)
    return any(((rows == b[j:j + window]).sum(axis=1) >= window - subs).any() for j in range(len(b) - window + 1))


def sha256(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def crc32_ids(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
