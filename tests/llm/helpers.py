"""Hand-made documents and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import re
import zlib

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return _WORDS.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def frame(spark, rows):
    """Documents from (doc_id, text[, source]); an extra column with a clashing name rides along."""
    data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(data, DOCUMENTS).selectExpr("*", "'x' AS score", "1 AS key", "2 AS size", "3 AS ids")


def shingle_set(text, size=3):
    w = words(lower(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def near_components(rows, size=3, percent=85):
    """doc_id -> (set size, smallest reachable id), over all pairs."""
    sets = [(d, shingle_set(t, size)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {d: (len(s), find(d)) for d, s in sets}


def removed_words(rows, window=50):
    """Row number -> flags of removed words, comparing every window of every row."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if d is not None and first[k] < d:
                gone[i:i + window] = [True] * window
        out.append(gone)
    return out


def repeat_words(w):
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    cover = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            cover |= {i, i + 1, i + 2}
    return len(cover)
