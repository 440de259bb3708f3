"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORDS.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring(rows, width=20):
    """(doc_id, text) -> (doc_id, n_words, n_removed, kept_sha256)"""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = words(text)
        gone = bytearray(len(w))
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            if g in seen:
                gone[k:k + width] = b"\1" * width
            seen.add(g)
        kept = [x for x, z in zip(w, gone) if not z]
        out.append((doc_id, len(w), sum(gone), sha(" ".join(kept))))
    return out


def shingle_set(text, width=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w \
        else frozenset()


def near(rows, percent=85):
    """(doc_id, text) -> {doc_id: (n_shingles, component_id)}, comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, b in enumerate(ids):
        for a in ids[:n]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    lo, hi = sorted((find(a), find(b)))
                    root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeat = {i + j for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for j in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat),
            len(w) < 10 or 100 * len(repeat) > 20 * len(w))


def base_scores(rows):
    """(doc_id, text) -> [(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)]"""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, words((t or "").translate(LOWER)) + [None]) for i, t in rows]
    count = Counter(w for i, ws in tokens if not held(i) for w in ws)
    total, kinds = sum(count.values()), len(count)
    return [(i, held(i), len(ws), sum(count[w] > 0 for w in ws), total,
             sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws))
            for i, ws in tokens]
