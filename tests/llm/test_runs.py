"""Periodic runs against a brute-force search."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import messy
import pytest
from soukline.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, min_length=6, exponent=4):
    found = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i + p - s >= max(min_length, exponent * p):
                found.setdefault((s, i + p), p)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def looped(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is None or not n:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digests(doc_id, text):
    w = looped(doc_id, text)
    found = brute_runs(w)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{p}\n" for s, n, p in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_random_texts_match_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(12):
            letters, n, w = rng.choice([1, 2, 2, 3, 5]), rng.choice([0, 1, 5, 9, 30, 120]), []
            while len(w) < n:
                part = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
                w += (part * rng.randrange(1, 9))[:rng.randrange(1, 60)]
            texts.append([b"%d" % x for x in w * rng.choice([1, 1, 1, 4, 5])])
        assert runs.find_runs(texts) == [brute_runs(t) for t in texts]


def test_other_limits_match_brute_force():
    rng = random.Random(6)
    texts = [[b"%d" % rng.randrange(2) for _ in range(80)] * 6 for _ in range(10)]
    assert runs.find_runs(texts, 20, 5) == [brute_runs(t, 20, 5) for t in texts]
    with pytest.raises(ValueError):
        runs.find_runs(texts, 6, 3)


def test_words_with_equal_polynomial_hashes_stay_apart():
    """Thue-Morse words and their swaps, which collide under hashes modulo 2**64."""
    a = b"a"
    for _ in range(11):
        a += a.translate(bytes.maketrans(b"ab", b"ba"))
    b = a.translate(bytes.maketrans(b"ab", b"ba"))
    assert runs.find_runs([[a, b] * 8]) == [[(0, 16, 2)]]


def test_query_matches_brute_force(spark):
    extra = [(i, " ".join(f"u{k % 211}" for k in range(i)), *[None] * 10) for i in range(400, 460)]
    extra += messy.repeated()
    rows = messy.rows() + extra
    got = [tuple(r) for r in runs.run_digests(messy.documents(spark, extra)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted((digests(r[0], r[1]) for r in rows), key=key)
    assert any(r[1] for r in got) and any(not r[1] for r in got)


def test_operator_on_long_and_empty(spark):
    text = "x " + " ".join(f"w{i}" for i in range(5000)) + " y"
    long = "q " + " ".join([text] * 5) + " r"
    docs = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string")
    one, none = runs.periodic_runs(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in one.runs] == [(1, 25_010, 5002)]
    assert one.collapsed == f"q {text} r" and one.n_words == 25_012
    assert (none.runs, none.collapsed, none.n_words) == ([], "", 0)
    assert runs.run_digests(messy.empty(spark)).count() == 0
