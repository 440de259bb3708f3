"""Periodic runs of words by online dyadic square catching (operator 12).

A *run* is a stretch of words with smallest period ``q`` that no neighbouring word extends
(keeping the period), of at least ``MIN_LENGTH`` words and ``EXPONENT`` periods.

Words are appended to a text one after the other. On level ``l`` the completed blocks of
``2**l`` words each hold a *catcher* for periods ``2**l .. 2**(l+1)-1``: the catcher of block
``b`` waits for the ``2**l`` words that follow one period later, which is while the words of
the next block begin. Each appended word completes one suffix of ``2**l`` words on every
level, and this suffix is compared with the block of the catcher in charge - one comparison
per word and level. A run of four periods covers at least two neighbouring blocks of its
level, so a *square* is reported where two neighbouring catchers answer with one period.
Squares that follow each other with the same period merge; the words before and after are
compared one by one (fewer than a block on either side), which gives the run.

Suffixes are compared by 64-bit names built by doubling, for all words of a batch of texts
at once; every reported stretch is then compared word by word, and words are numbered
without hashing, so no name decides a result. A square inside a known run is no news if
its period is a multiple of the run's: such squares are dropped before they are merged.

Work is ``n log n`` for ``n`` words. Texts are rows of their own and nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import WORD, map_arrow, text_or_empty

MIN_LENGTH, EXPONENT = 6, 4
BATCH_WORDS = 1 << 18               # words whose suffixes are named together

K = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA3B195354A39B70D)
    return x ^ (x >> np.uint64(32))


class Catchers:
    """Runs of a batch of texts, their words given as numbers (equal words, equal numbers)."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, min_length: int, exponent: int):
        self.words, self.bounds = words, bounds
        self.min_length, self.exponent = min_length, exponent
        # end of the longest-reaching known run around every word
        self.reach = np.zeros(len(words), dtype=np.int64)
        self.runs: dict[tuple[int, int], int] = {}      # (start, end) -> smallest period

    def find(self) -> dict[tuple[int, int], int]:
        name = _mix(self.words.astype(np.uint64) * K)
        sizes = np.diff(self.bounds)
        at = np.arange(len(self.words), dtype=np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        start, end = self.bounds[:-1][doc], self.bounds[1:][doc]
        size = 1
        # suffixes of `size` words begin at `at`; texts too short for the level drop out
        while True:
            long = end - start >= self.exponent * size
            if not long.all():
                at, name, start, end = at[long], name[long], start[long], end[long]
            if not len(at):
                return self.runs
            self._level(size, at, name, start, end)
            # the next level's suffixes: two neighbouring ones of this level
            fits = at + 2 * size <= end
            place = np.flatnonzero(fits)
            # positions of a text are contiguous in `at`
            name = _mix(name[place] * K + name[place + size])
            at, start, end = at[place], start[place], end[place]
            size *= 2

    def _level(self, size: int, at, name, start, end) -> None:
        r = at - start
        back = (r & (size - 1)) + size                  # distance to the catcher's block
        ask = np.flatnonzero(r >= size)
        hit = np.zeros(len(at) + size, dtype=bool)
        hit[ask] = name[ask] == name[ask - back[ask]]
        # two neighbouring catchers with one period (same text: the second still fits)
        square = hit[:-size] & hit[size:]
        square[at + 2 * size > end] = False
        found = np.flatnonzero(square)
        if not len(found):
            return
        j, p = at[found], back[found]
        b = j - p
        news = self.reach[b] < j + size
        b, p, lo, hi = b[news], p[news], start[found][news], end[found][news]
        if not len(b):
            return
        # squares of one period that follow each other block by block merge
        order = np.lexsort((b, p, lo))
        b, p, lo, hi = b[order], p[order], lo[order], hi[order]
        head = np.ones(len(b), dtype=bool)
        head[1:] = (p[1:] != p[:-1]) | (lo[1:] != lo[:-1]) | (b[1:] != b[:-1] + size)
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(b)) - 1
        chains = sorted(zip(p[heads].tolist(), b[heads].tolist(),
                            (b[tails] + 2 * size).tolist(), lo[heads].tolist(),
                            hi[heads].tolist()))
        for period, first, last, doc_start, doc_end in chains:
            if self.reach[first] < first + period + size:
                self._merge(period, first, last, doc_start, doc_end)

    def _merge(self, p: int, first: int, last: int, lo: int, hi: int) -> None:
        """Words first .. last-1 are said to equal those one period later: extend, check."""
        w = self.words
        if not np.array_equal(w[first:last], w[first + p:last + p]):
            return                                      # equal names of unequal words
        step = max(64, p)
        while last + p < hi:
            n = min(step, hi - last - p)
            differ = w[last:last + n] != w[last + p:last + p + n]
            if differ.any():
                last += int(differ.argmax())
                break
            last += n
        while first > lo:
            n = min(step, first - lo)
            differ = (w[first - n:first] != w[first - n + p:first + p])[::-1]
            if differ.any():
                first -= int(differ.argmax())
                break
            first -= n
        end = last + p
        if end - first < max(self.min_length, self.exponent * p):
            return
        known = self.runs.get((first, end))
        if known is None or p < known:
            self.runs[(first, end)] = p
        self.reach[first:end] = np.maximum(self.reach[first:end], end)


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as numbers, and where each text begins."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    words = np.fromiter((number[x] for t in texts for x in t), np.int64, int(bounds[-1]))
    return words, bounds


def find_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH,
              exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, by start, then period.

    ``exponent`` must be at least 4: two neighbouring blocks lie in every such run."""
    if exponent < 4:
        raise ValueError("exponent must be at least 4")
    words, bounds = numbered(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = Catchers(words, bounds, min_length, exponent).find()
    starts = np.array([s for s, _ in found], dtype=np.int64)
    docs = np.searchsorted(bounds, starts, side="right") - 1
    for d, ((s, e), p) in zip(docs.tolist(), found.items()):
        out[d].append((s - int(bounds[d]), e - s, p))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by one blank, without a run's words after its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        for s, n, p in runs:
            gone[s + p] += 1
            gone[s + n] -= 1
        kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
        words = [words[k] for k in kept]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _finder(min_length: int, exponent: int):
    def parts(texts: list[str]):
        """Stretches of rows with about BATCH_WORDS words each."""
        group: list[list[bytes]] = []
        size = 0
        for t in texts:
            words = t.encode("utf-8", "surrogatepass").split()      # ASCII white space
            group.append(words)
            size += len(words)
            if size >= BATCH_WORDS:
                yield group
                group, size = [], 0
        if group:
            yield group

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                   ("period", pa.int64())]))
        for b in batches:
            lo = 0
            for group in parts(b.column("text").to_pylist()):
                found = find_runs(group, min_length, exponent)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, len(group)),
                     pa.array([len(w) for w in group], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs]
                               for runs in found], kind),
                     pa.array(map(_collapsed, group, found), pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
                lo += len(group)
    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH,
                  exponent: int = EXPONENT) -> DataFrame:
    """Runs of every document: ``doc_id, n_words, runs, collapsed``.

    ``runs`` is an array of (start, length, period) in words, ordered by start, then
    period; ``collapsed`` is the text with each run cut down to its first period (words
    ``[^\\x20\\x09-\\x0D]+``, joined by one blank).

    Needs ``doc_id`` and ``text``; other columns are ignored. Defined cases: a null or
    empty text has no words and no runs; a null doc_id is passed on; rows that repeat each
    get their row; runs that overlap are all listed, and a word is cut if any of them cuts
    it; very long texts are searched whole (``n log n`` time, some 60 bytes a word); an
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty().alias("text"))
    return map_arrow(rows, _finder(min_length, exponent),
                     "doc_id long, n_words long, "
                     "runs array<struct<start: long, length: long, period: long>>, "
                     "collapsed string", 500)


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: documents with crc32(doc_id) % 10 = 0 run in a loop from a word on.

    With g = crc32 // 10 and n words, the words from a = g % n on repeat the next
    1 + (n - a) // (3 + g % 8) of them to the end. Null ids and texts without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", text_or_empty().alias("text"), h.alias("h"),
                       F.expr("h div 10").alias("g"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = (rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
           .withColumn("n", F.size("words"))
           .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int"))))
    n, a, g = F.col("n"), F.col("a"), F.col("g")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    loop = F.concat(F.slice("words", F.lit(1), a),
                    F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)))
    return cut.select("doc_id", F.when(a.isNotNull(), F.array_join(F.slice(loop, F.lit(1), n), " "))
                      .otherwise(F.col("text")).alias("text"))


def _better(x: Column, y: Column) -> Column:
    """Whether run ``y`` beats run ``x``: greater length / period, then start, then period."""
    left, right = y["length"] * x["period"], x["length"] * y["period"]
    return (left > right) | ((left == right) & (
        (y["start"] < x["start"])
        | ((y["start"] == x["start"]) & (y["period"] < x["period"]))))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document of :func:`looped`: number of runs, the strongest run and digests.

    ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256``; without a run four nulls and the digest of the empty string."""
    found = periodic_runs(looped(docs))
    runs = F.col("runs")
    best = F.aggregate(runs, F.try_element_at(runs, F.lit(1)),
                       lambda x, y: F.when(_better(x, y), y).otherwise(x))
    listed = F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
