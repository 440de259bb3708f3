"""Quality classifier: a generalised additive model with pairwise interactions (op 7).

Every feature has a lookup table over its bins, every chosen feature pair a table over
its bin pairs. The tables are learnt by cyclic boosting: round after round, each feature
in turn gets a shallow tree on the current residuals, added to its table with a small
rate; then the pairs that explain most of what is left are boosted the same way. A score
is the sigmoid of a sum of table entries, so scoring a batch is a few array look-ups.

The model is fitted on the driver on a bounded sample: at most ``TRAIN_ROWS`` labelled
rows, those with the smallest hash of their id. Features of all rows are computed and all
rows are scored on the executors.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import WORD, map_arrow, stored, text_or_empty

WORDS = re.compile(WORD)
MARKS = re.compile(r"[#*$%&|<>{}\[\]\\^~_=+@]")
STOPS = re.compile(r"[.,;:!?]")
FEATURES = ["log_words", "mark_share", "stop_share", "kinds_share", "top_share",
            "twice_share", "mean_chars", "bare_share", "upper_share", "digit_share",
            "dup_lines", "line_words"]
TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
THRESHOLD = 0.7


def features(text: str) -> list[float]:
    """Numbers that describe a text; an empty text has zeros."""
    words = WORDS.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    count = Counter(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    bare = sum(c for w, c in count.items() if len(w) < 4 and not any(map(str.isalnum, w)))
    return [float(np.log1p(n)),
            len(MARKS.findall(text)) / chars,
            len(STOPS.findall(text)) / n,
            len(count) / n,
            max(count.values()) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            chars / n,
            bare / n,
            sum(c for w, c in count.items() if w[0].isupper()) / n,
            sum(c for w, c in count.items() if w[0].isdigit()) / n,
            1.0 - len(set(lines)) / len(lines) if lines else 0.0,
            float(np.log1p(n / max(1, len(lines))))]


@dataclass
class Model:
    """Bin edges and tables; ``pairs`` holds (feature, feature, table)."""
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        small = []
        for j, (edges, table, coarse) in enumerate(zip(self.edges, self.tables, self.coarse)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
            small.append(np.searchsorted(coarse, x[:, j], side="right"))
        for a, b, table in self.pairs:
            total += table[small[a], small[b]]
        return 1.0 / (1.0 + np.exp(-total))


def _cuts(col: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, ridge: float, leaves: int = 3) -> np.ndarray:
    """Values per bin of a tree with at most ``leaves`` leaves on one feature's bins."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p in parts:
            if p[1] - p[0] > 1:
                k = np.arange(p[0] + 1, p[1])
                gain = worth(p[0], k) + worth(k, p[1]) - worth(*p)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], p, int(k[i]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.empty(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _square_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and table of the best cross of one cut on each axis of a pair's bins."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    none = (g.sum() ** 2) / (h.sum() + ridge)
    best, cut = 0.0, None
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            def corner(c):
                a, b, d = c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j]
                return np.array([a, b, d, c[-1, -1] - a - b - d])
            gain = (corner(cg) ** 2 / (corner(ch) + ridge)).sum() - none
            if gain > best:
                best, cut = gain, (i, j, corner(cg) / (corner(ch) + ridge))
    out = np.zeros(g.shape)
    if cut:
        i, j, v = cut
        out[:i + 1, :j + 1], out[:i + 1, j + 1:] = v[0], v[1]
        out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v[2], v[3]
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.15,
        n_pairs: int = 5, pair_rounds: int = 15, ridge: float = 5.0) -> Model:
    edges = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    small = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(y), base)
    for _ in range(rounds):
        for j, b in enumerate(bins):
            p = 1.0 / (1.0 + np.exp(-total))
            size = len(tables[j])
            step = rate * _tree(np.bincount(b, y - p, size),
                                np.bincount(b, p * (1 - p), size), ridge)
            tables[j] += step
            total += step[b]
    p = 1.0 / (1.0 + np.exp(-total))

    def grids(a, b, p):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell = small[a] * shape[1] + small[b]
        size = shape[0] * shape[1]
        return (cell, np.bincount(cell, y - p, size).reshape(shape),
                np.bincount(cell, p * (1 - p), size).reshape(shape))

    ranked = sorted(((-_square_tree(*grids(a, b, p)[1:], ridge)[0], a, b)
                     for a in range(x.shape[1]) for b in range(a)))[:n_pairs]
    pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in ranked]
    for _ in range(pair_rounds):
        for a, b, grid in pairs:
            cell, g, h = grids(a, b, 1.0 / (1.0 + np.exp(-total)))
            step = rate * _square_tree(g, h, ridge)[1]
            grid += step
            total += step.ravel()[cell]
    return Model(base, edges, tables, coarse, pairs)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the feature columns of every row."""
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)

    def run(batches):
        for b in batches:
            rows = [features(t) for t in b.column("text").to_pylist()]
            x = np.asarray(rows, dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x[:, j]) for j in range(x.shape[1]))],
                names=["doc_id", *FEATURES])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 text_or_empty().alias("text")), run, schema)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS,
             parts: int = 4, part: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """Quality score of every row: ``doc_id, held_out, score, predicted``.

    Learns ``labels.quality`` from rows outside the held-out fold ``crc32(doc_id) % parts
    == part``; language, source and id are no features.

    Defined cases: null and empty texts have zero features and get a score; a null
    doc_id is not held out and never a training row; of several labels of a document the
    smallest counts, and of several texts of a labelled id the one with the smallest
    features is learnt from; very long texts are read whole; without labels, or from an
    empty table, every score is 0.5; extra columns are ignored.
    """
    rows = stored(described(docs), "gam-features")
    known = (labels.select("doc_id", "quality").dropna()
             .filter(~held_out(F.col("doc_id"), parts, part))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # of several texts of one id the one with the smallest features is learnt from
    sample = (rows.join(F.broadcast(known), "doc_id").groupBy("doc_id", "quality")
              .agg(F.min(F.struct(*FEATURES)).alias("f")).select("doc_id", "quality", "f.*")
              .orderBy("doc_id").toArrow())
    y = sample.column("quality").to_numpy().astype(float)
    x = np.column_stack([sample.column(f).to_numpy() for f in FEATURES]) if len(y) else None
    model = fit(x, y) if len(y) else None

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)],
                                             names=["doc_id", "score"])

    scored = map_arrow(rows, run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
