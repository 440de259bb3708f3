"""Quality rules with line sequence labelling (operator 5).

A linear-chain conditional random field marks every line of a document as content or
boilerplate (Viterbi decoding); a document stays if it passes the counting rules and at
least ``CONTENT_SHARE`` of its words stand in content lines.

The field is trained here by maximum likelihood (forward-backward gradients) on a bounded
sample: at most ``TRAIN_DOCS`` labelled documents, those with the smallest hash of their
id, every line carrying its document's quality label; long ones are learnt from in
stretches over their whole length (see :func:`fit`). Only their line features reach the
driver. Scoring reads every line of every document, however long.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import WORD, map_arrow, text_or_empty

WORDS = re.compile(WORD)
SYMBOLS = re.compile(r"[#*$%&|<>]")
END = (".", "!", "?", ":", ";", '"', "'", ")", "”", "»")
TRAIN_DOCS = 2_000
STRETCH_LINES, STRETCHES = 60, 64   # of one training document; scoring has no bound
CONTENT_SHARE = 0.5
N_FEATURES = 8


def line_features(words: list[str], line: str, seen: bool) -> list[float]:
    n, chars = len(words), sum(map(len, words))
    kinds = len(set(words))
    bare = sum(len(w) < 4 and not any(map(str.isalnum, w)) for w in words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [1.0,
            min(1.0, 8.0 * len(SYMBOLS.findall(line)) / chars),
            min(1.0, 4.0 * bare / n),
            min(1.0, 3.0 * same / n),
            max(0.0, 1.0 - 2.0 * kinds / n),
            float(words[-1].endswith(END)),
            min(np.log1p(n), 6.0) / 6.0,
            float(seen)]


def describe(text: str) -> tuple[list[int], list[list[float]], list[int]]:
    """Base counts ``[n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words]``, and
    the features and word counts of the lines that hold a word."""
    words, seen, features, sizes = [], set(), [], []
    dup = 0
    for line in text.split("\n"):
        found = WORDS.findall(line)
        if not found:
            continue
        again = line in seen
        dup += again
        seen.add(line)
        features.append(line_features(found, line, again))
        sizes.append(len(found))
        words += found
    counts = [len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), dup,
              repeated_words(words)]
    return counts, features, sizes


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur at least twice in the text."""
    grams = list(zip(*(words[i:] for i in range(width))))
    count = Counter(grams)
    if len(count) == len(grams):
        return 0
    covered = end = 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered += i + width - max(i, end)
            end = i + width
    return covered


def viterbi(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label path: ``emit`` is lines x 2, ``move`` 2 x 2."""
    n = len(emit)
    back = np.zeros((n, 2), dtype=np.int64)
    best = emit[0]
    for i in range(1, n):
        to = best[:, None] + move
        back[i] = to.argmax(0)
        best = to.max(0) + emit[i]
    path = np.empty(n, dtype=np.int64)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def train(sequences: list[np.ndarray], labels: list[int], steps: int = 100,
          rate: float = 0.3, ridge: float = 1e-3,
          ridge_moves: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x 2) and transitions (2 x 2) of the field, by Adam on the mean
    log-likelihood per line. All sequences run side by side, padded to the longest."""
    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, N_FEATURES))
    on = np.zeros((len(sequences), longest), dtype=bool)
    for i, s in enumerate(sequences):
        x[i, :len(s)], on[i, :len(s)] = s, True
    y = np.asarray(labels)
    share = np.bincount(y, minlength=2) / len(y)
    weight = (0.5 / share)[y]                       # both classes count alike
    gold = np.zeros((len(y), longest, 2))
    gold[np.arange(len(y)), :, y] = 1
    gold *= on[..., None]
    total = (weight[:, None] * on).sum()
    theta = np.zeros(N_FEATURES * 2 + 4)
    m = v = np.zeros_like(theta)
    shrink = np.full(len(theta), ridge)
    shrink[-4:] = ridge_moves       # documents are labelled whole; lines must decide
    for step in range(1, steps + 1):
        w, move = theta[:-4].reshape(N_FEATURES, 2), theta[-4:].reshape(2, 2)
        emit = x @ w
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0]
        for t in range(1, longest):
            into = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + emit[:, t]
            alpha[:, t] = np.where(on[:, t, None], into, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            out = np.logaddexp.reduce(
                move + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(on[:, t + 1, None], out, 0.0)
        log_z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        node = np.exp(alpha + beta - log_z[:, None, None]) * on[..., None]
        g_w = np.einsum("slf,slk->fk", x * weight[:, None, None], gold - node)
        g_move = np.zeros((2, 2))
        if longest > 1:
            edge = np.exp(alpha[:, :-1, :, None] + move
                          + (emit + beta)[:, 1:, None, :] - log_z[:, None, None, None])
            pair = on[:, 1:, None, None] * weight[:, None, None, None]
            g_move = ((gold[:, :-1, :, None] * gold[:, 1:, None, :] - edge) * pair).sum((0, 1))
        grad = np.concatenate([g_w.ravel(), g_move.ravel()]) / total - shrink * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (
            np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:-4].reshape(N_FEATURES, 2), theta[-4:].reshape(2, 2)


def share_of_content(model, features: list, sizes: list[int]) -> float:
    """Share of the words that stand in content lines; 1 without a model or a line."""
    if model is None or not features:
        return 1.0
    path = viterbi(np.asarray(features) @ model[0], model[1])
    return float(np.dot(path, sizes)) / sum(sizes)


def base_failed(n_words, n_repeat_words):
    """The counting rules, for numbers or columns."""
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def stretches(lines: list, stretch_lines: int, max_stretches: int) -> list:
    """A document's lines as consecutive stretches; of more than ``max_stretches`` those
    at evenly spread places, from the first to the last line."""
    n = -(-len(lines) // stretch_lines)
    places = range(n) if n <= max_stretches else \
        sorted({round(i * (n - 1) / (max_stretches - 1)) for i in range(max_stretches)})
    return [lines[k * stretch_lines:(k + 1) * stretch_lines] for k in places]


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS,
        stretch_lines: int = STRETCH_LINES, max_stretches: int = STRETCHES):
    """Train on at most ``max_docs`` labelled documents; None without both classes.

    A document is learnt from in stretches of ``stretch_lines`` lines over its whole
    length, at most ``max_stretches`` of them (3,840 lines as set), which bounds the
    sample. Of several labels of a doc_id the smallest counts, of several texts the one
    with the smallest hash; null ids and labels are left out.
    """
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("quality").cast("long").alias("quality"))
              .dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        text_or_empty().alias("text"))
            .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")))

    def run(batches):
        for b in batches:
            ids, kinds, out = [], [], []
            for i, q, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "quality", "text"))):
                for part in stretches(describe(text)[1], stretch_lines, max_stretches):
                    ids.append(i)
                    kinds.append(q)
                    out.append(np.asarray(part, dtype=np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(kinds, pa.int64()),
                 pa.array(out, pa.binary())], names=["doc_id", "quality", "features"])

    found = map_arrow(rows, run, "doc_id long, quality long, features binary").toArrow()
    data = sorted(zip(*(found.column(c).to_pylist() for c in found.column_names)))
    data = [(q, np.frombuffer(f, dtype=np.float32).reshape(-1, N_FEATURES).astype(float))
            for _, q, f in data if f]
    if len({q for q, _ in data}) < 2:
        return None
    return train([f for _, f in data], [int(q) for q, _ in data])


def judge(docs: DataFrame, model, content_share: float = CONTENT_SHARE) -> DataFrame:
    """Counts and verdict of every row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, content_share, kept``.

    Defined cases: a null or empty text has no words and fails the base rules; without a
    trained model (no labels of both classes) every line is content, so the base rules
    decide; repeated rows are judged each; other columns are ignored.
    """
    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
              " n_repeat_words long, content_share double")

    def run(batches):
        for b in batches:
            counts, shares = [], []
            for text in b.column("text").to_pylist():
                base, features, sizes = describe(text)
                counts.append(base)
                shares.append(share_of_content(model, features, sizes))
            cols = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *cols, pa.array(shares, pa.float64())],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "content_share"])

    rows = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 text_or_empty().alias("text")), run, schema)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (rows.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("content_share") >= content_share)))


def keep_quality(docs: DataFrame, model, content_share: float = CONTENT_SHARE) -> DataFrame:
    """The documents that pass, with all their columns."""
    def run(batches):
        for b in batches:
            keep = []
            for text in b.column("text").to_pylist():
                base, features, sizes = describe(text or "")
                keep.append(not base_failed(base[0], base[4])
                            and share_of_content(model, features, sizes) >= content_share)
            yield b.filter(pa.array(keep, pa.bool_()))
    return map_arrow(docs, run, docs.schema)
