"""Hard-negative mining with anchor spanning-tree bounds (operator 11).

A row's score is its integer inner product with an anchor. Anchors and candidates are dealt
to blocks of bounded size, and every pair of blocks is one row of a join, so that no task
ever holds more than two blocks, however many rows a label has.

The anchors of a block are joined by a minimum spanning tree. Walking it from the root, the
score of a candidate ``c`` at a child anchor lies within ``score(parent, c) ± |edge| * |c|``
(Cauchy-Schwarz), whatever is known of the parent's: an exact score or an interval. Only
candidates whose interval overlaps the window of interest are scored again:

1. *positives*: same label, window from the k-th best lower bound upwards;
2. *negatives*: other label, the windows ``low .. high`` percent of the positives' scores.

Per pair of blocks only the best few per anchor and window leave the task; they are merged
per anchor by score and id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soukline.llm.common import map_arrow, stored

ANCHORS, CANDIDATES = 512, 4096         # rows of a block, on average
EXACT = 1 << 53                         # integers below are exact as doubles
NO_ID = np.iinfo(np.int64).max


def usable(rows: DataFrame) -> DataFrame:
    """Rows with a label and a vector without null, NaN or infinite components."""
    vector = F.col("vector")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return rows.filter(F.col("label").isNotNull() & vector.isNotNull() & ~bad)


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of one integer matrix, shorter ones filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _width(vectors: pa.ListArray) -> int:
    return int(vectors.value_lengths().to_numpy(zero_copy_only=False).max(initial=0))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1 for the root, row 0) and edge length of every row: a minimum spanning
    tree by Prim's rule, distances rounded up a little so that bounds stay bounds."""
    n = len(x)
    x = x.astype(np.float64)
    parent, edge = np.full(n, -1), np.zeros(n)
    best = np.full(n, np.inf)
    outside = np.ones(n, dtype=bool)
    at = 0
    for _ in range(n - 1):
        outside[at] = False
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = outside & (d < best)
        best[closer], parent[closer] = d[closer], at
        at = int(np.where(outside, best, np.inf).argmin())
        edge[at] = best[at]
    return parent, edge * (1 + 1e-9)


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    todo = np.flatnonzero(parent < 0)
    out = []
    children: dict[int, list[int]] = {}
    for child, p in enumerate(parent.tolist()):
        children.setdefault(p, []).append(child)
    while len(todo):
        out.append(todo)
        todo = np.array([c for p in todo.tolist() for c in children.get(p, [])], dtype=int)
    return out


def _products(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` with all rows of ``c``."""
    big = float(np.abs(a.astype(np.float64)).max(initial=0)) \
        * float(np.abs(c.astype(np.float64)).max(initial=0)) * max(a.shape[1], 1)
    if big < EXACT:
        return a.astype(np.float64) @ c.astype(np.float64).T
    exact = a.astype(object) @ c.astype(object).T
    if exact.size and max(abs(exact.min()), abs(exact.max())) > NO_ID:
        raise OverflowError("a score does not fit into 64 bits")
    return exact


class Walk:
    """Scores of the candidates of a block along the tree of a block of anchors.

    ``scored`` counts candidates scored exactly, ``pairs`` all those looked at."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        self.a, self.c = anchors, candidates
        self.parent, self.edge = spanning_tree(anchors)
        self.norm = np.sqrt((candidates.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        self.exact = float(np.abs(anchors.astype(np.float64)).max(initial=0)) \
            * float(np.abs(candidates.astype(np.float64)).max(initial=0)) \
            * max(anchors.shape[1], 1) < EXACT
        self.scored = self.pairs = 0

    def visit(self, window):
        """Yields (anchor, places of candidates, their exact scores), the root first.

        ``window(anchor, lower bounds, upper bounds)`` marks the candidates to score."""
        lower: dict[int, np.ndarray] = {}
        upper: dict[int, np.ndarray] = {}
        for level in _levels(self.parent):
            marks = []
            for a in level.tolist():
                p = int(self.parent[a])
                if p < 0:
                    lo, hi = np.full(len(self.c), -np.inf), np.full(len(self.c), np.inf)
                else:
                    reach = self.edge[a] * self.norm + 1
                    lo, hi = lower[p] - reach, upper[p] + reach
                lower[a], upper[a] = lo, hi
                # the root is scored whole: all bounds start from it
                marks.append(np.ones(len(self.c), dtype=bool) if p < 0 or not self.exact
                             else window(a, lo, hi))
            share = np.mean([m.mean() for m in marks]) if len(self.c) else 0
            # where nearly nothing is ruled out one product of matrices is the shortest way
            whole = _products(self.a[level], self.c) if share > 0.1 else None
            for k, a in enumerate(level.tolist()):
                at = np.flatnonzero(marks[k])
                s = whole[k][at] if whole is not None \
                    else _products(self.a[a:a + 1], self.c[at])[0]
                lower[a][at] = upper[a][at] = s
                self.scored += len(at)
                self.pairs += len(self.c)
                yield a, at, s
            for p in {int(p) for p in self.parent[level]} - {-1}:
                del lower[p], upper[p]          # all children are done


def _ids(x: pa.Array) -> np.ndarray:
    return x.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _best(score: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int):
    """The ``k`` first places and scores by falling score, then smaller id."""
    if len(at) > 4 * k:
        least = np.partition(score.astype(np.float64), len(at) - k)[len(at) - k]
        at, score = at[score >= least], score[score >= least]
    order = np.lexsort((ids[at], -score.astype(np.int64)))[:k]
    return at[order], score[order]


class _Pair:
    """One row of the join of blocks: anchors and candidates as arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        a, c = (batch.column(n).slice(i, 1).flatten() for n in ("anchors", "candidates"))
        self.a, self.c = a, c
        width = max(_width(a.field("vector")), _width(c.field("vector")))
        self.walk = Walk(_matrix(a.field("vector"), width), _matrix(c.field("vector"), width))
        self.a_uid, self.c_uid = (x.field("uid").to_numpy(zero_copy_only=False) for x in (a, c))
        self.a_label, self.c_label = (
            x.field("label").to_numpy(zero_copy_only=False) for x in (a, c))
        self.c_id = _ids(c.field("id"))


class _Found:
    """What leaves the task: anchor, its window, place and score of a candidate."""

    def __init__(self):
        self.uid, self.k, self.at, self.score = [], [], [], []

    def add(self, uid: int, k: int, at: np.ndarray, score: np.ndarray) -> None:
        self.uid += [int(uid)] * len(at)
        self.k += [k] * len(at)
        self.at += at.tolist()
        self.score += [int(x) for x in score]

    def rows(self, candidates: pa.StructArray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.uid, pa.int64()), pa.array(self.k, pa.int32()),
             candidates.field("id").take(pa.array(self.at, pa.int64())),
             pa.array(self.score, pa.int64())], names=["uid", "k", "id", "score"])


def _positives(k: int):
    def run(batches):
        for b in batches:
            for i in range(len(b)):
                pair = _Pair(b, i)

                def window(a, lo, hi, pair=pair):
                    same = (pair.c_label == pair.a_label[a]) & (pair.c_uid != pair.a_uid[a])
                    n = int(same.sum())
                    if n <= k:
                        return same
                    least = np.partition(lo[same], n - k)[n - k]
                    return same & (hi >= least)
                out = _Found()
                for a, at, s in pair.walk.visit(window):
                    same = (pair.c_label[at] == pair.a_label[a]) & (pair.c_uid[at] != pair.a_uid[a])
                    at, s = _best(s[same], pair.c_id, at[same], k)
                    out.add(pair.a_uid[a], 0, at, s)
                yield out.rows(pair.c)
    return run


def _negatives(k: int, low: int, high: int):
    def run(batches):
        for b in batches:
            for i in range(len(b)):
                pair = _Pair(b, i)
                ranks = pair.a.field("ranks").to_pylist()
                # low * positive <= 100 * negative <= high * positive, in whole numbers
                spans = [[(r["k"], -(-low * r["score"] // 100), high * r["score"] // 100)
                          for r in x or []] for x in ranks]
                spans = [[x for x in s if x[1] <= x[2]] for s in spans]

                def window(a, lo, hi, pair=pair, spans=spans):
                    if not spans[a]:
                        return np.zeros(len(lo), dtype=bool)
                    least, most = min(x[1] for x in spans[a]), max(x[2] for x in spans[a])
                    return (pair.c_label != pair.a_label[a]) & (hi >= least) & (lo <= most)
                out = _Found()
                for a, at, s in pair.walk.visit(window):
                    other = pair.c_label[at] != pair.a_label[a]
                    at, s = at[other], s[other]
                    for rank, least, most in spans[a]:
                        inside = (s >= least) & (s <= most)
                        out.add(pair.a_uid[a], rank,
                                *_best(s[inside], pair.c_id, at[inside], k))
                yield out.rows(pair.c)
    return run


def _blocks(rows: DataFrame, block: Column, name: str, columns: list[str]) -> DataFrame:
    """One row per block: its rows as an array (bounded: blocks have a bounded mean size)."""
    return rows.groupBy(block.alias(f"{name}_block")).agg(
        F.collect_list(F.struct(*columns)).alias(name))


def _pairs(anchors: DataFrame, candidates: DataFrame, n_anchors: int,
           n_candidates: int) -> DataFrame:
    """Every block of anchors with every block of candidates, one row each."""
    a = anchors.withColumn("candidates_block", F.explode(
        F.sequence(F.lit(0), F.lit(n_candidates - 1))))
    c = candidates.withColumn("anchors_block", F.explode(
        F.sequence(F.lit(0), F.lit(n_anchors - 1))))
    n = max(1, min(n_anchors * n_candidates, 1 << 16))
    on = ["anchors_block", "candidates_block"]
    return (a.repartition(n, *on).hint("merge").join(c.repartition(n, *on), on)
            .select("anchors", "candidates"))


def _first(rows: DataFrame, per: list[str], k: int) -> DataFrame:
    """The ``k`` first rows by falling score, then smaller id (null last), ranked from 1."""
    order = Window.partitionBy(*per).orderBy(F.col("score").desc(),
                                             F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


RESULT = "uid long, k int, id long, score long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90,
                   anchor_rows: int = ANCHORS, candidate_rows: int = CANDIDATES) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.

    ``vectors`` has ``id`` (long), ``label`` and ``vector`` (array of whole numbers);
    ``is_anchor`` marks the anchors. Positives are the first ``positives`` other rows of the
    anchor's label; negatives the first ``negatives`` rows of another label whose score is
    ``low`` to ``high`` percent of the positive's. First means greater inner product with the
    anchor, then smaller id.

    Every anchor meets every row once for its positives and once for its negatives, in
    blocks: work and the rows moved grow with anchors x rows / ``anchor_rows``.

    Defined cases: rows without label or vector, or with a null or non-finite component,
    take no part; shorter vectors are filled up with zeros, an empty one scores 0; a null
    id ranks after all others and is given out as null; rows that repeat an id are rows of
    their own (each anchor among them gets its results, a copy can be its positive); among
    rows that tie in score and id any order gives the same result; an anchor without
    positives, or a positive whose window holds no row (as below a score of 0), gives no
    rows; a score beyond 64 bits raises an error; empty tables give no rows; other columns
    are ignored. Long vectors only make blocks larger: pass smaller ``anchor_rows`` and
    ``candidate_rows`` for vectors of many thousand components.
    """
    rows = stored(usable(vectors.select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")))
        .withColumn("uid", F.monotonically_increasing_id()), "negatives-rows")
    n, n_anchor = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    n_c, n_a = (max(1, -(-m // size)) for m, size in ((n, candidate_rows),
                                                      (n_anchor, anchor_rows)))
    block = lambda k: F.pmod(F.xxhash64("uid"), F.lit(k)).cast("int")
    columns = ["uid", "id", "label", "vector"]
    candidates = stored(_blocks(rows, block(n_c), "candidates", columns), "negatives-blocks")
    anchors = rows.filter("is_anchor")
    pairs = _pairs(_blocks(anchors, block(n_a), "anchors", columns), candidates, n_a, n_c)
    found = stored(_first(map_arrow(pairs, _positives(positives), RESULT, 4), ["uid"],
                          positives), "negatives-positives")
    windows = found.groupBy("uid").agg(F.collect_list(F.struct(
        F.col("rank").alias("k"), "score")).alias("ranks"))
    pairs = _pairs(_blocks(anchors.join(windows, "uid"), block(n_a), "anchors",
                           [*columns, "ranks"]), candidates, n_a, n_c)
    mined = _first(map_arrow(pairs, _negatives(negatives, low, high), RESULT, 4), ["uid", "k"],
                   negatives)
    named = (found.select("uid", F.col("rank").alias("k"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
             .join(anchors.select("uid", F.col("id").alias("anchor_id")), "uid"))
    return (mined.select("uid", "k", "rank", F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
            .join(named, ["uid", "k"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))


def embedding_rows(embeddings: DataFrame) -> DataFrame:
    """``embeddings`` as the registered query reads them: labels of ids divisible by 7 moved
    on by one (modulo 10), components as ``floor(256 * x)``."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    x = F.col("embedding")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return embeddings.select(
        F.col("vec_id").alias("id"), moved.alias("label"),
        F.when(finite, F.transform(x, lambda v: F.floor(256 * v.cast("double"))))
        .alias("vector"))


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same,
         CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k
    FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                            ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score FROM n WHERE rank <= 10
"""
