"""Hard negatives against a plain search; the oracle covers the registered query."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from soukline.llm import hard_negatives as hn


def brute(rows, anchor, k, m, low, high):
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    ok = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, a in enumerate(ok):
        if a[0] is None or a[0] % anchor:
            continue
        s = [(dot(a[2], r[2]), r[0], r[1] == a[1]) for j, r in enumerate(ok) if j != i]
        for ps, pid, _ in sorted((x for x in s if x[2]), key=order)[:k]:
            inside = sorted((x for x in s if not x[2] and low * ps <= 100 * x[0] <= high * ps),
                            key=order)
            out += [(a[0], pid, n, x[1], ps, x[0]) for n, x in enumerate(inside[:m], 1)]
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "id long, label int, vector array<long>, score string")


@pytest.mark.parametrize("spread", [3, 40])
def test_matches_brute_force(spark, spread):
    """Ties, repeated rows, nulls, short and empty vectors; clustered and scattered rows."""
    rng = random.Random(spread)
    centres = [[rng.randrange(-60, 60) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(300):
        label = rng.choice([0, 0, 0, 1, 2, None if i % 50 == 1 else 3])
        v = [x + rng.randrange(-spread, spread) for x in rng.choice(centres)]
        rows.append((i, label, v))
    rows += [rows[0], rows[10], rows[10], (None, 1, rows[3][2]), (500, 0, None),
             (510, 0, [1, None]), (520, 0, []), (530, 2, [9, 9]), (540, 77, rows[8][2])]
    got = hn.hard_negatives(table(spark, rows), F.col("id") % 10 == 0, positives=3, negatives=4,
                            anchor_rows=8, candidate_rows=50)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    want = brute(rows, 10, 3, 4, 30, 90)
    assert want and sorted(map(tuple, got.collect()), key=str) == want


def test_bounds_hold_and_rule_out(spark):
    """In clustered rows most candidates are never scored again, and no score is wrong."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-300, 300, (5, 16))
    a = centres[rng.integers(0, 5, 60)] + rng.integers(-4, 5, (60, 16))
    c = centres[rng.integers(0, 5, 900)] + rng.integers(-4, 5, (900, 16))
    walk, true = hn.Walk(a, c), a @ c.T
    for at, places, score in walk.visit(lambda x, lo, hi: hi >= 0.9 * np.abs(true[x]).max()):
        assert (true[at, places] == score).all()
        ruled_out = np.setdiff1d(np.arange(len(c)), places)
        assert (true[at, ruled_out] < 0.9 * np.abs(true[at]).max()).all()
    assert walk.scored < 0.5 * walk.pairs == 0.5 * 60 * 900


def test_scores_beyond_doubles_are_exact(spark):
    big = 1 << 30
    rows = [(0, 1, [big + 1, big]), (1, 1, [big + 3, big]), (2, 2, [big // 2 + 1, big // 2]),
            (3, 2, [big // 2 + 2, big // 2 - 1])]
    got = hn.hard_negatives(table(spark, rows), F.col("id") == 0)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows[:1] + rows[1:], 1 << 40, 5,
                                                              10, 30, 90)
    huge = [(0, 1, [1 << 40]), (1, 1, [1 << 40])]
    with pytest.raises(Exception, match="64 bits"):
        hn.hard_negatives(table(spark, huge), F.col("id") == 0).collect()


def test_no_rows(spark):
    none = table(spark, [(1, 1, [1])]).limit(0)
    assert hn.hard_negatives(none, F.col("id") == 0).count() == 0
    one = table(spark, [(0, 1, [1])])
    assert hn.hard_negatives(one, F.col("id") == 0).count() == 0
    assert hn.hard_negatives(one, F.lit(None).cast("boolean")).count() == 0
