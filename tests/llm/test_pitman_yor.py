"""The language model's ways to its tasks: batches, lookups and orders."""

import re

import numpy as np
from pyspark.sql import functions as F

from soukline.llm import pitman_yor, recompress


def test_chunks_come_in_few_batches(spark, monkeypatch):
    """The buckets' batches of two rows must not stay on for the texts of the chunks."""
    def few(make):
        def made(*args):
            run = make(*args)

            def check(texts):
                if texts.column("text").num_chunks > 2:
                    raise ValueError(f"{len(texts)} texts in {texts.column('text').num_chunks} batches")

            def one(texts):
                check(texts)
                return run(texts)

            def two(texts, answers):
                check(texts)
                return run(texts, answers)
            return one if make.__name__ == "_asked" else two
        return made

    monkeypatch.setattr(pitman_yor, "_asked", few(pitman_yor._asked))
    monkeypatch.setattr(pitman_yor, "_scored", few(pitman_yor._scored))
    docs = spark.range(900).select(F.col("id").alias("doc_id"),
                                   F.concat_ws(" ", F.lit("a b"), F.col("id") % 7).alias("text"))
    assert pitman_yor.score_texts(docs).count() == 900


def test_looked_up_names():
    rng = np.random.default_rng(3)
    top = 2 ** 64 - 1
    for keys in ([], [0], [0, 1, 2, 3, top], [top], rng.integers(0, top, 999, dtype=np.uint64),
                 np.arange(5000)):
        keys = np.unique(np.array(keys, dtype=np.uint64))
        x = np.concatenate([keys, keys + np.uint64(1), np.array([0, 1, top], np.uint64),
                            rng.integers(0, top, 500, dtype=np.uint64)])
        place = {int(k): i for i, k in enumerate(keys)}
        assert pitman_yor._looked_up(keys, x).tolist() == [
            place.get(int(v), len(keys)) for v in x]


def test_place_order_is_stable_beyond_16_bits():
    rng = np.random.default_rng(4)
    for places in (5, 1 << 16, 300_000):
        place = rng.integers(0, places, 20_000).astype(np.int32)
        assert (pitman_yor._place_order(place, places)
                == np.argsort(place, kind="stable")).all()


def test_words_are_cut_as_the_contracts_say():
    texts = ["", " ", "a", " a", "a ", "a  b\tc\x0bd\x0ce\rf\ng", "\n", "x" * 700 + " y", "é\x1cz  "]
    for some in (texts, texts[::-1], [], [""], ["a"], ["", "b"]):
        w = recompress.WordCutter().cut([t.encode() for t in some])
        got = [(int(d), bytes(w.data[b:e])) for d, b, e in zip(w.doc, w.begin, w.end)]
        assert got == [(i, x.encode()) for i, t in enumerate(some)
                       for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
        alone = [recompress.WordCutter().cut([x]).name[0] for _, x in got]
        assert w.name.tolist() == [int(n) for n in alone]


def test_order_sorts_names_that_share_their_high_bits():
    rng = np.random.default_rng(5)
    spread = rng.integers(0, 2 ** 64 - 1, 3000, dtype=np.uint64)
    for x in (spread, spread[rng.integers(0, 50, 3000)], spread >> np.uint64(50), spread[:1],
              spread[:0], (spread & ~np.uint64(3)) | rng.integers(0, 4, 3000).astype(np.uint64)):
        order, inorder = pitman_yor._order(x)
        assert sorted(order.tolist()) == list(range(len(x)))
        assert (x[order] == inorder).all() and (inorder == np.sort(x)).all()
        keys, rank = pitman_yor._ranked(x)
        assert (keys == np.unique(x)).all() and (keys[rank] == x).all()
