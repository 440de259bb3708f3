"""Every stage of the pipeline against a brute-force version of its step."""

import re

import brute
import corpus_pipeline
import messy
from soukline.llm import lines_crf, mixing
from soukline.llm.common import stored

SMALL = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((name, docs))
    return out


def check(spark, docs):
    before, seen = docs, dict(stages(spark, docs, SMALL))
    assert list(seen) == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "bpe"]
    for name in list(seen)[:-1]:
        assert seen[name].columns == docs.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    # quality: the counting rules, then the labels of the trained field
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = lines_crf.fit(before, labels)
    want = []
    for i, t in rows(before):
        base, features, sizes = lines_crf.describe(t or "")
        if not brute.base_counts(t)[-1] and lines_crf.share_of_content(
                model, features, sizes) >= lines_crf.CONTENT_SHARE:
            want.append((i, t))
    assert sorted(rows(seen["quality_rules"]), key=str) == sorted(want, key=str)

    best = {}
    for i, t in rows(seen["quality_rules"]):
        body = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[body] = min(best.get(body, (1, 0)), (-len(t), i))
    assert sorted(i for i, _ in rows(seen["exact_dedup"])) == sorted(i for _, i in best.values())

    near = brute.near(rows(seen["exact_dedup"]))
    assert sorted(i for i, _ in rows(seen["near_dedup"])) == sorted(
        i for i, (_, c) in near.items() if i == c)

    taken = {r.doc_id: r for r in mixing.taken_words(seen["near_dedup"]).collect()}
    want = sorted(i for i, r in taken.items() for _ in range(int(r.taken / r["size"] + 0.5)))
    assert sorted(i for i, _ in rows(seen["mix_sources"])) == want

    last = seen["bpe"].collect()
    assert sorted(r.doc_id for r in last) == want
    texts = dict(rows(seen["mix_sources"]))
    assert all(r.decoded_sha256 == brute.sha(texts[r.doc_id]) for r in last)


def test_stages_on_the_small_data(spark):
    check(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_stages_on_messy_rows(spark):
    check(spark, messy.documents(spark))


def test_empty_documents(spark):
    assert [d.count() for _, d in stages(spark, messy.empty(spark), SMALL)] == [0] * 5


def test_run_is_the_chain_of_stages(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(got) == sorted(stages(spark, docs, SMALL)[-1][1].collect())


def test_near_dedup_keeps_documents_without_an_id(spark):
    rows = messy.rows()
    lone = [(None, messy.sentences(messy.random.Random(i), 200, 10 ** 6), *rows[6][2:])
            for i in (1, 2)]
    docs = messy.documents(spark, [*lone, lone[0], (None, *rows[6][1:])])
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = [r.text for r in stage(spark, docs, SMALL).collect() if r.doc_id is None]
    assert sorted(got) == sorted(r[1] for r in lone)
