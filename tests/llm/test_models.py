"""Free-style operators against brute force, round trips and held-out accuracy."""

import hashlib

import brute
import messy
import numpy as np
import pytest
from pyspark.sql import functions as F
from soukline.llm import (
    bpe,
    components,
    gam,
    lines_crf,
    minhash,
    pitman_yor,
    recompress,
    substring,
)

SMALL = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality long, toxic int"


def small(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- substring dedup ---------------------------------------------------------------------

@pytest.mark.parametrize("data", ["messy", "small"])
def test_substring_matches_brute_force(spark, data):
    docs = messy.documents(spark) if data == "messy" else small(spark)
    got = {tuple(r) for r in substring.substring_dedup(docs).collect()}
    assert got == set(brute.substring(pairs(docs)))


def test_substring_repeated_rows_and_no_id(spark):
    docs = messy.documents(spark, messy.repeated())
    got = substring.substring_dedup(docs).collect()
    assert len(got) == docs.count()
    distinct = list(dict.fromkeys(pairs(docs)))
    want = brute.substring([p for p in distinct if p[0] is not None])
    assert {tuple(r) for r in got if r.doc_id is not None} == set(want)
    lost = [r.n_removed for r in got if r.doc_id is None]
    assert lost == [r.n_words for r in got if r.doc_id is None][:1] + lost[1:]


def test_equal_stretches_share_their_sure_symbols():
    rng = np.random.default_rng(1)
    for _ in range(30):
        part = rng.integers(0, 4, 40)
        doc = [np.concatenate([rng.integers(0, 4, 30), part, rng.integers(0, 4, 30)])
               for _ in range(2)]
        found = []
        for d in doc:
            name = np.column_stack([d, d + 7]).astype(np.uint64)
            p = recompress.parse(recompress.mix(name), np.zeros(len(d), dtype=int), 4)
            found.append([tuple(p.name[k]) for k in range(p.first[30], p.last[69] + 1)])
        assert found[0] == found[1]


# --- MinHash -----------------------------------------------------------------------------

@pytest.mark.parametrize("data", ["messy", "small"])
def test_near_duplicates_match_brute_force(spark, data):
    docs = messy.documents(spark) if data == "messy" else small(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash.near_duplicates(docs).collect()}
    want = brute.near(pairs(docs))
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_duplicates_repeated_rows(spark):
    docs = messy.documents(spark, messy.repeated())
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    want = brute.near(pairs(messy.documents(spark)))
    assert all(r.component_id == want[r.doc_id][1] for r in got if r.doc_id is not None)
    assert minhash.keep_distinct(docs).columns == docs.columns


def _without_ids():
    """Rows (doc_id, text): copies and near copies with and without an id."""
    def words(tag, n=80, *changed):
        return " ".join(f"{tag}{i}x" if i in changed else f"{tag}{i}" for i in range(n))
    return [(None, words("solo")),                                      # alone
            (None, words("pair")), (None, words("pair", 81)),           # only near copies
            (None, words("same")), (None, words("same")), (None, words("same").upper()),
            (5, words("mixed")), (None, words("mixed", 81)),            # one has an id
            # 8 and 9 are linked only through the row between them
            (8, words("chain", 80)), (None, words("chain", 90)), (9, words("chain", 100)),
            (None, None), (None, ""), (7, "")]


def test_rows_without_an_id_are_linked_and_one_is_kept(spark):
    docs = spark.createDataFrame(_without_ids(), "doc_id long, text string")
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: r.component_id for r in got if r.doc_id} == {5: 5, 7: 7, 8: 8, 9: 8}
    kept = sorted(((r.doc_id, (r.text or "")[:4].lower())
                   for r in minhash.keep_distinct(docs).collect()), key=str)
    assert kept == sorted([(None, "solo"), (None, "pair"), (None, "same"), (5, "mixe"),
                           (8, "chai"), (None, ""), (None, ""), (7, "")], key=str)
    assert sum(r.kept for r in got) == len(kept)


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    docs = messy.documents(spark)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: c for i, (_, c) in brute.near(pairs(docs)).items()}


def test_estimate_corrects_chance_collisions():
    rng = np.random.default_rng(5)
    both = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    a = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 50).astype(np.uint64)]))
    b = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 50).astype(np.uint64)]))
    sig = [np.frombuffer(minhash.packed(minhash.minima(x)), dtype=np.uint64)[None] for x in (a, b)]
    assert abs(minhash.estimates(*sig)[0, 0] - 0.9) < 0.12
    other = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    far = np.frombuffer(minhash.packed(minhash.minima(other)), dtype=np.uint64)[None]
    assert abs(minhash.estimates(sig[0], far)[0, 0]) < 0.15


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    edges = edges.unionByName(spark.createDataFrame([(1000, 900), (900, 1000), (5, 5)],
                                                    "u long, v long"))
    got = {r.vertex: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 1000: 900}


# --- quality rules -----------------------------------------------------------------------

def test_line_labels_and_counts(spark):
    docs = messy.documents(spark, messy.repeated())
    model = lines_crf.fit(small(spark), small(spark, "labels"))
    got = lines_crf.judge(docs, model).collect()
    have = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in got)
    assert have == sorted((str(i), *brute.base_counts(t)) for i, t in pairs(docs))
    assert not any(r.kept and r.base_failed for r in got)
    by = {r.doc_id: r.kept for r in got}
    marked = {t: i for i, t in pairs(docs)}
    assert not by[marked["10 %%% $$$ ### 20 &&& *** 30 ||| <<< >>> 40 50 60 70"]]
    kept = lines_crf.keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_quality_verdict_agrees_with_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
                    for t in ("documents", "labels"))
    train = labels.filter("doc_id % 2 = 0")
    model = lines_crf.fit(docs, train)
    judged = lines_crf.judge(docs, model).filter("NOT base_failed")
    got = judged.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    right = sum(r.kept == bool(r.quality) for r in got)
    clean = [r for r in got if r.quality == 1]
    assert right >= 0.97 * len(got) and sum(r.kept for r in clean) >= 0.99 * len(clean)


def test_without_labels_the_counts_decide(spark):
    none = spark.createDataFrame([], LABELS)
    assert lines_crf.fit(small(spark), none) is None
    got = lines_crf.judge(messy.documents(spark), None).collect()
    assert all(r.kept != r.base_failed for r in got)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    emit, move = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))

    def value(path):
        return sum(emit[i, k] for i, k in enumerate(path)) + sum(
            move[a, b] for a, b in zip(path, path[1:]))
    best = max(np.ndindex(*[2] * 7), key=value)
    assert tuple(lines_crf.viterbi(emit, move)) == best


# --- language model ----------------------------------------------------------------------

def test_scores_match_brute_force_counts(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 20_000)
    docs = messy.documents(spark, messy.repeated())
    got = pitman_yor.score_texts(docs).collect()
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6))
    assert sorted(key(tuple(r)[:6]) for r in got) == sorted(map(key, brute.base_scores(pairs(docs))))
    assert all(r.score < 0 for r in got)


def test_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = (pitman_yor.score_texts(docs).filter("held_out")
         .agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first())
    assert r.s > r.b


def test_reruns_agree(spark):
    one, two = ({(r.doc_id, r.score) for r in pitman_yor.score_texts(small(spark)).collect()}
                for _ in range(2))
    assert one == two


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([(i, "a b a c d a b") for i in range(5)], "doc_id long, text string")
    state, m = pitman_yor.train(docs, 3)
    buckets = [pitman_yor._State.of(r.asDict()) for r in state.collect()]
    assert m["types"] == 5 and m["tokens"] == 40
    for ctx in (pitman_yor.START, 12345):
        total = (m["weights"][:, ctx] * m["unseen"]).mean()         # the unknown type
        for s in buckets:
            word = np.repeat(np.arange(len(s.names)), s.sizes)
            for w in range(len(s.names)):
                have = np.flatnonzero((word == w) & (s.contexts == ctx))
                total += (s.score[have[0]] / pitman_yor.SAMPLES if len(have)
                          else (m["weights"][:, ctx] * s.parent[w]).mean())
        assert abs(total - 1) < 1e-9


def _probability(state, m, context, name):
    """Of a word in a context, from the stored pairs, words and contexts."""
    for r in state.collect():
        s = pitman_yor._State.of(r.asDict())
        dish = np.flatnonzero((np.repeat(s.names, s.sizes) == name) & (s.contexts == context))
        if len(dish):
            return s.score[dish[0]] / pitman_yor.SAMPLES
    parent = m["unseen"]
    for r in m["owned"].filter(F.col("kind") == pitman_yor.WORD).collect():
        i = np.flatnonzero(np.frombuffer(r["names"], np.uint64) == name)
        if len(i):
            parent = (np.frombuffer(r["samples"]).reshape(-1, pitman_yor.SAMPLES)[i[0]]
                      / m["norms"] + m["unseen"])
    return (m["weights"][:, context] * parent).mean()


@pytest.mark.parametrize("spread", [False, True])
def test_the_context_is_the_whole_word_before(spark, spread):
    texts = ["xa p ya q", "xa p xa p", "ya q ya q", "p xa p ya", "q ya q xa"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 4)],
                                 "doc_id long, text string")
    name = dict(zip(["xa", "ya", "p", "q"], recompress.WordCutter().cut(
        [b"xa ya p q"]).name))
    deal = pitman_yor.Deal(7, list(name.values()), [7] * 4) if spread else None
    state, m = pitman_yor.train(docs, 7, deal)
    p = lambda c, w: _probability(state, m, c, w)
    # both words end in the same byte, but are different contexts
    assert p(name["xa"], name["p"]) > 3 * p(name["xa"], name["q"])
    assert p(name["ya"], name["q"]) > 3 * p(name["ya"], name["p"])
    for c in (pitman_yor.START, *name.values()):
        total = sum(p(c, w) for w in (pitman_yor.END, *name.values(), 99))     # 99: unknown
        assert abs(total - 1) < 1e-9
    customers = {k: int(n) for r in m["owned"].collect() if r["kind"] == pitman_yor.CONTEXT
                 for k, n in zip(np.frombuffer(r["names"], np.uint64).tolist(),
                                 np.frombuffer(r["counts"], np.int64))}
    assert customers == dict.fromkeys(
        [pitman_yor.START, *(int(name[w]) for w in ("xa", "ya", "p", "q"))], 20)


def test_frequent_words_spread_over_buckets_score_alike(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 20_000)
    docs = messy.documents(spark, messy.repeated())
    sums = []
    for part in (pitman_yor.PART, 20):
        monkeypatch.setattr(pitman_yor, "PART", part)
        monkeypatch.setattr(pitman_yor, "SAMPLE", 1)
        sums.append({(str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)): r.score
                     for r in pitman_yor.score_texts(docs).collect()})
    assert sums[0].keys() == sums[1].keys()
    assert all(abs(sums[1][k] / v - 1) < 0.02 for k, v in sums[0].items())


def test_seating_bounds_and_mean():
    rng = np.random.default_rng(0)
    n = np.array([1, 2, 50, 1000, 10 ** 6] * 400)
    tables = pitman_yor.seat(n, np.full(len(n), 3.0), 0.5, rng).reshape(-1, 5)
    assert (tables >= 1).all() and (tables <= n.reshape(-1, 5)).all()
    assert (tables[:, 0] == 1).all()
    assert (np.diff(tables.mean(0)) > 0).all()
    one = [1 + (rng.random() < 3.0 / (3.0 + 1 - 0.5)) for _ in range(4000)]
    assert abs(np.mean(one) - tables[:, 1].mean()) < 0.08


# --- classifier --------------------------------------------------------------------------

def test_classifier_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
                    for t in ("documents", "labels"))
    got = gam.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def test_classifier_defined_cases(spark):
    docs = messy.documents(spark, messy.repeated())
    got = gam.classify(docs, small(spark, "labels")).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in gam.classify(docs, none).collect()} == {0.5}


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(4)
    x = rng.random((4000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y, pair_rounds=40)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


# --- tokens ------------------------------------------------------------------------------

@pytest.mark.parametrize("data", ["messy", "small"])
def test_bpe_matches_the_library(spark, data):
    from tokenizers import Tokenizer
    docs = messy.documents(spark, messy.repeated()) if data == "messy" else small(spark)
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    want = []
    for i, t in pairs(docs):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in bpe.digests(docs).collect()) == sorted(want)


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, [220, 10 ** 6, 15496]), (2, None), (3, [447]), (4, [])],
                               "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df).collect()}
    assert got[1] == " Hello" and got[2] == got[4] == "" and "\ufffd" in got[3]


def test_word_table_restarts(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 3)
    table = bpe.WordTable(bpe.vocabulary_text())
    texts = ["a b c d e f", "g h i a b", "", "a b c d e f"]
    ids, sizes = bpe.WordTable(bpe.vocabulary_text()).encode(texts)
    got = [table.encode(texts[:1]), table.encode(texts[1:])]
    assert np.concatenate([g[0] for g in got]).tolist() == ids.tolist()
    assert np.concatenate([g[1] for g in got]).tolist() == sizes.tolist()


# --- empty tables ------------------------------------------------------------------------

def test_empty_tables(spark):
    docs, labels = messy.empty(spark), spark.createDataFrame([], LABELS)
    assert substring.substring_dedup(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.keep_distinct(docs).count() == 0
    assert lines_crf.judge(docs, lines_crf.fit(docs, labels)).count() == 0
    assert pitman_yor.score_texts(docs).count() == 0
    assert gam.classify(docs, labels).count() == 0
    assert bpe.digests(docs).count() == 0


def test_bpe_encodes_and_decodes_in_one_worker_per_task(spark):
    docs = spark.createDataFrame([(1, "a b  c", 7), (1, "a b  c", 7), (None, None, 8), (3, "", 9)],
                                 "doc_id long, text string, extra int")
    plan = bpe.digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1        # two hold twice the memory of an executor
    two = bpe.decode(bpe.encode(docs))
    one = bpe.round_trip(docs)
    assert one.schema == two.schema
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
