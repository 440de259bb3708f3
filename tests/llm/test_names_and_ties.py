"""Word names that must not collide, and rows that tie or share an id."""

import math
import zlib

import brute
import pytest
from soukline.llm import exact_dedup, gam, lines_crf, minhash, mixing, pitman_yor, recompress, substring


def thue_morse(n):
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


SIZES = (8, 64, 256, 512, 1024, 2048, 4096)


def test_names_of_regular_words_differ():
    words = [w.encode() for n in SIZES for w in thue_morse(n)]
    words += [b"x" * n for n in (1, 2, 7, 8, 9, 255, 256, 257, 10 ** 6, 10 ** 6 + 1)]
    names = recompress.WordCutter().cut([b" ".join(words), words[0]]).name.tolist()
    assert len(set(names)) == len(words) and names[-1] == names[0]


@pytest.fixture(scope="module")
def twins(spark):
    """Texts that differ in one long word only, whose polynomial hashes modulo 2^64 agree."""
    rows, rest = [], " ".join(f"w{i}" for i in range(19))
    for k, n in enumerate(SIZES):
        a, b = thue_morse(n)
        tail = rest.replace("w", f"v{k}x")
        rows += [(2 * k, f"{a} {tail}"), (2 * k + 1, f"{b} {tail}")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_substring_dedup_keeps_words_of_unequal_windows(twins):
    rows, docs = twins
    got = sorted(map(tuple, substring.substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert got == sorted(brute.substring(rows)) and all(r[2] == 0 for r in got)


def test_unknown_words_are_not_taken_for_known_ones(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1]
    learnt = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows = [(i, f"{thue_morse(n)[0]} c") for i, n in zip(learnt, SIZES)]
    rows += [(i, thue_morse(n)[1]) for i, n in zip(held, SIZES)]
    out = {r.doc_id: r for r in pitman_yor.score_texts(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    tokens, types = 3 * len(SIZES), len(SIZES) + 2
    for i in held[:len(SIZES)]:
        assert (out[i].n_tokens, out[i].n_known) == (2, 1)          # the end alone is known
        base = lambda c: math.log10((c + .5) / (tokens + .5 * (types + 1)))
        assert abs(out[i].base_score - base(0) - base(len(SIZES))) < 1e-9


DOC = "doc_id long, text string, source string, digest string"


def test_exact_dedup_keeps_the_longest_also_under_one_id(spark):
    rows = [(1, "ab", "s", "x"), (1, "a b", "s", "y"), (1, "a\tb", "s", "z"), (None, "ab", "s", "x"),
            (None, "q", "s", "x"), (None, "q", "s", "x"), (7, None, "s", "x"), (7, " ", "s", "x")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, DOC).repartition(3)
        got = sorted(map(tuple, exact_dedup.keep_exact(docs).collect()), key=str)
        assert [len(r[1] or "") for r in got if r[0] == 1] == [3]
        assert sum(r[1] == "q" for r in got) == 1 and sum(r[0] == 7 for r in got) == 1
        assert len(got) == 3
        first = got if order is rows else first  # noqa: F821
    assert got == first                             # ties fall alike in any order


def test_mix_counts_every_row_by_itself(spark):
    rows = [(None, "a " * 100, "s", "x"), (None, "b " * 1000, "s", "x"), (5, "c " * 30, "t", "x"),
            (5, "d " * 40, "t", "y"), (6, "e " * 9, "u", "z"), (6, "e " * 9, "u", "z"),
            (8, "", "s", "x"), (9, None, None, "x")]
    docs = spark.createDataFrame(rows, DOC)
    taken = mixing.mix(docs.withColumn("key", docs["text"]), carry=("key",)).filter("words > 0") \
        .groupBy("key", "size", "start").sum("words").collect()
    want = {}
    for r in taken:
        n = max(round(r[3] / r["size"] + 1e-9), 1 if r.start == 0 else 0)
        want[r["key"]] = want.get(r["key"], 0) + n
    got = [r.text for r in mixing.mixed_documents(docs).collect()]
    assert {t: got.count(t) for t in set(got)} == {t: n for t, n in want.items() if n}
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_a_source_with_a_target_keeps_a_document(spark):
    rows = [(1, "a " * 1000, "a", "x")] + [(i, "b " * 10, "b", "x") for i in range(2, 5)]
    rows += [(9, "c " * 1000, "c", "x")]
    got = {r.source for r in mixing.mixed_documents(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {"a", "b", "c"}


def test_repeated_ids_of_near_duplicates_are_documents_of_their_own(spark):
    words = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(3, words("a"), "s", "x"), (5, words("a"), "s", "x"), (5, words("b"), "s", "x"),
            (9, words("b"), "s", "x")]
    got = sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(
        spark.createDataFrame(rows, DOC)).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (9, 5)]


def test_models_do_not_depend_on_the_order_of_tied_rows(spark):
    labels = [(i, i % 2) for i in range(40)] + [(i, 1 - i % 2) for i in range(10)]
    texts = [(i, f"good words here {i}.\nmore of them" if i % 2 else "### buy $$$ now", "s", "x")
             for i in range(40)] + [(i, f"another text {i}", "s", "x") for i in range(20)]
    kind, found = "doc_id long, quality int", []
    for step in (1, -1):
        docs = spark.createDataFrame(texts[::step], DOC).repartition(4)
        marks = spark.createDataFrame(labels[::step], kind).repartition(3)
        field = lines_crf.fit(docs, marks)
        scores = sorted((r.doc_id, r.score) for r in gam.classify(docs, marks).collect())
        found.append((field[0].tolist(), field[1].tolist(), scores))
    assert found[0] == found[1]


def test_training_reads_lines_over_the_whole_document():
    lines = list(range(1000))
    assert sum(lines_crf.stretches(lines, 60, 64), []) == lines
    some = lines_crf.stretches(lines, 10, 5)
    assert len(some) == 5 and some[0][0] == 0 and some[-1][-1] == 999
    assert lines_crf.stretches([], 60, 64) == []
