"""Tables between two steps have no more files than their texts are worth."""

import brute
import pytest
from soukline.llm import common, components, exact_dedup, minhash, mixing, substring

DOCS = "doc_id long, text string, source string"
MANY = {"spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def many_partitions(spark):
    before = {k: spark.conf.get(k) for k in MANY}
    for k, v in MANY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def files(monkeypatch):
    """Tag and number of files of every table stored."""
    seen = []

    def recorded(df, tag, *most):
        out = common.stored(df, tag, *most)
        seen.append((tag, len(out.inputFiles())))
        return out

    for module in (components, minhash, mixing, substring):
        monkeypatch.setattr(module, "stored", recorded)
    return seen


def docs():
    words = [f"w{i}" for i in range(400)]
    text = lambda i: " ".join(words[i % 300:i % 300 + 60] + [f"u{i}"])
    rows = [(i, text(i // 2 * 7), f"s{i % 2}") for i in range(200)]
    return rows + [(None, text(3), None), (201, None, "s0"), (202, "", "s0")]


def test_file_count_follows_the_texts(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a" * 5000, "s"), (2, None, "s")], DOCS)
    least = spark.sparkContext.defaultParallelism
    assert common.file_count(df) == common.file_count(df.limit(0)) == least
    monkeypatch.setattr(common, "TEXT_A_FILE", 100)
    assert common.file_count(df) == -(-(5000 + 2 * common.ROW_BYTES) // 100) > least


def test_substring_dedup_stores_few_files(many_partitions, files):
    rows, spark = docs(), many_partitions
    df = spark.createDataFrame(rows, DOCS).repartition(16)
    most = common.file_count(df)
    got = substring.substring_dedup(df)
    assert sum(r.n_removed for r in got.collect()) > 0
    assert len(files) == 10 and max(n for _, n in files) <= most < 40, files
    assert got.rdd.getNumPartitions() <= 2 * most       # finished rows, and the others
    assert got.count() == len(rows)


def test_near_duplicates_store_few_files(many_partitions, files):
    rows, spark = docs(), many_partitions
    df = spark.createDataFrame(rows, DOCS).repartition(16)
    most = common.file_count(df)
    got = minhash.keep_distinct(df)
    near = brute.near([(i, t) for i, t, _ in rows if i is not None])
    assert ({r.doc_id for r in got.collect()} - {None}
            == {i for i, (_, c) in near.items() if i == c})
    assert got.rdd.getNumPartitions() <= most
    assert {t for t, _ in files} >= {"components", "components-least", "minhash-reps"}
    assert max(n for _, n in files) <= most < 40, files


def test_stages_return_few_partitions(many_partitions, files):
    rows, spark = docs(), many_partitions
    df = spark.createDataFrame(rows, DOCS).repartition(16)
    most = common.file_count(df)
    for stage in (exact_dedup.keep_exact, mixing.mixed_documents):
        got = stage(df)
        assert 0 < got.count() and got.rdd.getNumPartitions() <= most < 40
    assert dict(files)["mix-reads"] <= most
