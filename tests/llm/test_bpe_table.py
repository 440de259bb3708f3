"""The shared word table against the tokenizers library and the per-task form."""

import messy
from soukline.llm import bpe, bpe_table


def test_same_ids_and_texts_as_the_library(spark):
    docs = messy.documents(spark, messy.repeated())
    tok = bpe._tokenizer(bpe.vocabulary_text())
    want = {}
    for r in messy.rows() + messy.repeated():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want.setdefault((r[0], r[1]), []).append(ids)
    got = {}
    rows = bpe_table.encode_by_table(docs.withColumn("copy", docs["text"]), chunk_bytes=20_000)
    assert set(rows.columns) == {*docs.columns, "copy", "ids"} - {"text"}
    for r in rows.collect():
        got.setdefault((r.doc_id, r.copy), []).append(r.ids)
    assert got == want


def test_digests_agree_with_the_per_task_form(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(map(tuple, bpe_table.table_digests(docs, chunk_bytes=100_000).collect()))
    assert one == sorted(map(tuple, bpe.digests(docs).collect()))
    assert bpe_table.table_digests(messy.empty(spark)).count() == 0


def test_no_word_is_encoded_twice(spark, monkeypatch):
    """Every distinct word lies in one place of the table."""
    texts = [f"a b c{i} d" for i in range(50)]
    seen = {}
    for lo in range(0, 50, 10):
        _, words, _, place = bpe_table._listed(texts[lo:lo + 10], 7)
        for w, p in zip(words, place.tolist()):
            assert seen.setdefault(w, p) == p
    assert len(seen) == 53
