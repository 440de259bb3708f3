"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, tokens.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and
returns the documents that go on, with the columns of ``documents`` (the last stage: the
encoded documents). Between two stages the rows are written as Parquet and reread, so a
lost executor never costs more than the stage at hand.

Stages, each over everything its predecessor kept:

1. ``quality_rules`` drops what the counting rules or the line labels reject;
2. ``exact_dedup`` keeps the longest, then first, of equal texts;
3. ``near_dedup`` keeps the first document of each near-duplicate component;
4. ``mix_sources`` repeats or drops documents so that sources meet their targets;
5. ``bpe`` encodes and decodes: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

Null texts are rejected by the first stage (they have no words); an empty table stays
empty through all stages; extra columns ride along until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from soukline.llm import bpe, exact_dedup, lines_crf, minhash, mixing
from soukline.llm.common import stored, table

Stage = tuple[str, object]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = lines_crf.fit(docs, table(spark, sf_dir, "labels"))
    return lines_crf.keep_quality(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_exact(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_distinct(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_duplicates),
          ("near_dedup", near_duplicates), ("mix_sources", mix_sources), ("bpe", encode)]

# the first stage's line labels have no SQL form; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
