"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from soukline.llm import (
    bpe,
    chat,
    exact_dedup,
    gam,
    hard_negatives,
    lines_crf,
    minhash,
    mixing,
    page_text,
    pitman_yor,
    runs,
    substring,
    url_rules,
)
from soukline.llm.common import table
from soukline.session import ensure_conf


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat.format_chats(table(spark, sf_dir, "conversations"))
    return chats.select("conv_id", "n_turns", "n_copies", "keep_id", "maximal", "kept",
                        F.length("chat").cast("long").alias("chat_chars"),
                        F.sha2("chat", 256).alias("chat_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lines_crf.fit(docs, table(spark, sf_dir, "labels"))
    return lines_crf.judge(docs, model)


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, sf_dir, "documents"))


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_frame(spark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.embedding_rows(table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(table(spark, sf_dir, "documents"))


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.page_texts(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [op1_exact_dedup, op2_mix_sources, op3_chat_format, op4_substring_dedup,
           op5_quality_rules, op6_pitman_yor, op7_quality_gam, op8_minhash,
           op9_bpe, op10_url_rules, op11_hard_negatives, op12_periodic_runs,
           op13_page_text, pipeline]
ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE, "op2_mix_sources": mixing.ORACLE,
           "op3_chat_format": chat.ORACLE, "op10_url_rules": url_rules.ORACLE,
           "op11_hard_negatives": hard_negatives.ORACLE, "op13_page_text": page_text.ORACLE}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def configured(f):
        return lambda spark, sf_dir: f(ensure_conf(spark), sf_dir)
    return {f.__name__: configured(f) for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
