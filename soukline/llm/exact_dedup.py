"""Exact de-duplication with skew-safe combining (operator 1).

Equal texts are found in three combining steps, each of which compares the whole
normalised text, not only its digest:

1. *local*: the map-side partial aggregate folds equal texts inside each scan task;
2. *salted*: the partial groups are merged per (digest, text, salt), the salt coming
   from the scan task, so a text with a third of all rows is spread over ``salts`` tasks;
3. *global*: at most ``salts`` winners per text meet and give the final survivor.

A candidate is one decimal number, ``length * 2**65 + rank(doc_id)``, so that "longest
original text, then smallest doc_id" is a plain ``max`` and stays in the hash aggregate.
Only (digest, fingerprint, length) and the ids travel back to the member rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import SPACES, file_count, text_or_empty

KEY = ["digest", "print", "body_chars"]
BASE = 1 << 65


def _candidates(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.length(text).alias("chars"),
                        F.translate(text, SPACES, "").alias("body"))
            .withColumn("hex", F.sha2("body", 256))
            .withColumn("digest", F.unhex("hex"))
            .withColumn("code", F.expr(
                f"CAST(chars AS DECIMAL(10,0)) * {BASE}BD + coalesce("
                "9223372036854775808BD - CAST(doc_id AS DECIMAL(20,0)), 0BD)")
                .cast("decimal(38,0)")))


def winners(docs: DataFrame, salts: int = 16) -> DataFrame:
    """One row per distinct text: KEY, ``best`` (the survivor's code) and ``group_size``."""
    rows = (_candidates(docs).select("digest", "body", "code")
            .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))))
    salted = rows.groupBy("digest", "body", "salt").agg(
        F.max("code").alias("code"), F.count(F.lit(1)).alias("n"))
    return (salted.groupBy("digest", "body")
            .agg(F.max("code").alias("best"), F.sum("n").alias("group_size"))
            .select("digest", F.xxhash64("body").alias("print"),
                    F.length("body").alias("body_chars"), "best", "group_size"))


def exact_dedup(docs: DataFrame, salts: int = 16) -> DataFrame:
    """Mark the survivor of every group of equal texts.

    Texts are equal when identical after deleting ASCII white space. Needs the columns
    ``doc_id`` and ``text``; any other column is ignored. Returns one row per input row:
    ``doc_id, keep_id, group_size, kept, text_sha256``.

    Defined cases: a null text counts as empty, and all empty texts form one group; a
    null doc_id ranks after every other id; rows that repeat both doc_id and the length
    of an equal text are one document written twice: the first is kept, the rest not. An
    empty table gives an empty result.
    """
    members = (_candidates(docs)
               .select("doc_id", "code", "digest", F.xxhash64("body").alias("print"),
                       F.length("body").alias("body_chars"))
               .groupBy("doc_id", "code", *KEY).agg(F.count(F.lit(1)).alias("n")))
    rank = F.expr(f"best % {BASE}BD")
    return (members.join(winners(docs, salts), KEY)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id",
                    F.when(rank > 0, F.expr(f"9223372036854775808BD - best % {BASE}BD"))
                    .cast("long").alias("keep_id"),
                    "group_size",
                    ((F.col("code") == F.col("best")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def keep_exact(docs: DataFrame, salts: int = 16) -> DataFrame:
    """The surviving rows with all their columns (the order of columns is kept).

    One row per distinct normalised text: the longest original, then the smallest doc_id
    (null last). Rows that tie in both differ in white space or in other columns; the one
    with the smallest hash of the row stays, so reruns agree. Null texts count as empty;
    very long texts are compared whole; an empty table stays empty.
    """
    kept = (exact_dedup(docs, salts).filter("kept")
            .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")))
    text = text_or_empty()
    rows = docs.withColumn("__key", F.sha2(F.translate(text, SPACES, ""), 256))
    same = rows["doc_id"].eqNullSafe(kept["__id"]) & (rows["__key"] == kept["__sha"])
    # of the rows that share the survivor's id and text: the longest, then by hash
    cols = [F.col(c) for c in docs.columns]
    first = F.min_by(F.struct(*cols), F.struct(-F.length(text), F.xxhash64(*cols)))
    return (rows.join(kept, same, "left_semi").groupBy("__key").agg(first.alias("__row"))
            .select("__row.*").coalesce(file_count(docs)))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
           AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
