"""Chat formatting with cumulative-snapshot collapse (operator 3).

Logs hold a conversation again and again as it grows. Every turn gets a rolling hash of
its conversation up to that turn: the running XOR of position-salted SHA-256 parts (240
bits). A conversation whose full hash equals the hash of a proper prefix of another is a
snapshot of it; an anti-join removes these, and of equal conversations the smallest
conv_id stays. What is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soukline.llm.common import stored

HASH = ["h1", "h2", "h3", "h4"]
ORDER = ["turn_null", "turn", "role", "text"]


def _turn_digest():
    """SHA-256 of (position, role, text); lengths keep the parts apart."""
    part = lambda c: F.coalesce(
        F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    return F.sha2(F.concat_ws("|", F.col("pos").cast("string"), part("role"), part("text")), 256)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, n_turns, h1..h4``: the rolling hash after each turn."""
    by = Window.partitionBy("conv_id").orderBy(*ORDER)
    rows = (turns.select("conv_id", "turn", "role", "text")
            .withColumn("turn_null", F.col("turn").isNull())
            .withColumn("pos", F.row_number().over(by).cast("long"))
            .withColumn("digest", _turn_digest())
            .select("conv_id", "pos", "digest"))
    run = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    hashed = rows.select("conv_id", "pos", *[
        F.bit_xor(F.conv(F.substring("digest", 15 * i + 1, 15), 16, 10).cast("long"))
        .over(run).alias(h) for i, h in enumerate(HASH)])
    return hashed.withColumn("n_turns", F.max("pos").over(Window.partitionBy("conv_id")))


def collapse(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, keep_id, maximal, kept`` of every conversation."""
    hashed = stored(prefix_hashes(turns), "chat-hashes")
    full = hashed.filter("pos = n_turns").select("conv_id", "n_turns", *HASH)
    classes = full.groupBy("n_turns", *HASH).agg(
        F.min("conv_id").alias("keep_id"), F.count(F.lit(1)).alias("n_copies"))
    prefixes = (hashed.filter("pos < n_turns")
                .select(F.col("pos").alias("n_turns"), *HASH).distinct())
    maximal = classes.join(prefixes, ["n_turns", *HASH], "left_anti").select(
        "n_turns", *HASH, F.lit(True).alias("maximal"))
    marked = classes.join(maximal, ["n_turns", *HASH], "left")
    return (full.join(marked, ["n_turns", *HASH])
            .select("conv_id", "n_turns", "n_copies", "keep_id",
                    F.coalesce("maximal", F.lit(False)).alias("maximal"))
            .withColumn("kept", F.col("maximal")
                        & F.col("conv_id").eqNullSafe(F.col("keep_id"))))


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """``conv_id, chat``: the kept conversations in a role-tagged template."""
    ids = kept.select(F.col("conv_id").alias("__id"))
    rows = (turns.join(ids, turns["conv_id"].eqNullSafe(ids["__id"]), "left_semi")
            .withColumn("turn_null", F.col("turn").isNull()))
    line = lambda t: F.concat(
        F.lit("<|"), F.coalesce(t["role"], F.lit("none")), F.lit("|>\n"),
        F.coalesce(t["text"], F.lit("")), F.lit("<|end|>\n"))
    ordered = F.array_sort(F.collect_list(F.struct(*ORDER)))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, line), "").alias("chat"))


def format_chats(turns: DataFrame) -> DataFrame:
    """Every conversation with its verdict and, where kept, its rendered chat.

    Needs ``conv_id, turn, role, text``; other columns are ignored. Returns ``conv_id,
    n_turns, n_copies, keep_id, maximal, kept, chat`` (``chat`` null unless kept).

    Defined cases: turns are ordered by turn (null last), role, text, so ties and repeated
    rows are separate turns in a fixed order; a null conv_id is one conversation; null
    role renders as ``none`` and null text as empty, yet neither equals a given value;
    no turns, no rows. A conversation is one record: its turns meet in one task.
    """
    verdicts = stored(collapse(turns), "chat-verdicts")
    chats = render(turns, verdicts.filter("kept")).withColumnRenamed("conv_id", "__id")
    return (verdicts.join(chats, verdicts["conv_id"].eqNullSafe(chats["__id"])
                          & F.col("kept"), "left").drop("__id"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, role, text,
         sha256(coalesce(length(role) || ':' || role, '-') || '|'
                || coalesce(length(text) || ':' || text, '-')) AS digest,
         '<|' || coalesce(role, 'none') || '|>' || chr(10) || coalesce(text, '')
           || '<|end|>' || chr(10) AS line
  FROM conversations),
c AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(digest, '' ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS chain,
         string_agg(line, '' ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS chat
  FROM t GROUP BY conv_id),
k AS (
  SELECT *, min(conv_id) OVER (PARTITION BY chain) AS keep_id,
         count(*) OVER (PARTITION BY chain) AS n_copies
  FROM c),
pre AS (
  SELECT DISTINCT substr(chain, 1, 64 * unnest(range(1, n_turns))) AS chain FROM c),
v AS (
  SELECT k.*, k.chain NOT IN (SELECT chain FROM pre) AS maximal FROM k)
SELECT conv_id, n_turns, n_copies, keep_id, maximal, maximal AND conv_id = keep_id AS kept,
       CASE WHEN maximal AND conv_id = keep_id THEN length(chat)::BIGINT END AS chat_chars,
       CASE WHEN maximal AND conv_id = keep_id THEN sha256(chat) END AS chat_sha256
FROM v
"""
