"""Mixing sources to target weights by a low-discrepancy schedule (operator 2).

* The words of a source, its documents in a pseudo-random order, form one stream that
  may be read up to ``max_epochs`` times; the stream is cut into blocks of
  ``block_words`` words, so every block but a source's last holds equally many.
* A source needs ``ceil(target / block_words)`` slots. The cumulative slot counts divide
  the axis ``0 .. N`` between the sources; slot ``t`` of the schedule is the point
  ``t``'s van der Corput value (its bits reversed) falls on. Over a power of two of
  points the van der Corput points are a permuted grid, so each source gets exactly its
  slots, evenly spread over every stretch of the schedule.
* Slots are ranked per source in schedule order; the slot of rank ``r`` takes block
  ``r``: an equi-join on (source, block).

Prefix sums and ranks work in two levels (per bucket, then per source over at most
``buckets`` rows), so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soukline.llm.common import file_count, stored, word_count

SLOT_CHUNK = 4096       # slots made from one row; only spreads the work over tasks
SLOT_TASK = 1 << 18     # slots made in one task, on average


def _before(value: str, by: list[str], order: list) -> Column:
    """Sum of ``value`` over the rows before this one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def source_targets(parts: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Targets per source from ``(source, words)`` rows (several per source allowed).

    Sources in code-point order (null last) weigh 1, 2, 3, repeating; a target stops at
    ``max_epochs`` times the source's words and the excess is reshared by weight. The
    sorted pass needs one row per source: filling in the order of words per weight, the
    level rises until the first source that is not capped, so it is the largest level.
    """
    per = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    fill = [(F.col("source_size") / F.col("weight")), F.col("ord")]
    return (per.withColumn("ord", F.row_number().over(by_name))
            .withColumn("weight", ((F.col("ord") - 1) % 3 + 1).cast("long"))
            .withColumn("cap", F.col("source_size") * max_epochs)
            .withColumn("left_words", F.sum("source_size").over(every)
                        - _before("cap", [F.lit(0)], fill))
            .withColumn("left_weight", F.sum("weight").over(every)
                        - _before("weight", [F.lit(0)], fill))
            .withColumn("level", F.max(F.col("left_words").cast("double")
                                       / F.col("left_weight")).over(every))
            .withColumn("target", F.least(F.col("cap").cast("double"),
                                          F.col("level") * F.col("weight")))
            .withColumn("quota", F.floor("target"))
            .select("source", "ord", "weight", "source_size", "target", "quota"))


def _reversed_bits(k: Column, bits: Column) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(k), bits, F.lit("0"))), 2, 10).cast("long")


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """``(ord, block, slot)``: which slot of the schedule takes which block of a source."""
    need = (targets.filter("quota > 0")
            .withColumn("slots", F.ceil(F.col("quota") / block_words))
            .withColumn("first", _before("slots", [F.lit(0)], ["ord"]))
            .withColumn("bits", F.length(F.bin(F.sum("slots").over(
                Window.partitionBy(F.lit(0)))))))
    chunk = F.sequence(F.lit(0).cast("long"), F.col("slots") - 1,
                       F.lit(SLOT_CHUNK).cast("long"))
    cell = F.sequence(F.col("lo"), F.least(F.col("lo") + SLOT_CHUNK, F.col("slots")) - 1)
    # a given number: by their bytes, the few rows to explode would all go to one task
    total = need.agg(F.sum("slots")).first()[0] or 0
    cells = (need.withColumn("lo", F.explode(chunk))
             .repartition(-(-total // SLOT_TASK) or 1, "ord", "lo")
             .withColumn("cell", F.explode(cell)))
    slots = (cells.withColumn("slot", _reversed_bits(F.col("first") + F.col("cell"),
                                                     F.col("bits")))
             # a source's slots are spread evenly, so a stretch holds few of each source
             .withColumn("stretch", F.floor(F.col("slot") / (16 * SLOT_CHUNK)))
             .select("ord", "slot", "stretch"))
    ahead = (slots.groupBy("ord", "stretch").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("ahead", _before("n", ["ord"], ["stretch"])))
    rank = F.row_number().over(Window.partitionBy("ord", "stretch").orderBy("slot"))
    return (slots.withColumn("rank", rank).join(ahead, ["ord", "stretch"])
            .select("ord", (F.col("ahead") + F.col("rank") - 1).alias("block"), "slot"))


def mix(docs: DataFrame, block_words: int = 64, buckets: int = 1024, max_epochs: int = 3,
        seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of the mix: one row per document and block that it has words in.

    Returns ``doc_id, source, size, source_size, target, slot, block, words`` (``slot``
    null and ``words`` 0 for a document the mix doesn't take). Needs ``doc_id``, ``text``
    and ``source``; other columns are ignored.

    Defined cases: null text has no words and is never taken; a null source is a source
    of its own, after all others; a null doc_id is an id like any other; rows that repeat
    a doc_id are separate stretches of the stream; an empty table gives no rows. ``carry``
    names further columns of ``docs`` that the blocks shall have, with ``ord`` and ``start``
    (source and place of the document's words in its stream).
    """
    order = F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 15),
        16, 10).cast("long")
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry)
                   .withColumn("place", order)
                   .withColumn("bucket", F.floor(F.col("place") / ((1 << 60) // buckets))),
                   "mix-sizes")
    parts = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = stored(source_targets(parts, max_epochs), "mix-targets")
    offsets = (parts.join(targets, parts["source"].eqNullSafe(targets["source"]))
               .select("ord", "bucket", "source_size", "target", "quota",
                       parts["source"].alias("name"),
                       _before("words", ["ord"], ["bucket"]).alias("offset")))
    within = _before("size", ["source", "bucket"], ["place", "doc_id", "size", *carry])
    placed = sized.withColumn("within", within)
    placed = (placed.join(offsets, placed["source"].eqNullSafe(offsets["name"])
                          & (placed["bucket"] == offsets["bucket"]))
              .select("doc_id", "source", "size", *carry, "ord", "source_size", "target", "quota",
                      (F.col("offset") + F.col("within")).alias("start")))
    # every reading of the stream that the quota reaches
    epoch = F.sequence(F.lit(0).cast("long"), F.lit(max_epochs - 1).cast("long"))
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    end = F.least(F.col("begin") + F.col("size"), F.col("quota"))
    taken = (placed.withColumn("epoch", F.explode(epoch)).withColumn("begin", begin)
             .withColumn("end", end).filter("end > begin")
             .withColumn("block", F.explode(F.sequence(
                 F.floor(F.col("begin") / block_words),
                 F.floor((F.col("end") - 1) / block_words))))
             .withColumn("words", F.least(F.col("end"), (F.col("block") + 1) * block_words)
                         - F.greatest(F.col("begin"), F.col("block") * block_words)))
    out = ["doc_id", "source", "size", *carry, "source_size", "target", "ord", "start"]
    # the size of exploded rows is not estimated right: without the hint, the schedule,
    # which grows with the input, can be taken for a small side and be broadcast
    read = taken.join(schedule(targets, block_words).hint("merge"), ["ord", "block"]).select(
        *out, "slot", "block", "words")
    unread = (placed.filter((F.col("size") == 0) | (F.col("start") >= F.col("quota")))
              .select(*out, F.lit(None).cast("long").alias("slot"),
                      F.lit(None).cast("long").alias("block"),
                      F.lit(0).cast("long").alias("words")))
    return read.unionByName(unread)


def taken_words(docs: DataFrame, **params) -> DataFrame:
    """Words the mix takes of each row: ``doc_id, size, source_size, target, taken``."""
    blocks = mix(docs, **params)
    rows = blocks.filter("size > 0").groupBy(
        "doc_id", "size", "source_size", "target", "ord", "start")
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    return (rows.agg(F.sum("words").alias("taken")).select(*cols)
            .unionByName(blocks.filter("size = 0")
                         .withColumn("taken", F.col("words")).select(*cols)))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix: each repeated as often as the mix reads it, to the
    nearest whole number (only the last document of a source's quota is read in part). A
    source with a target is never left without a document: its first one stays at least
    once, however small a part of it is read.

    Every row has its own count, also where rows share a doc_id or have none: rows are
    told apart by a 128-bit hash of all their columns, and of rows that are equal throughout
    one is repeated as often as all are read. Null and empty texts are never taken; very
    long texts are repeated or left whole; an empty table stays empty.
    """
    cols = [F.col(c) for c in docs.columns]
    key = ["__p", "__q"]
    files = file_count(docs)
    rows = docs.withColumns({"__p": F.xxhash64(*cols), "__q": F.xxhash64(F.lit(1), *cols)})
    times = F.round(F.sum("words") / F.col("size")).cast("long")
    first = (F.col("start") == 0) & (F.col("taken") > 0)
    reads = stored(
        mix(rows, carry=tuple(key), **params).filter("size > 0")
        .groupBy(*key, "size", "ord", "start").agg(times.alias("n"), F.sum("words").alias("taken"))
        .withColumn("n", F.when(first, F.greatest("n", F.lit(1))).otherwise(F.col("n")))
        .groupBy(*key).agg(F.sum("n").cast("int").alias("__n"), F.count(F.lit(1)).alias("__rows"))
        .filter("__n > 0"), "mix-reads", files)
    once = rows.join(reads.filter("__rows = 1"), key)
    # of rows that are equal throughout, one is repeated for all
    alike = rows.join(reads.filter("__rows > 1"), key).dropDuplicates(key)
    return (once.unionByName(alike)
            .withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select(*docs.columns).coalesce(files))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS ord
  FROM d GROUP BY source),
w AS (SELECT *, ((ord - 1) % 3 + 1)::BIGINT AS weight FROM s),
f AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lev
  FROM w
  WINDOW b AS (ORDER BY source_size / weight, ord
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(3.0::DOUBLE * source_size, max(lev) OVER () * weight) AS target
  FROM f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS quota,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
                            ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(quota, start + size) - start)
        + greatest(0, least(quota, source_size + start + size) - (source_size + start))
        + greatest(0, least(quota, 2 * source_size + start + size) - (2 * source_size + start))
       )::BIGINT AS taken
FROM p
"""
