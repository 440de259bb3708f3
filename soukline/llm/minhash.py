"""Near-duplicate detection with b-bit MinHash (operator 8).

1. Each document becomes the set of its hashed word shingles, and gets a digest of the set
   and ``BANDS`` band keys of ``ROWS`` minima each. Documents with equal sets form a
   class; only its representative (smallest doc_id) goes on. A class without any id goes on
   under a vertex from its digest, which is larger than every doc_id.
2. Representatives that share a band key are candidates. Every member of a bucket is
   linked to the bucket's smallest member, never to all others, and the components of
   these links are the candidate clusters: a pair that shares a key is in one cluster.
3. The clusters are cut into blocks of about ``BLOCK`` members. For every pair of blocks
   one task compares packed signatures (``BITS`` low bits of each minimum) by bit counts,
   and confirms pairs whose collision-corrected estimate is near the threshold on the
   full sets. It returns a spanning forest of the true links, not all pairs.
4. Components of the confirmed links give every document its class.

A pair at the threshold shares no band key with probability (1 - 0.85^8)^32 = 4e-5; the
estimate's margin (``MARGIN`` is over five standard deviations) adds less than 1e-7.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import file_count, map_arrow, stored, text_or_empty
from soukline.llm.components import components

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE = 5
PERCENT = 85                # link when 100 * intersection >= PERCENT * union
BANDS, ROWS, BITS = 32, 8, 2
MARGIN = 0.15
BLOCK = 384
WORD_TABLE = 500_000        # of one task's word hashes; beyond, it starts anew
VERTEX = "decimal(20,0)"    # doc_ids as they are; from 2^63 on classes without an id
SET = ["n_shingles", "d1", "d2"]


class WordHash(dict):
    """word bytes -> 64-bit hash, each distinct word hashed once."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, table: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text (A-Z lower-cased)."""
    words = WORDS.findall(text.encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(table.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(table) > WORD_TABLE:
        table.clear()
    width = min(SHINGLE, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return np.unique(out)


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_260_101)
    n = BANDS * ROWS
    return (rng.integers(0, 1 << 32, n, dtype=np.uint32),
            rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1))


def minima(found: np.ndarray, family=None) -> np.ndarray:
    """The ``BANDS * ROWS`` minima of a shingle set, over 32-bit multiplicative hashes."""
    flip, times = family or _family()
    half = len(flip) // 2
    out = np.full(len(flip), 0xFFFFFFFF, dtype=np.uint32)
    low, high = found.astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(found), 256):
        for part, cut in ((low, slice(0, half)), (high, slice(half, None))):
            x = (part[lo:lo + 256, None] ^ flip[cut]) * times[cut]
            np.minimum(out[cut], x.min(axis=0), out=out[cut])
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    rows = mins.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def packed(mins: np.ndarray) -> bytes:
    """The low ``BITS`` bits of every minimum, packed."""
    bits = (mins[:, None] >> np.arange(BITS, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity estimates of packed signatures, rows of ``a`` against rows of ``b``
    (uint64 words): the share of equal minima, corrected for chance collisions of bits."""
    even = np.uint64(0x5555555555555555)
    differ = np.zeros((len(a), len(b)), dtype=np.uint32)
    for i in range(a.shape[1]):
        x = a[:, None, i] ^ b[None, :, i]
        differ += np.bitwise_count((x | (x >> np.uint64(1))) & even)
    chance = 0.5 ** BITS
    return (1.0 - differ / (BANDS * ROWS) - chance) / (1.0 - chance)


def _sha() -> Column:
    """Digest of the text of a row without an id (null with one)."""
    return F.when(F.col("doc_id").cast("long").isNull(), F.sha2(text_or_empty(), 256))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands, sha`` of every row (d1, d2: digest of the set;
    sha: digest of the text, of rows without an id)."""
    def run(batches):
        table, family = WordHash(), _family()
        for b in batches:
            ids = b.column("doc_id")
            sizes, d1, d2, keys = [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text, table)
                dig = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                    dtype=np.int64)
                sizes.append(len(s))
                d1.append(int(dig[0]))
                d2.append(int(dig[1]))
                keys.append(band_keys(minima(s, family)).tolist() if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()),
                 pa.array(d2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), b.column("sha")],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "sha"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 text_or_empty().alias("text"), _sha().alias("sha")),
                     run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>,"
                          " sha string")


def candidate_clusters(reps: DataFrame, files: int | None = None) -> DataFrame:
    """``vertex, component`` over representatives that share a band key."""
    keyed = reps.select("vertex", F.explode("bands").alias("key"))
    # stored: the join then has a plain shuffle on both sides, which can be split
    first = stored(keyed.groupBy("key")
                   .agg(F.min("vertex").alias("v"), F.max("vertex").alias("w"))
                   .filter("v != w").select("key", "v"), "minhash-buckets", files)
    return components(keyed.join(first, "key").select(F.col("vertex").alias("u"), "v"), files)


def _links(table: pa.Table) -> pa.Table:
    """Confirmed links between the two blocks of a task: a spanning forest."""
    ids = table.column("vertex").to_pylist()
    block = np.asarray(table.column("block").to_pylist())
    sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]
    sig = np.stack([np.frombuffer(s, dtype=np.uint64)
                    for s in table.column("signature").to_pylist()])
    size = np.asarray([len(s) for s in sets])
    one, two = block.min(), block.max()
    left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
    est = estimates(sig[left], sig[right])
    small = np.minimum(size[left][:, None], size[right][None, :])
    large = np.maximum(size[left][:, None], size[right][None, :])
    near = (est >= PERCENT / 100 - MARGIN) & (100 * small >= PERCENT * large)
    if one == two:
        near &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    i, j = np.nonzero(near)
    order = np.argsort(-est[i, j], kind="stable")   # likely links first: fewer checks
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(left[i[order]].tolist(), right[j[order]].tolist()):
        ra, rb = find(a), find(b)
        if ra == rb:
            continue
        shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if 100 * shared >= PERCENT * (len(sets[a]) + len(sets[b]) - shared):
            root[ra] = rb
            out.append((ids[a], ids[b]))
    kind = pa.decimal128(20, 0)
    return pa.table({"u": pa.array([a for a, _ in out], kind),
                     "v": pa.array([b for _, b in out], kind)})


def confirmed_links(docs: DataFrame, reps: DataFrame, clusters: DataFrame) -> DataFrame:
    """``u, v``: links between representatives, confirmed on full shingle sets."""
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    members = (clusters.join(sizes, "component")
               .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("long"))
               .select("vertex", "component", "blocks",
                       F.pmod(F.xxhash64("vertex"), F.col("blocks")).alias("block"))
               .join(reps.select("vertex", "doc_id", "d1", "d2", "sha"), "vertex"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty().alias("text"), _sha().alias("sha"))
    texts = (rows.drop("sha").join(members.drop("sha"), "doc_id")
             .unionByName(rows.filter("doc_id is null").drop("doc_id")
                          .join(members.filter("doc_id is null").drop("doc_id"), "sha")
                          .dropDuplicates(["vertex"]).drop("sha"), allowMissingColumns=True))

    def run(batches):
        table, family = WordHash(), _family()
        keep = ["vertex", "component", "blocks", "block"]
        for b in batches:
            mine, found, sig = [], [], []
            for text, d1, d2 in zip(*(b.column(c).to_pylist() for c in ("text", "d1", "d2"))):
                s = shingles(text, table)
                dig = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                    dtype=np.int64)
                mine.append(bool(dig[0] == d1 and dig[1] == d2))
                found.append(s.tobytes())
                sig.append(packed(minima(s, family)))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(found, pa.binary()),
                 pa.array(sig, pa.binary())],
                names=[*keep, "shingles", "signature"]).filter(pa.array(mine, pa.bool_()))

    sets = map_arrow(texts, run, f"vertex {VERTEX}, component {VERTEX}, blocks long,"
                                 " block long, shingles binary, signature binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (sets.withColumn("other", other)
             .withColumn("low", F.least("block", "other"))
             .withColumn("high", F.greatest("block", "other")))
    return (dealt.select("component", "low", "high", "vertex", "block", "shingles", "signature")
            .groupBy("component", "low", "high").applyInArrow(_links, f"u {VERTEX}, v {VERTEX}"))


def classified(docs: DataFrame, files: int | None = None) -> DataFrame:
    """Class of every row: ``doc_id, n_shingles, component_id, kept, sha``.

    A document's set are its distinct 5-word shingles (A-Z lower-cased), with fewer words
    the whole sequence; documents are linked when 100 * intersection >= 85 * union, and
    ``component_id`` is the smallest doc_id reachable.

    Defined cases: null or empty text has no shingles and links with nothing; rows that
    repeat a doc_id are documents of their own, linked by their texts only (each gets the
    component of its text, so an id can stand in two); rows without a doc_id take part in links and rank
    after all others. A component none of whose rows has an id gets a null ``component_id``
    and exactly one kept row, a row without id and without shingles is kept. Extra columns
    are ignored. Classes without an id count as the same when 64 bits of their digests agree.
    ``files``: the ``file_count`` of ``docs``, if the caller has it.
    """
    files = files or file_count(docs)
    rows = stored(signatures(docs), "minhash-signatures", files)
    full = rows.filter("n_shingles > 0")
    beyond = (F.col("d1").cast(VERTEX) + F.expr("18446744073709551616BD")).cast(VERTEX)
    classes = (full.groupBy(*SET).agg(F.min("doc_id").alias("rep"))
               .withColumn("vertex", F.coalesce(F.col("rep").cast(VERTEX), beyond)))
    reps = (full.join(classes.select(F.col("rep").alias("doc_id"), *SET, "vertex"),
                      ["doc_id", *SET]).dropDuplicates(["doc_id", *SET])
            # equal sets have equal bands: any text stands for a class without an id
            .unionByName(full.filter("doc_id is null").join(
                classes.filter("rep is null").select(*SET, "vertex"), SET)
                .dropDuplicates(["vertex"])))
    reps = stored(reps, "minhash-reps", files)
    clusters = stored(candidate_clusters(reps, files), "minhash-clusters", files)
    links = stored(confirmed_links(docs, reps, clusters), "minhash-links", files)
    least = F.coalesce("component", "vertex")
    named = classes.join(components(links, files), "vertex", "left").select(
        *SET, F.when(least < F.expr("9223372036854775808BD"), least).cast("long").alias("component_id"),
        (least == F.col("vertex")).alias("leads"))
    out = ["doc_id", "n_shingles", "component_id", "kept"]
    own = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    # rows without an id and with equal texts are counted, and told apart by number only
    texts = full.filter("doc_id is null").groupBy(*SET, "sha").agg(F.count(F.lit(1)).alias("n"))
    first = texts.groupBy(*SET).agg(F.min("sha").alias("first"))
    copies = (texts.join(first, SET).join(named, SET)
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
              .withColumn("kept", F.col("component_id").isNull() & F.col("leads")
                          & (F.col("sha") == F.col("first")) & (F.col("copy") == 1)))
    return (full.filter("doc_id is not null").join(named, SET).withColumn("kept", own)
            .select(*out)
            .unionByName(copies.withColumn("doc_id", F.lit(None).cast("long")).select(
                *out[:3], "kept", "sha"), allowMissingColumns=True)
            .unionByName(rows.filter("n_shingles = 0")
                         .withColumn("component_id", F.col("doc_id"))
                         .withColumn("kept", F.lit(True)).select(*out, "sha"),
                         allowMissingColumns=True))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Class of every row: ``doc_id, n_shingles, component_id, kept`` (see :func:`classified`)."""
    return classified(docs).drop("sha")


def keep_distinct(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns, also when it has no id."""
    files = file_count(docs)
    kept = stored(classified(docs, files).filter("kept"), "minhash-kept", files)
    ids = kept.select(F.col("doc_id").alias("__id"))
    named = docs.join(ids, docs["doc_id"] == ids["__id"], "left_semi")
    nameless = docs.filter(F.col("doc_id").cast("long").isNull()).withColumn("__sha", _sha())
    one = kept.filter("doc_id is null and n_shingles > 0").select(F.col("sha").alias("__sha"))
    blank = kept.filter("doc_id is null and n_shingles = 0").select(F.col("sha").alias("__sha"))
    return (named
            .unionByName(nameless.join(one, "__sha", "left_semi").dropDuplicates(["__sha"])
                         .select(*docs.columns))
            .unionByName(nameless.join(blank, "__sha", "left_semi").select(*docs.columns))
            .coalesce(files))
