"""Byte-pair encoding with one table of distinct words for the corpus (operator 9).

1. *Split.* Texts are dealt into chunks of about ``CHUNK_BYTES``; a chunk lists each of its
   distinct words once (a word carries the white space before it, see ``bpe``) and deals
   them by hash to the places of the table.
2. *Encode.* A place holds all occurrences of its words in chunks, and encodes each distinct
   word once: no word of the corpus is encoded twice.
3. *Join back.* A place answers every chunk with the ids of its words in the order they were
   listed; the chunk, joined by its number, puts them at the words' positions.

Decoding is ``bpe.decode``, the lookup of every id in the id-to-piece table.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soukline.llm.bpe import WordTable, decode, split_words, vocabulary_text
from soukline.llm.common import stored, text_or_empty

CHUNK_BYTES = 8 << 20


def _listed(texts: list[str], places: int):
    """The words of all texts in order, the distinct ones sorted, and the place of each."""
    docs = [split_words(t) for t in texts]
    words = sorted(set(chain.from_iterable(docs)))
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    place = np.fromiter((zlib.crc32(r) for r in raw), np.int64, len(raw)) % places
    return docs, words, raw, place


def _per_place(place: np.ndarray):
    """(place, indices of its words in ascending order)."""
    order = np.argsort(place, kind="stable")
    cut = np.flatnonzero(np.diff(place[order], prepend=-1))
    return zip(place[order[cut]].tolist(), np.split(order, cut[1:])) if len(order) else ()


def _ask(places: int):
    def run(rows: pa.Table) -> pa.Table:
        _, _, raw, place = _listed(rows.column("__text").to_pylist(), places)
        out = [(p, b"".join([raw[i] for i in mine.tolist()]),
                np.array([len(raw[i]) for i in mine.tolist()], np.int32).tobytes())
               for p, mine in _per_place(place)]
        chunk = rows.column("__chunk")[0].as_py()
        return pa.table([pa.array([p for p, _, _ in out], pa.int32()),
                         pa.array([chunk] * len(out), pa.int32()),
                         pa.array([w for _, w, _ in out], pa.binary()),
                         pa.array([s for _, _, s in out], pa.binary())],
                        names=["place", "chunk", "words", "sizes"])
    return run


def _learn(shared):
    """Encode the distinct words of a place, and answer each chunk in its order."""
    def run(rows: pa.Table) -> pa.Table:
        lists = []
        for words, sizes in zip(rows.column("words").to_pylist(), rows.column("sizes").to_pylist()):
            end = np.cumsum(np.frombuffer(sizes, np.int32).astype(np.int64))
            at = np.append(0, end).tolist()
            lists.append([words[a:b] for a, b in zip(at, at[1:])])
        distinct = sorted(set(chain.from_iterable(lists)))
        table = WordTable(shared.value)
        text = [w.decode("utf-8", "surrogatepass") for w in distinct]
        table._learn(text)
        first, size = np.concatenate(table.first), np.concatenate(table.size)
        # the table numbers words in the order it learnt them
        number = dict(zip(distinct, map(table.at.__getitem__, text)))
        out = []
        for words in lists:
            at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            n = size[at]
            where = np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
            out.append((n.astype(np.int32).tobytes(), table.flat[where].tobytes()))
        return pa.table([rows.column("chunk"), rows.column("place"),
                         pa.array([n for n, _ in out], pa.binary()),
                         pa.array([i for _, i in out], pa.binary())],
                        names=["chunk", "place", "sizes", "ids"])
    return run


def _placed(places: int, rest: list[str], out: str):
    """The ids of a chunk's texts from the answers of all places."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        docs, words, _, place = _listed(rows.column("__text").to_pylist(), places)
        told = {p: (n, i) for p, n, i in zip(*(answers.column(c).to_pylist()
                                               for c in ("place", "sizes", "ids")))}
        size, first = (np.zeros(len(words), np.int64) for _ in range(2))
        flat, used = [np.empty(0, np.int32)], 0
        for p, mine in _per_place(place):
            n = np.frombuffer(told[p][0], np.int32).astype(np.int64)
            size[mine], first[mine] = n, used + np.cumsum(n) - n
            flat.append(np.frombuffer(told[p][1], np.int32))
            used += len(flat[-1])
        flat, number = np.concatenate(flat), {w: k for k, w in enumerate(words)}
        total = sum(map(len, docs))
        at = np.fromiter(map(number.__getitem__, chain.from_iterable(docs)), np.int64, total)
        n = size[at]
        stop = np.cumsum(n)
        where = np.repeat(first[at] - stop + n, n) + np.arange(n.sum())
        ends = np.append(0, stop)[np.cumsum([0, *map(len, docs)])]
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[where]))
        return pa.table([*(rows.column(c) for c in rest), ids], names=[*rest, out])
    return run


def encode_by_table(docs: DataFrame, vocabulary: str | None = None, text: str = "text",
                    out: str = "ids", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Replace the column ``text`` by ``out``, the array of its token ids (as ``bpe.encode``).

    Defined cases: null counts as empty and has no ids; all rows and all other columns are
    kept, rows that repeat each get their ids (such rows meet in one chunk); a special
    token's string in a text is that token; very long texts are encoded whole, a chunk being
    at least as large as its longest text; an empty table gives no rows. There are no ties.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))
    rest = [c for c in docs.columns if c not in (text, out)]
    src = docs.select(*rest, text_or_empty(text).alias("__text"))
    size = src.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    src = src.withColumn("__chunk", F.pmod(F.xxhash64(*rest, "__text"), F.lit(chunks)).cast("int"))
    asked = src.select("__chunk", "__text").groupBy("__chunk").applyInArrow(
        _ask(chunks), "place int, chunk int, words binary, sizes binary")
    answers = stored(asked.groupBy("place").applyInArrow(
        _learn(shared), "chunk int, place int, sizes binary, ids binary"), "bpe-table")
    schema = src.select(*rest).schema.add(out, T.ArrayType(T.IntegerType()))
    return src.groupBy("__chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _placed(chunks, rest, out), schema)


def table_digests(docs: DataFrame, vocabulary: str | None = None,
                  chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (null ids are kept; empty
    texts have no tokens and the digest of the empty string)."""
    rows = decode(encode_by_table(docs.select("doc_id", "text"), vocabulary,
                                  chunk_bytes=chunk_bytes), vocabulary)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
