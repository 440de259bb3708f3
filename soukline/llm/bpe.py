"""Byte-pair encoding and decoding through distinct-word tables (operator 9).

Merges never cross the border between a non-space character and a following space, so a
text is the sequence of its *words* (a word here carries the white space before it) and
its ids are the words' ids in order. Each task keeps a table of the distinct words it
has met: a word is encoded once, and the ids are joined back by position. Decoding is the
lookup of every id in the id-to-piece table (one row per vocabulary entry, a fixed size).

The word table is kept per task here; ``bpe_table`` has one table for the corpus, whose words
are joined back chunk by chunk.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soukline.llm.common import map_arrow, text_or_empty

WORDS = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
# white space other than \t-\r and the blank; such texts are cut with more care
OTHER_SPACE = re.compile(r"[^\S\t-\r ]")
SAFE_CUT = re.compile(r"(?<=\S)(?=[\t-\r ])")
TABLE_ENTRIES = 200_000     # of one task's word table; beyond, it starts anew (memory only)


def split_words(text: str) -> list[str]:
    if OTHER_SPACE.search(text):
        return SAFE_CUT.split(text)
    return WORDS.findall(text)


def default_vocabulary() -> str:
    from public_tokenizers import path
    return path("byte_bpe_50k.json")


def vocabulary_text(path: str | None = None) -> str:
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return f.read()


def _tokenizer(vocabulary: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(vocabulary)
    tok.no_truncation()
    tok.no_padding()
    return tok


# letters below have had one class in all Unicode versions, so that both libraries split
# words of them alike
PLAIN = "\u0370"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")


def _ranked(spec: dict, table: list[bytes]):
    """The vocabulary as an encoder by ranks, which takes a seventh of the time, if its
    settings mean the same there: plain byte-level splits, and merges in id order."""
    import tiktoken
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    merged = [spec["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))]
              for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if (spec["normalizer"] or not special or merged != sorted(set(merged))
            or any(spec["pre_tokenizer"].get(k) != v for k, v in plain.items())):
        return None
    ranks = {p: i for i, p in enumerate(table) if i not in special.values()}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


class WordTable:
    """word -> ids, each distinct word encoded once; the ids of all words stand in one
    array, a word being a stretch of it."""

    JOINED = 2_000      # words encoded in one call

    def __init__(self, vocabulary: str):
        spec, self.vocabulary, self.tok = json.loads(vocabulary), vocabulary, None
        self.ranked = _ranked(spec, pieces(vocabulary))
        # a special token cuts a text, so words joined by it are encoded one by one
        self.cut = next(((t["content"], t["id"]) for t in spec["added_tokens"]), None)
        self.clear()

    def clear(self) -> None:
        self.at, self.used = {}, 0
        self.flat = np.empty(1 << 16, dtype=np.int32)
        self.first, self.size = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def _append(self, words: list[str], ids: np.ndarray, first: np.ndarray,
                size: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.first.append(first + self.used)
        self.size.append(size)
        self.at.update(zip(words, range(len(self.at), len(self.at) + len(words))))
        self.used += len(ids)

    def _learn(self, words: list[str]) -> None:
        simple, other = [], []
        for w in words:
            ok = self.ranked is not None and max(w) < PLAIN and self.cut[0] not in w
            (simple if ok else other).append(w)
        for lo in range(0, len(simple), self.JOINED):
            part = simple[lo:lo + self.JOINED]
            ids = np.array(self.ranked.encode(self.cut[0].join(part),
                                              allowed_special={self.cut[0]}), dtype=np.int32)
            ends = np.append(np.flatnonzero(ids == self.cut[1]), len(ids))
            first = np.append(0, ends[:-1] + 1)
            self._append(part, ids, first, ends - first)
        if other and self.tok is None:      # made when a word needs it: it is large
            self.tok = _tokenizer(self.vocabulary)
        for lo in range(0, len(other), self.JOINED):
            part = other[lo:lo + self.JOINED]
            found = [e.ids for e in self.tok.encode_batch(part, add_special_tokens=False)]
            size = np.array(list(map(len, found)))
            ids = np.array(list(chain.from_iterable(found)), dtype=np.int32)
            self._append(part, ids, np.cumsum(size) - size, size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each."""
        docs = [split_words(t) for t in texts]
        words = list(chain.from_iterable(docs))
        new = set(words) - self.at.keys()
        if self.at and len(self.at) + len(new) > TABLE_ENTRIES:
            self.clear()
            new = set(words)
        self._learn(sorted(new))
        self.first, self.size = [np.concatenate(self.first)], [np.concatenate(self.size)]
        at = np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))
        size = self.size[0][at]
        stop = np.cumsum(size)
        where = np.repeat(self.first[0][at] - stop + size, size) + np.arange(size.sum())
        ends = np.append(0, stop)[np.cumsum([0, *map(len, docs)])]
        return self.flat[where], np.diff(ends)


def _slices(texts: list[str], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text",
           out: str = "ids") -> DataFrame:
    """Replace the column ``text`` by ``out``, the array of its token ids.

    Ids are those of the tokenizers library for the vocabulary file ``vocabulary`` with
    add_special_tokens=False; a special token's string in a text is that token. Null
    counts as empty and has no ids; all other columns and all rows are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))
    rest = [c for c in docs.columns if c not in (text, out)]
    src = docs.select(*rest, text_or_empty(text).alias("__text"))
    schema = src.select(*rest).schema.add(out, T.ArrayType(T.IntegerType()))
    return map_arrow(src, _encoding(shared, rest, out), schema)


def _encoding(shared, rest: list[str], out: str):
    """Batches with ``__text`` -> batches with the ids in its place."""
    def run(batches):
        words = WordTable(shared.value)
        for b in batches:
            texts = b.column("__text").to_pylist()
            for lo, hi in _slices(texts):
                ids, sizes = words.encode(texts[lo:hi])
                offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                col = pa.ListArray.from_arrays(offsets, pa.array(ids))
                kept = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [kept.column(c) for c in rest] + [col], names=[*rest, out])
    return run


def _parts(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` ids together."""
    lo = total = 0
    for i, n in enumerate(sizes.tolist()):
        total += n
        if total >= most:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def pieces(vocabulary: str) -> list[bytes]:
    """The id-to-piece table: the bytes of every id of a byte-level vocabulary."""
    spec = json.loads(vocabulary)
    # byte-level files write the printable bytes as themselves and the others from U+0100 up
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown}
    back.update({chr(256 + i): b for i, b in enumerate(
        b for b in range(256) if b not in set(shown))})
    table = {i: bytes(back[c] for c in p) for p, i in spec["model"]["vocab"].items()}
    table.update({t["id"]: t["content"].encode() for t in spec["added_tokens"]})
    return [table.get(i, b"") for i in range(max(table) + 1)]


def decode(encoded: DataFrame, vocabulary: str | None = None, ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """Add ``out``, the text of the token ids (null ids: empty); other columns are kept.

    Like the tokenizers library's decode with skip_special_tokens=False; bytes that are no
    UTF-8 become U+FFFD. An id outside the vocabulary has no piece.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))
    rest = [c for c in encoded.columns if c != out]
    schema = encoded.select(*rest).schema.add(out, T.StringType())
    return map_arrow(encoded.select(*rest), _decoding(shared, rest, ids, out), schema)


def _decoding(shared, rest: list[str], ids: str, out: str):
    """Batches with ids -> the same batches with their text besides."""
    def run(batches):
        table = pieces(shared.value)
        data = np.frombuffer(b"".join(table), dtype=np.uint8)
        size = np.array([*map(len, table), 0], dtype=np.int64)  # the last: no piece
        first = np.cumsum(size) - size
        for b in batches:
            n = b.column(ids).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi in _parts(n):
                part = b.slice(lo, hi - lo)
                flat = part.column(ids).flatten().to_numpy(zero_copy_only=False)
                flat = np.where((flat >= 0) & (flat < len(table)), flat, len(table))
                stop = np.cumsum(size[flat])
                where = np.repeat(first[flat] - stop + size[flat], size[flat])
                text = data[where + np.arange(len(where))].tobytes()
                ends = np.append(0, stop)[np.append(0, np.cumsum(n[lo:hi]))].tolist()
                out_ = [text[x:y].decode("utf-8", "replace") for x, y in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in rest] + [pa.array(out_, pa.string())],
                    names=[*rest, out])
    return run


def round_trip(docs: DataFrame, vocabulary: str | None = None, text: str = "text",
               ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encode``, then ``decode``, batch after batch in one Python worker per task: chained
    as two plans they hold two workers, and the ids go through the executor in between."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))
    rest = [c for c in docs.columns if c not in (text, ids, out)]
    src = docs.select(*rest, text_or_empty(text).alias("__text"))
    schema = src.select(*rest).schema.add(ids, T.ArrayType(T.IntegerType())).add(
        out, T.StringType())
    encoding, decoding = _encoding(shared, rest, ids), _decoding(shared, [*rest, ids], ids, out)
    return map_arrow(src, lambda batches: decoding(encoding(batches)), schema)


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (null ids and empty texts
    have no tokens and the digest of the empty string)."""
    rows = round_trip(docs.select("doc_id", "text"), vocabulary)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
