"""Substring de-duplication by recompression (operator 4).

Every window of ``WINDOW`` words that starts earlier elsewhere (smaller doc_id, or the
same document, earlier start) has its words removed; windows are judged on the input.

1. *Long repeats.* After ``HIGH`` rounds (see ``recompress``) the symbols stand for some
   twenty words each. Symbols that occur again are matched with their first occurrence;
   consecutive symbols whose first occurrences are consecutive too form a stretch that
   is known to repeat, and its windows are settled without being looked at singly.
2. *What can repeat.* Of every window not settled, the symbols after ``MID`` rounds that do
   not depend on its surroundings occur again if the window does. One of them is looked
   up, the one with the most words: windows for which it occurs only once are unique.
3. *The rest* - the first occurrences, the borders of long repeats and windows with no
   sure symbol - are matched by the 128-bit name of the window itself.

Each step is a join of names that are only aggregated by minimum and count, so a passage
in a third of all documents is folded before it is shuffled; equal windows met in one
batch are settled on the spot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukline.llm import recompress as rc
from soukline.llm.common import drop_stored, file_count, map_arrow, stored, text_or_empty

WINDOW = 20
HIGH, MID = 11, 4
BATCH_BYTES = 2 << 20
NO_ID = (1 << 63) - 1


def _codes(doc_id: np.ndarray, print_: np.ndarray, at: np.ndarray) -> pa.Array:
    """Order codes (doc_id, position, 31 bits of the text's print) as 126-bit decimals."""
    did = doc_id.astype(np.uint64) + np.uint64(1 << 63)
    low = ((did & np.uint64(3)) << np.uint64(62)) | (at.astype(np.uint64) << np.uint64(31)) \
        | (print_.astype(np.uint64) & np.uint64(0x7FFFFFFF))
    pairs = np.column_stack([low, did >> np.uint64(2)])
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(at),
                                 [None, pa.py_buffer(np.ascontiguousarray(pairs))])


def _uncoded(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document part, position) of order codes; equal document parts mean one text."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    raw = np.frombuffer(codes.buffers()[1], dtype=np.uint64).reshape(-1, 2)
    raw = raw[codes.offset:codes.offset + len(codes)]
    doc = np.column_stack([raw[:, 1], raw[:, 0] & np.uint64((3 << 62) | 0x7FFFFFFF)])
    return doc, ((raw[:, 0] >> np.uint64(31)) & np.uint64(0x7FFFFFFF)).astype(np.int64)


def _numbers(col, dtype=np.int64) -> np.ndarray:
    return np.asarray(col.to_numpy(zero_copy_only=False), dtype=dtype)


def _slices(batch: pa.RecordBatch):
    """(part of the batch, its texts as bytes), cut by size."""
    texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_BYTES:
            yield batch.slice(lo, i + 1 - lo), texts[lo:i + 1]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield batch.slice(lo), texts[lo:]


def _high_symbols(batches):
    cutter = rc.WordCutter()
    for batch in batches:
        for part, texts in _slices(batch):
            w = cutter.cut(texts)
            p = rc.parse(rc.lanes(w.name, 2), w.doc, HIGH, cores=False)
            bounds = w.doc_bounds(len(texts))
            span = np.diff(np.append(p.start, len(w.doc)))
            ids, prints = _numbers(part.column("did"))[p.doc], _numbers(part.column("print"))[p.doc]
            at = p.start - bounds[p.doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.name[:, 0].view(np.int64)), pa.array(p.name[:, 1].view(np.int64)),
                 _codes(ids, prints, at), pa.array(ids), pa.array(prints),
                 pa.array(at, pa.int32()), pa.array(span, pa.int32())],
                names=["n0", "n1", "code", "did", "print", "at", "span"])


def _stretches(repeats: list | None) -> list[tuple[int, int]]:
    """Word ranges of at least WINDOW words that repeat an earlier stretch.

    ``repeats``: (position, span, first document, first position) of symbols that have
    an earlier occurrence."""
    out, run = [], None
    for at, span, doc, first in sorted(set(repeats or [])):
        if run and (at, doc, first) == (run[1], run[2], run[3]):
            run[1], run[3] = at + span, first + span
        else:
            if run and run[1] - run[0] >= WINDOW:
                out.append((run[0], run[1]))
            run = [at, at + span, doc, first + span]
    if run and run[1] - run[0] >= WINDOW:
        out.append((run[0], run[1]))
    return out


def _settled(part: pa.RecordBatch) -> list[list[tuple[int, int]]]:
    col = part.column("repeats")
    flat, lists = col.flatten(), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if not len(flat):
        return [[] for _ in lists]
    doc, first = _uncoded(flat.field("first"))
    doc = [d.tobytes() for d in doc]
    rows = list(zip(flat.field("at").to_pylist(), flat.field("span").to_pylist(), doc,
                    first.tolist()))
    out, lo = [], 0
    for n in lists:
        out.append(_stretches(rows[lo:lo + int(n)]))
        lo += int(n)
    return out


def _windows(w: rc.Words, p: rc.Parse, settled, bounds):
    """Starts of the windows not settled, and their sure symbols first .. last."""
    n = len(w.doc) - WINDOW + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    open_ = w.doc[:n] == w.doc[WINDOW - 1:]
    for d, ranges in enumerate(settled):
        for a, b in ranges:
            open_[bounds[d] + a:bounds[d] + b - WINDOW + 1] = False
    at = np.flatnonzero(open_)
    return at, p.first[at], p.last[at + WINDOW - 1]


def _open_keys(w: rc.Words, settled, bounds):
    """Starts of the windows not settled, the key of the rarest sure symbol of each (0
    where no symbol is sure), and the parse."""
    p = rc.parse(rc.lanes(w.name, 1), w.doc, MID)
    at, first, last = _windows(w, p, settled, bounds)
    key = np.zeros(len(at), dtype=np.uint64)
    sure = first <= last
    key[sure] = rc.rarest(rc.keys(p, len(w.doc)), first[sure], last[sure])
    return at, key, p


def _in_doc(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One number for a key in a document of the batch."""
    return rc.mix(key ^ rc.mix(doc.astype(np.uint64) + rc.K1))


def _among(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which ``x`` are among the sorted ``found``."""
    if not len(found):
        return np.zeros(len(x), dtype=bool)
    return found[np.minimum(np.searchsorted(found, x), len(found) - 1)] == x


def _mid_symbols(batches):
    """(key, document) of the symbols that decide about the windows not settled."""
    cutter = rc.WordCutter()
    for batch in batches:
        for part, texts in _slices(batch):
            w = cutter.cut(texts)
            at, key, p = _open_keys(w, _settled(part), w.doc_bounds(len(texts)))
            at, key = at[key > 0], key[key > 0]
            doc = w.doc[at]
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, doc = key[new], doc[new]
            # a document that has a key at two places has it twice by itself
            every = np.sort(_in_doc(rc.keys(p, len(w.doc)), p.doc))
            twice = _among(_in_doc(key, doc), every[1:][every[1:] == every[:-1]])
            doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), part.column("did").take(doc),
                 part.column("print").take(doc), pa.array(twice)],
                names=["n0", "did", "print", "twice"])


def _digests(w: rc.Words, gone: np.ndarray, bounds: np.ndarray) -> list[str]:
    """SHA-256 of every document's kept words, joined by one blank."""
    kept = np.flatnonzero(~gone)
    edge = np.zeros(len(w.data) + 1, dtype=np.int8)
    edge[w.begin[kept]] = 1
    edge[w.end[kept]] -= 1
    mask, data = np.cumsum(edge[:-1], dtype=np.int8).astype(bool), w.data.copy()
    lead = kept[1:][w.doc[kept[1:]] == w.doc[kept[:-1]]]    # all but a document's first
    blank = w.begin[lead] - 1                               # the space before the word
    mask[blank], data[blank] = True, 0x20
    out = data[mask].tobytes()
    size = np.append(0, np.cumsum(mask))
    starts = np.append(w.begin, len(w.data))[np.minimum(bounds, len(w.begin))]
    # a document's bytes run from its first word to the next document's first word
    cut = size[starts].tolist()
    return [hashlib.sha256(out[a:b]).hexdigest() for a, b in zip(cut, cut[1:])]


def _candidates(batches):
    """One row per document: final numbers, or its text and the windows still open."""
    cutter = rc.WordCutter()
    for batch in batches:
        for part, texts in _slices(batch):
            w = cutter.cut(texts)
            bounds, settled = w.doc_bounds(len(texts)), _settled(part)
            at, key, _ = _open_keys(w, settled, bounds)
            col = part.column("shared")
            sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
            shared = np.sort(_in_doc(_numbers(col.flatten()).view(np.uint64),
                                     np.repeat(np.arange(len(texts)), sizes)))
            at = at[(key == 0) | _among(_in_doc(key, w.doc[at]), shared)]
            names = rc.window_names(w.name, at, WINDOW)
            ids, prints = _numbers(part.column("did")), _numbers(part.column("print"))
            # equal windows met in this batch: all but the first are settled now
            doc = w.doc[at]
            order = np.lexsort((prints[doc], at - bounds[doc], ids[doc], names[:, 1], names[:, 0]))
            s = names[order]
            same = np.zeros(len(at), dtype=bool)
            same[1:] = (s[1:] == s[:-1]).all(1)
            # identical rows are one document: their windows are not earlier than each other
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
            pos = (at - bounds[doc])[order]
            by = np.column_stack([ids[doc][order], pos, prints[doc][order]])
            later = same & (by != by[head]).any(1)
            here = at[order][later]
            keep = np.sort(order[~later])
            at, names, doc = at[keep], names[keep], doc[keep]
            removed = np.zeros(len(w.doc) + 1, dtype=np.int64)
            np.add.at(removed, here, 1)
            np.add.at(removed, here + WINDOW, -1)
            gone = np.cumsum(removed[:-1]) > 0
            for d, ranges in enumerate(settled):
                for a, b in ranges:
                    gone[bounds[d] + a:bounds[d] + b] = True
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            digest = _digests(w, gone, bounds)
            rows = []
            for d in range(len(texts)):
                lo, hi = int(bounds[d]), int(bounds[d + 1])
                a, b = cut[d], cut[d + 1]
                if a == b:
                    rows.append((hi - lo, int(gone[lo:hi].sum()), digest[d],
                                 None, None, None, None))
                else:
                    rows.append((hi - lo, None, None, texts[d],
                                 np.packbits(gone[lo:hi]).tobytes(),
                                 (at[a:b] - lo).astype(np.int32).tobytes(),
                                 names[a:b].tobytes()))
            c = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("did"), part.column("print"),
                 *(pa.array(x, k) for x, k in zip(c, kinds))],
                names=["doc_id", "did", "print", "n_words", "n_removed", "kept_sha256",
                       "words", "gone", "starts", "names"])


def _flat_windows(batches):
    for b in batches:
        for lo in range(0, len(b), 256):
            part = b.slice(lo, 256)
            at = [np.frombuffer(x, dtype=np.int32) for x in part.column("starts").to_pylist()]
            if not at:
                continue
            sizes = [len(x) for x in at]
            names = np.concatenate([np.frombuffer(x, dtype=np.int64).reshape(-1, 2)
                                    for x in part.column("names").to_pylist()])
            did = np.repeat(_numbers(part.column("did")), sizes)
            prints = np.repeat(_numbers(part.column("print")), sizes)
            at = np.concatenate(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[:, 0]), pa.array(names[:, 1]), _codes(did, prints, at),
                 pa.array(did), pa.array(prints), pa.array(at, pa.int32())],
                names=["n0", "n1", "code", "did", "print", "at"])


def _finished(batches):
    cutter = rc.WordCutter()
    for b in batches:
        for lo in range(0, len(b), 256):
            part = b.slice(lo, 256)
            texts = part.column("words").to_pylist()
            w = cutter.cut(texts)
            bounds = w.doc_bounds(len(texts))
            gone = np.zeros(len(w.doc), dtype=bool)
            counts = []
            for d, (bits, later) in enumerate(zip(part.column("gone").to_pylist(),
                                                  part.column("later").to_pylist())):
                lo_, hi = int(bounds[d]), int(bounds[d + 1])
                gone[lo_:hi] = np.unpackbits(np.frombuffer(bits, np.uint8),
                                             count=hi - lo_).astype(bool)
                for a in later or []:
                    gone[lo_ + a:lo_ + a + WINDOW] = True
                counts.append(int(gone[lo_:hi].sum()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_words"), pa.array(counts, pa.int64()),
                 pa.array(_digests(w, gone, bounds), pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _later(rows: DataFrame, names: list[str], values: list[str], files: int) -> DataFrame:
    """Occurrences that are not the first of their name: ``values`` and ``first``.

    The first occurrences are stored, so that the join has a plain shuffle on both sides,
    which adaptive execution can split where one name has very many occurrences."""
    first = stored(rows.groupBy(*names)
                   .agg(F.min("code").alias("first"), F.max("code").alias("end"))
                   .filter("first != end").select(*names, "first"), "substring-first", files)
    return rows.join(first, names).filter("code != first").select(*values, "first")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Counts and digest of what is kept: ``doc_id, n_words, n_removed, kept_sha256``.

    Needs ``doc_id`` and ``text``; other columns are ignored. One row per input row.

    Defined cases: a null or empty text has no words and the digest of the empty string;
    a null doc_id ranks after all others; identical rows are one document written twice
    and get the same result; different texts under one doc_id are ordered start by start,
    then by a hash of the text; texts with fewer than ``WINDOW`` words keep everything;
    an empty table gives no rows.
    """
    key = ["did", "print"]
    files = file_count(docs)
    text = text_or_empty()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
                        F.xxhash64(text).alias("print"), text.alias("text"))
    named = "n0 long, n1 long, code decimal(38,0), did long, print long, at int"
    high = stored(map_arrow(keyed, _high_symbols, f"{named}, span int"), "substring-high", files)
    repeats = stored(_later(high, ["n0", "n1"], [*key, "at", "span"], files).groupBy(*key).agg(
        F.collect_list(F.struct("at", "span", "first")).alias("repeats")), "substring-repeats",
        files)
    drop_stored(high)
    marked = keyed.join(repeats, key, "left")
    mid = stored(map_arrow(marked.coalesce(files), _mid_symbols,
                           "n0 long, did long, print long, twice boolean"), "substring-mid")
    again = stored(mid.groupBy("n0")
                   .agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n"))
                   .filter("n > 1").select("n0"), "substring-again", files)
    shared = stored(mid.join(again, "n0").groupBy(*key).agg(
        F.collect_list("n0").alias("shared")), "substring-shared", files)
    drop_stored(mid)
    rows = stored(map_arrow(
        marked.join(shared, key, "left").coalesce(files), _candidates,
        "doc_id long, did long, print long, n_words long, n_removed long, kept_sha256 string,"
        " words binary, gone binary, starts binary, names binary"), "substring-rows")
    drop_stored(shared)
    drop_stored(repeats)
    open_ = rows.filter("starts IS NOT NULL")
    windows = stored(map_arrow(open_.select(*key, "starts", "names"), _flat_windows, named),
                     "substring-windows", files)
    later = stored(_later(windows, ["n0", "n1"], [*key, "at"], files).groupBy(*key).agg(
        F.collect_set("at").alias("later")), "substring-later", files)
    drop_stored(windows)
    out = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    ends = map_arrow(open_.join(later, key, "left").coalesce(files), _finished,
                     "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return rows.filter("starts IS NULL").select(*out).unionByName(ends)
