"""Locally consistent parsing of word sequences by recompression rounds.

A *round* rewrites a symbol sequence: the run round names maximal runs of one word, a pair
round names every neighbouring pair whose left symbol falls in the left half and whose
right symbol in the right half of the alphabet (a bit of the symbol's name decides). A
name is a hash of the names it is made from, so all tasks give equal content equal names
without exchanging a dictionary. Only the outermost symbols of a stretch can depend on
what stands beside it; all others are the same in each copy of the stretch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KEYS = K0, K1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """The words of a batch of texts: byte range, document and 64-bit name of each."""
    data: np.ndarray        # all bytes, a line feed after each text
    begin: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    name: np.ndarray

    def doc_bounds(self, n_docs: int) -> np.ndarray:
        """First word of every document, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(n_docs + 1))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.bases = (base, pow(base, -1, 1 << 64))
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def sums(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Polynomial hashes of the stretches ``x[begin:end]``."""
        if len(self.up) < len(x) + 1:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate(
                    [np.ones(1, np.uint64), np.full(len(x), b, dtype=np.uint64)]))
                for b in self.bases)
        total = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(x * self.up[:len(x)], out=total[1:])
        return (total[end] - total[begin]) * self.down[begin]


PIECE = 256
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)    # n bytes of a block


def word_names(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the words ``data[begin:end]`` (``data`` has 8 bytes after the last).

    Eight bytes at a time are mixed into the name, all words side by side. Each step is a
    bijection of the name and of the bytes, and none is linear: words of at most eight
    bytes, and words that differ in one eight-byte block, never share a name; others do
    with probability 2^-64, whatever their letters repeat. Long words are named in pieces of
    ``PIECE`` bytes, and then by the names of their pieces."""
    long = np.flatnonzero(end - begin > PIECE)
    if len(long):
        short = np.flatnonzero(end - begin <= PIECE)
        name = np.empty(len(begin), dtype=np.uint64)
        name[short] = word_names(data, begin[short], end[short])
        n = -(-(end[long] - begin[long]) // PIECE)
        bounds = np.append(0, np.cumsum(n))
        at = begin[long].repeat(n) + PIECE * (np.arange(bounds[-1]) - bounds[:-1].repeat(n))
        pieces = word_names(data, at, np.minimum(at + PIECE, end[long].repeat(n)))
        packed = np.append(pieces, np.uint64(0)).view(np.uint8)
        name[long] = mix(word_names(packed, 8 * bounds[:-1], 8 * bounds[1:])
                         ^ (end[long] - begin[long]).astype(np.uint64) * K1)
        return name
    blocks = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    size = end - begin
    name = mix(np.arange(PIECE + 1, dtype=np.uint64) * K0 + K1)[size]
    open_ = slice(None) if size.all() else np.flatnonzero(size)
    for at in range(0, int(size.max(initial=0)), 8):
        if at:
            open_ = np.flatnonzero(size > 8) if at == 8 else open_[size[open_] > at]
        part = blocks[begin[open_] + at] & FIRST[np.minimum(size[open_] - at, 8)]
        name[open_] = mix(name[open_] ^ part) + K0
    return name


class WordCutter:
    """Cuts texts into words ``[^\\x20\\x09-\\x0D]+`` and names them, on whole batches at a
    time."""

    def __init__(self):
        self.word = np.ones(256, dtype=bool)
        self.word[[0x20, *range(0x09, 0x0E)]] = False

    def cut(self, texts: list[bytes]) -> Words:
        padded = np.frombuffer(b"\n".join(texts) + b"\n" * 9, dtype=np.uint8)
        data = padded[:-8]
        word = self.word[data]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edge = np.append(0, edge)
        begin, end = edge[::2].copy(), edge[1::2].copy()     # the last byte is a line feed
        stops = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        doc = np.arange(len(texts)).repeat(np.diff(np.searchsorted(begin, stops), prepend=0))
        return Words(data, begin, end, doc, word_names(padded, begin, end))


@dataclass
class Parse:
    """Symbols of a batch of documents after some rounds.

    ``name`` (symbols x lanes of 64 bits), ``start`` and ``doc`` (first word and document of
    a symbol); ``first[p]`` / ``last[p]``: the outermost symbols that a stretch starting / ending at
    word p is sure to share with its copies.
    """
    name: np.ndarray
    start: np.ndarray
    doc: np.ndarray
    first: np.ndarray | None
    last: np.ndarray | None


def parse_words(name: np.ndarray, doc: np.ndarray, cores: bool) -> Parse:
    at = np.arange(len(doc), dtype=np.int64)
    return Parse(name, at, doc, at if cores else None, at if cores else None)


def _rewritten(p: Parse, head: np.ndarray, name: np.ndarray, first: np.ndarray,
               last: np.ndarray) -> Parse:
    """Keep the symbols marked ``head`` (each swallows what follows up to the next)."""
    if first is None:
        return Parse(name[head], p.start[head], p.doc[head], None, None)
    new = np.cumsum(head) - 1
    end = np.append(new, len(head) and new[-1] + 1)     # one past the last symbol
    return Parse(name[head], p.start[head], p.doc[head], end[first],
                 np.where(last < 0, -1, new[np.maximum(last, 0)]))


def run_round(p: Parse) -> Parse:
    """Name maximal runs; the run a stretch is cut in may be longer outside it."""
    n = len(p.doc)
    if not n:
        return p
    same = np.zeros(n, dtype=bool)
    same[1:] = (p.name[1:] == p.name[:-1]).all(1) & (p.doc[1:] == p.doc[:-1])
    head = ~same
    heads = np.flatnonzero(head)
    length = np.diff(np.append(heads, n)).astype(np.uint64)
    name = p.name.copy()
    many = length > 1
    at = heads[many]
    for lane, k in zip(range(name.shape[1]), KEYS):
        name[at, lane] = mix(p.name[at, lane] * k + length[many])
    if p.first is None:
        return _rewritten(p, head, name, None, None)
    run = np.cumsum(head) - 1
    after = np.append(heads, n)[run + 1]                # first word of the next run
    return _rewritten(p, head, name, after[p.first], heads[run[p.last]] - 1)


def pair_round(p: Parse, level: int) -> Parse:
    """Name the pairs (left half, right half) of neighbouring symbols of a document."""
    n = len(p.doc)
    if not n:
        return p
    salt = np.uint64(level * int(K1) & 0xFFFFFFFFFFFFFFFF)
    right = (mix(p.name[:, 0] + salt) & np.uint64(1)).astype(bool)
    tail = np.zeros(n, dtype=bool)
    tail[1:] = ~right[:-1] & right[1:] & (p.doc[1:] == p.doc[:-1])
    name = p.name.copy()
    at = np.flatnonzero(tail)
    for lane, k in zip(range(name.shape[1]), KEYS):
        name[at - 1, lane] = mix(p.name[at - 1, lane] * k + p.name[at, lane])
    if p.first is None:
        return _rewritten(p, ~tail, name, None, None)
    edge = np.append(right, False)
    first = p.first + edge[p.first]
    last = np.where(p.last < 0, -1, p.last - ~right[p.last])
    return _rewritten(p, ~tail, name, np.minimum(first, n), last)


def lanes(name: np.ndarray, n: int) -> np.ndarray:
    """``n`` lanes of symbol names from 64-bit word names."""
    return np.column_stack([name if i == 0 else mix(name + KEYS[i]) for i in range(n)])


def parse(name: np.ndarray, doc: np.ndarray, rounds: int, cores: bool = True) -> Parse:
    """All rounds over names of any number of lanes; without ``cores`` the sure symbols of
    stretches are not followed."""
    p = run_round(parse_words(name, doc, cores))
    for level in range(1, rounds + 1):
        p = pair_round(p, level)
    return p


WINDOW_POWERS = tuple(Powers(b) for b in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5))


def window_names(name: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """128-bit names of the windows of ``width`` words that start at ``at``."""
    out = np.empty((len(at), 2), dtype=np.uint64)
    for lane, powers in enumerate(WINDOW_POWERS):
        out[:, lane] = mix(powers.sums(mix(name + KEYS[lane]), at, at + width))
    return out


def keys(p: Parse, n_words: int) -> np.ndarray:
    """Span and name of every symbol in 64 bits; symbols of more words are larger."""
    span = np.diff(np.append(p.start, n_words)).astype(np.uint64)
    return (np.minimum(span, np.uint64(1023)) << np.uint64(54)) | (p.name[:, 0] >> np.uint64(10))


def rarest(key: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The largest key of the symbols first .. last of every stretch."""
    size = last - first + 1
    best = np.zeros(len(size), dtype=np.uint64)
    table, width = key, 1               # maxima of all stretches of 1, 2, 4, .. symbols
    while len(size) and width <= size.max():
        mine = np.flatnonzero((size >= width) & (size < 2 * width))
        best[mine] = np.maximum(table[first[mine]], table[last[mine] - width + 1])
        table, width = np.maximum(table[:-width], table[width:]), 2 * width
    return best
