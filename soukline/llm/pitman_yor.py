"""Language-model scoring with a hierarchical Pitman-Yor model (operator 6).

A token is drawn from the restaurant of its context (the word before it, or the start of
the text); all context restaurants share the unigram restaurant as their parent, whose base
is uniform over the types. Seating is sampled by Gibbs sweeps: in a sweep every dish of
every restaurant has its customers seated anew, given the other dishes' tables of the sweep
before. The predictive probabilities of the seatings after the first ``BURN`` sweeps are
averaged.

Pairs (context, word) are counted in each batch and dealt by the word into buckets whose
number follows the size of the input; the pairs of a frequent word are dealt by word and
context. A bucket is one row of packed arrays with the dishes of its pairs. The totals of
contexts and of words are tables too, dealt by key to owners: before a sweep every bucket
reports the tables of its contexts and words, each combined to one number, and the owners
send the sums back. Only sums over all restaurants pass through the driver.

For scoring, texts are dealt into chunks of about ``CHUNK_BYTES``. A chunk asks the buckets
for its distinct pairs and the owners for its distinct words and contexts, each once: the
model is never sent whole to any task. Answers on pairs come in the order of the questions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukline.llm import recompress as rc
from soukline.llm.common import arrow_rows, drop_stored, map_arrow, stored, text_or_empty
from soukline.llm.gam import held_out

START, END = 0, 1           # the names of the start of a text (a context) and of its end
BURN, SAMPLES = 1, 2
CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
COMBINE = 1_900_000         # tokens that a task combines before it sends them
SAMPLE = 16                 # one text of so many is read to find the frequent words
PART = 100_000              # tokens above which a word's pairs are dealt to several buckets
WORD, CONTEXT, PAIR = 0, 1, 2
SINGLY = 24                 # customers seated one by one; further ones in growing parties
SEED = 6


def _tokens(cutter: rc.WordCutter, texts: list[bytes]):
    """Names, contexts and documents of all tokens (each text's words, then its end)."""
    w = cutter.cut(texts)
    n_docs, n = len(texts), len(w.doc)
    bounds = w.doc_bounds(n_docs)
    at = np.arange(n) + w.doc                       # one end token per text before
    ends = bounds[1:] + np.arange(n_docs)
    name = np.full(n + n_docs, END, dtype=np.uint64)
    doc = np.empty(n + n_docs, dtype=np.int64)
    name[at], doc[at], doc[ends] = w.name, w.doc, np.arange(n_docs)
    after = np.full(n + n_docs + 1, START, dtype=np.uint64)
    after[at + 1] = w.name
    context = after[:-1]
    context[bounds[:-1] + np.arange(n_docs)] = START
    return name, context, doc


def _slices(texts: list[bytes]):
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _bytes(batch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass").lower() for t in batch.column("text").to_pylist()]


def _heads(x: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal values."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return new


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[_heads(x)]


def _order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts 64-bit names, and the sorted names.

    Numbers sort several times faster than their places do, so a name's place takes its low
    bits; if the others do not tell all names apart, the places are sorted."""
    low = np.uint64((1 << len(x).bit_length()) - 1)
    key = (x & ~low) | np.arange(len(x), dtype=np.uint64)
    key.sort()
    order = (key & low).astype(np.int64)
    inorder = x[order]
    if (inorder[1:] < inorder[:-1]).any():
        order = np.argsort(x)
        inorder = x[order]
    return order, inorder


def _ranked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and the rank of each value among them."""
    order, x = _order(x)
    new = _heads(x)
    rank = np.empty(len(x), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return x[new], rank


def _place_order(place: np.ndarray, places: int) -> np.ndarray:
    """Stable order by place, 16 bits at a time (numpy sorts these by counting)."""
    order = np.argsort((place & 0xFFFF).astype(np.uint16), kind="stable")
    if places > 1 << 16:
        order = order[np.argsort((place[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _packed(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, dtype=kind).tobytes()


def _unpacked(column, kind) -> np.ndarray:
    """The arrays of all rows one after the other."""
    rows = column.to_pylist()
    return np.concatenate([np.frombuffer(r, dtype=kind) for r in rows]) if rows else \
        np.empty(0, dtype=kind)


def _by_place(places: int, place: np.ndarray, columns: list[tuple[np.ndarray, object]]):
    """Rows (place, packed columns): one per place that has an entry."""
    order = _place_order(place, places)
    cut = np.searchsorted(place[order], np.arange(places + 1))
    used = np.flatnonzero(np.diff(cut))
    parts = [(c[order], kind) for c, kind in columns]
    return [pa.array(used, pa.int32()), *(
        pa.array([_packed(x[cut[b]:cut[b + 1]], kind) for b in used], pa.binary())
        for x, kind in parts)]


class Deal:
    """Deals pairs to buckets: by the word, for frequent words by word and context."""

    def __init__(self, buckets: int, frequent=(), parts=()):
        order = np.argsort(np.asarray(frequent, dtype=np.uint64))
        self.buckets = buckets
        self.frequent = np.asarray(frequent, dtype=np.uint64)[order]
        self.parts = np.minimum(np.asarray(parts, dtype=np.uint64), np.uint64(buckets))[order]

    def __call__(self, name: np.ndarray, context: np.ndarray) -> np.ndarray:
        out, n = name % np.uint64(self.buckets), np.uint64(self.buckets)
        if len(self.frequent):
            i = _looked_up(self.frequent, name)
            hot = np.flatnonzero(i < len(self.frequent))
            out[hot] = (out[hot] + rc.mix(context[hot]) % self.parts[i[hot]]) % n
        return out.astype(np.int32)


def _owner(key: np.ndarray, owners: int) -> np.ndarray:
    return (key % np.uint64(owners)).astype(np.int32)


def _combined(parts, merge):
    """Merged parts (tuples of arrays) of about ``COMBINE`` rows: the local combine."""
    found, rows = [], 0
    for part in parts:
        found.append(part)
        rows += len(part[0])
        if rows >= COMBINE:
            yield merge(*map(np.concatenate, zip(*found)))
            found, rows = [], 0
    if found:
        yield merge(*map(np.concatenate, zip(*found)))


def _pair(name: np.ndarray, context: np.ndarray) -> np.ndarray:
    """64-bit names of pairs, as counts and questions carry them."""
    return rc.mix(name ^ rc.mix(context + rc.K1))


def _by_pair(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts pairs by name, and the first place of each pair in it."""
    order, pair = _order(pair)
    return order, np.flatnonzero(_heads(pair))


def _counted_pairs(name: np.ndarray, context: np.ndarray):
    """How often each pair occurs, in the order of the pairs' names."""
    order, head = _by_pair(_pair(name, context))
    at = order[head]
    return name[at], context[at], np.diff(np.append(head, len(order)))


def _word_counts(batches):
    """Counts of words, combined over many texts."""
    def parts():
        cutter = rc.WordCutter()
        for b in batches:
            texts = _bytes(b)
            for lo, hi in _slices(texts):
                yield np.unique(_tokens(cutter, texts[lo:hi])[0], return_counts=True)

    def merge(name, n):
        name, inverse = np.unique(name, return_inverse=True)
        return name, np.bincount(inverse, n, len(name)).astype(np.int64)

    for name, n in _combined(parts(), merge):
        yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n)],
                                         names=["name", "n"])


def dealt_by(docs: DataFrame, buckets: int) -> Deal:
    """The deal for the words of ``docs``. Which words count as frequent is estimated from
    a sample; it settles where a pair is kept, not whether."""
    if buckets == 1:
        return Deal(1)
    sample = docs.select("doc_id", text_or_empty().alias("text")).filter(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0)
    rows = (map_arrow(sample.select("text"), _word_counts, "name long, n long")
            .groupBy("name").agg((F.sum("n") * SAMPLE).alias("n"))
            .filter(F.col("n") > PART).collect())
    return Deal(buckets, np.array([r["name"] for r in rows], dtype=np.int64).view(np.uint64),
                [-(-r["n"] // PART) for r in rows])


def _counted(deal: Deal):
    """Counts of (name, context), combined over many texts."""
    def parts(batches):
        cutter = rc.WordCutter()
        for b in batches:
            texts = _bytes(b)
            for lo, hi in _slices(texts):
                yield _tokens(cutter, texts[lo:hi])[:2]

    def run(batches):
        for name, context, n in _combined(parts(batches), _counted_pairs):
            yield pa.RecordBatch.from_arrays(
                _by_place(deal.buckets, deal(name, context),
                          [(name, np.uint64), (context, np.uint64), (n, np.int32)]),
                names=["bucket", "names", "contexts", "counts"])
    return run


def _bucket(table: pa.Table) -> pa.Table:
    """The first state of a bucket: one table per dish."""
    names, word = _ranked(_unpacked(table.column("names"), np.uint64))
    seen, of = _ranked(_unpacked(table.column("contexts"), np.uint64))
    dish = (word * len(seen) + of).astype(np.uint64)
    order, head = _by_pair(dish << np.uint64(64 - (len(names) * len(seen)).bit_length()))
    at = order[head]
    n = np.add.reduceat(_unpacked(table.column("counts"), np.int32)[order], head, dtype=np.int64)
    state = _State(table.column("bucket")[0].as_py(), names,
                   np.bincount(word[at], minlength=len(names)), seen, of[at], n,
                   np.ones(len(n), np.int64), np.zeros(len(n)), np.empty((len(names), 0)))
    return pa.Table.from_batches([state.row([n.sum(), (n == 1).sum(), (n == 2).sum()])])


class _State:
    """The pairs of a bucket: words, dishes (contexts, counts, tables) and sums so far.

    Stored, a dish has the rank of its context among the bucket's (``of``) and a bit that
    tells if it has more than one customer; counts, tables and the sum of scores are kept
    for these dishes alone. A dish with one customer has one table, and its score follows
    from the totals of its word and context."""

    COLUMNS = ("names", "sizes", "contexts", "of", "more", "counts", "tables", "score", "parent")
    SCHEMA = ("bucket int, " + ", ".join(f"{c} binary" for c in COLUMNS)
              + ", totals array<double>")

    def __init__(self, bucket, names, sizes, seen, of, counts, tables, score, parent):
        self.bucket, self.names, self.sizes, self.seen, self.at = bucket, names, sizes, seen, of
        self.counts, self.tables, self.score, self.parent = counts, tables, score, parent

    @property
    def contexts(self) -> np.ndarray:
        return self.seen[self.at]

    @classmethod
    def of(cls, row: dict) -> "_State":
        names, sizes, seen = (np.frombuffer(row[c], dtype=k) for c, k in (
            ("names", np.uint64), ("sizes", np.int32), ("contexts", np.uint64)))
        at = _ranks(row["of"])
        more = _bits(row["more"], len(at))
        counts, tables = (np.ones(len(at), np.int64) for _ in range(2))
        score = np.zeros(len(at))
        counts[more], tables[more], score[more] = (np.frombuffer(row[c], dtype=k) for c, k in (
            ("counts", np.int64), ("tables", np.int64), ("score", np.float64)))
        parent = np.frombuffer(row["parent"]).reshape(len(names), -1)
        return cls(row["bucket"], names, sizes, seen, at, counts, tables, score, parent)

    def row(self, totals) -> pa.RecordBatch:
        more = self.counts > 1
        packed = [_packed(x, k) for x, k in (
            (self.names, np.uint64), (self.sizes, np.int32), (self.seen, np.uint64),
            (_halves(self.at), np.uint16), (np.packbits(more), np.uint8),
            (self.counts[more], np.int64),
            (self.tables[more], np.int64), (self.score[more], np.float64),
            (self.parent, np.float64))]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in packed),
             pa.array([[float(t) for t in totals]], pa.list_(pa.float64()))],
            names=["bucket", *self.COLUMNS, "totals"])

    def keys(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The words or contexts of the bucket, and which of them each dish has."""
        if kind == WORD:
            return self.names, np.repeat(np.arange(len(self.names)), self.sizes)
        return self.seen, self.at


def _halves(ranks: np.ndarray) -> np.ndarray:
    """The low halves of 32-bit ranks, then the high ones, which are mostly alike."""
    return np.concatenate([ranks & 0xFFFF, ranks >> 16])


def _ranks(packed: bytes) -> np.ndarray:
    low, high = np.frombuffer(packed, np.uint16).reshape(2, -1).astype(np.int64)
    return low + (high << 16)


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _chances(keys: np.ndarray, turn: int) -> np.ndarray:
    """Uniform numbers that depend on key and turn alone."""
    x = rc.mix(keys + np.uint64(turn * int(rc.K0) & 0xFFFFFFFFFFFFFFFF))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float,
         rng: np.random.Generator, keys: np.ndarray | None = None) -> np.ndarray:
    """Tables of dishes after seating their customers; ``fresh`` is the weight of a new
    table, (strength + discount * tables of the restaurant) * parent probability.

    The first customers sit down one by one; later ones in parties of an eighth of those
    seated, which all see the tables there are when the party comes in. With ``keys`` (64-bit
    names of the dishes in this sweep) single customers draw by key and turn, so a dish is
    seated alike in whatever bucket it lies.
    """
    tables = np.ones(len(customers), dtype=np.int64)
    live = np.flatnonzero(customers > 1)
    live = live[np.argsort(-customers[live], kind="stable")]
    seated = 1
    while len(live):
        party = 1 if seated < SINGLY else seated // 8
        size = np.minimum(party, customers[live] - seated)
        p = fresh[live] / (fresh[live] + seated - discount * tables[live])
        p = np.clip(p, 0.0, 1.0)
        if party == 1:
            draw = rng.random(len(live)) if keys is None else _chances(keys[live], seated)
            tables[live] += draw < p
        else:
            tables[live] += rng.binomial(size, p)
        seated += party
        live = live[:np.searchsorted(-customers[live], -seated, side="left")]
    return tables


REPORT = "kind int, owner int, bucket int, names binary, tables binary, counts binary"
OWNED = REPORT + ", top binary, samples binary, totals array<double>"


def _reports(owners: int, first: bool):
    """What buckets tell the owners: tables (at ``first`` also customers) of every key."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                s = _State.of(row)
                for kind in (WORD, CONTEXT):
                    key, at = s.keys(kind)
                    summed = [np.bincount(at, x, len(key)).astype(np.int64)
                              for x in ([s.tables, s.counts] if first else [s.tables])]
                    owner, *packed = _by_place(owners, _owner(key, owners), [
                        (key, np.uint64), *((x, np.int64) for x in summed)])
                    if not first:
                        packed.append(pa.nulls(len(owner), pa.binary()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(owner), pa.int32()), owner,
                         pa.array([s.bucket] * len(owner), pa.int32()), *packed],
                        names=["kind", "owner", "bucket", "names", "tables", "counts"])
    return run


def _owned(m: dict):
    """An owner's keys after a sweep (the row without a bucket), and its replies to the
    buckets in ``tables`` and ``top`` (words) or ``counts`` (contexts), in the reports'
    order of keys."""
    d1, s1, sweep, keep = m.get("d1"), m["s1"], m["sweep"], m["keep"]
    above, base = m.get("above"), m.get("base")

    def run(reports: pa.Table, old: pa.Table | None = None) -> pa.Table:
        kind, owner = (reports.column(c)[0].as_py() for c in ("kind", "owner"))
        told = [np.frombuffer(r, dtype=np.uint64) for r in reports.column("names").to_pylist()]
        names, at = np.unique(np.concatenate(told), return_inverse=True)

        def summed(column):
            return np.bincount(at, _unpacked(reports.column(column), np.int64),
                               len(names)).astype(np.int64)

        tables = summed("tables")
        if old is None:
            counts, top = summed("counts"), np.ones(len(names), dtype=np.int64)
            samples = np.empty((len(names), 0))
        else:
            counts, top = (_unpacked(old.column(c), np.int64) for c in ("counts", "top"))
            samples = _unpacked(old.column("samples"), np.float64).reshape(len(names), -1)
            if kind == WORD:
                rng = np.random.default_rng([SEED, sweep, owner, 1])
                top = seat(tables, (s1 + d1 * (above - top)) * base, d1, rng,
                           rc.mix(names + np.uint64(SEED + sweep)))
        if keep:
            samples = np.column_stack([samples, tables - d1 * top if kind == WORD else tables])
        totals = [0.0] * 5 if kind == CONTEXT else [float(x) for x in (
            tables.sum(), top.sum(), len(names), (tables == 1).sum(), (tables == 2).sum())]
        rows = [(None, _packed(names, np.uint64), _packed(tables, np.int64),
                 _packed(counts, np.int64), _packed(top, np.int64),
                 _packed(samples, np.float64), totals)]
        cut = np.append(0, np.cumsum([len(x) for x in told]))
        also = top if kind == WORD else counts
        for bucket, lo, hi in zip(reports.column("bucket").to_pylist(), cut, cut[1:]):
            rows.append((bucket, None, _packed(tables[at[lo:hi]], np.int64),
                         _packed(also[at[lo:hi]], np.int64), None, None, None))
        return pa.table(
            [pa.array([kind] * len(rows), pa.int32()), pa.array([owner] * len(rows), pa.int32()),
             pa.array([r[0] for r in rows], pa.int32()),
             *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 6)),
             pa.array([r[6] for r in rows], pa.list_(pa.float64()))],
            names=["kind", "owner", "bucket", "names", "tables", "counts", "top", "samples",
                   "totals"])
    return run


def _sweep(m: dict, owners: int):
    """One Gibbs sweep over a bucket; the seating it starts from is a sample if ``keep``."""
    d1, d2, s1, s2 = m["d1"], m["d2"], m["s1"], m["s2"]
    parents, above, base = m["parents"], m["above"], m["base"]

    def run(state: pa.Table, replies: pa.Table) -> pa.Table:
        s = _State.of(state.to_pylist()[0])
        told = sorted(replies.select(["kind", "owner", "tables", "counts"]).to_pylist(),
                      key=lambda r: (r["kind"], r["owner"]))
        of_dish, sums = [], []
        for kind in (WORD, CONTEXT):
            key, at = s.keys(kind)
            order = _place_order(_owner(key, owners), owners)
            of_dish.append(at)
            for c in ("tables", "counts"):
                x = np.empty(len(key), dtype=np.int64)
                x[order] = np.concatenate([np.frombuffer(r[c], dtype=np.int64)
                                           for r in told if r["kind"] == kind])
                sums.append(x)
        (word, ctx), (mine, top, tables_of, customers) = of_dish, sums
        p1 = (mine - d1 * top + (s1 + d1 * above) * base) / (s1 + parents)
        if m["keep"]:
            s.score = s.score + (s.counts - d2 * s.tables + (s2 + d2 * tables_of[ctx])
                                 * p1[word]) / (s2 + customers[ctx])
            s.parent = np.column_stack([s.parent, p1])
        if m["reseat"]:
            rng = np.random.default_rng([SEED, m["sweep"], s.bucket])
            fresh = (s2 + d2 * (tables_of[ctx] - s.tables)) * p1[word]
            dishes = _pair(s.names.repeat(s.sizes), s.contexts)
            s.tables = seat(s.counts, fresh, d2, rng, rc.mix(dishes + np.uint64(SEED + m["sweep"])))
        return pa.Table.from_batches([s.row([])])
    return run


def _totals(state: DataFrame, n: int) -> np.ndarray:
    """Sums of the ``n`` totals that the rows have."""
    rows = state.select(F.posexplode("totals")).groupBy("pos").agg(F.sum("col").alias("n"))
    out = np.zeros(n)
    for r in rows.collect():
        out[r["pos"]] = r["n"]
    return out


class Weights:
    """``[samples, context]``: the parent's share in a context's probabilities, looked up
    among the owners' contexts; 1 for a context that was not seen."""

    def __init__(self, owned: DataFrame, owners: int, d2: float, s2: float, samples: int):
        self.owned, self.owners, self.d2, self.s2 = owned, owners, d2, s2
        self.samples = samples

    def __getitem__(self, at):
        samples, context = at
        out = np.ones(self.samples)
        for r in self.owned.filter((F.col("kind") == CONTEXT)
                                   & (F.col("owner") == int(context) % self.owners)).collect():
            found = np.flatnonzero(np.frombuffer(r["names"], np.uint64) == np.uint64(context))
            for i in found:
                t = np.frombuffer(r["samples"]).reshape(-1, self.samples)[i]
                out = (self.s2 + self.d2 * t) / (
                    self.s2 + np.frombuffer(r["counts"], np.int64)[i])
        return out[samples]


def train(docs: DataFrame, buckets: int, deal: Deal | None = None) -> tuple[DataFrame, dict]:
    """Seat the tokens of ``docs``; returns the buckets of pairs and the model's numbers.

    A bucket has, for each of its words, its contexts, the sum over samples of its
    predictive probability in each (``score``), and its unigram probability per sample
    (``parent``). The model's ``owned`` has a row per owner and kind: names, customers
    (``counts``) and, per sample, a word's discounted customers of the unigram restaurant
    or a context's tables (``samples``).
    """
    deal = deal or Deal(buckets)
    owners = -(-buckets // 4)
    state = stored(
        map_arrow(docs.select(text_or_empty().alias("text")), _counted(deal),
                  "bucket int, names binary, contexts binary, counts binary")
        .groupBy("bucket").applyInArrow(_bucket, _State.SCHEMA), "lm-state")
    tokens, ones, twos = _totals(state, 3)

    def discount(once, twice):
        return min(0.95, max(0.1, once / (once + 2.0 * twice))) if once else 0.5

    m = {"d2": discount(ones, twos), "s1": 1.0, "s2": 1.0, "tokens": int(tokens)}
    owned, unseen, place = None, [], ["kind", "owner"]
    for sweep in range(BURN + SAMPLES):
        m.update(sweep=sweep, keep=sweep >= BURN, reseat=sweep < BURN + SAMPLES - 1)
        reports = map_arrow(state, _reports(owners, owned is None), REPORT, rows=2).groupBy(*place)
        if owned is None:
            first = _owned(m)
            told = stored(reports.applyInArrow(lambda t: first(t), OWNED), "lm-owned")
        else:
            told = stored(reports.cogroup(owned.groupBy(*place)).applyInArrow(_owned(m), OWNED),
                          "lm-owned")
            drop_stored(owned)
        t = _totals(told, 5)
        if owned is None:
            m.update(types=int(t[2]), base=1.0 / (t[2] + 1), d1=discount(t[3], t[4]))
        m.update(parents=t[0], above=t[1])
        owned = told.filter("bucket is null")
        if m["keep"]:
            unseen.append((m["s1"] + m["d1"] * m["above"]) * m["base"] / (m["s1"] + m["parents"]))
            m.setdefault("norms", []).append(m["s1"] + m["parents"])
        new = stored(state.groupBy("bucket").cogroup(
            told.filter("bucket is not null").groupBy("bucket")).applyInArrow(
            _sweep(m, owners), _State.SCHEMA), "lm-state")
        drop_stored(state)
        state = new
    # without the replies and the tables of the last sweep
    kept = stored(owned.select("kind", "owner", "names", "counts", "samples"), "lm-keys")
    drop_stored(told)
    owned = kept
    return state, {**m, "unseen": np.array(unseen), "owned": owned, "owners": owners,
                   "weights": Weights(owned, owners, m["d2"], m["s2"], SAMPLES)}


def _pairs_of(deal: Deal, pair: np.ndarray, name: np.ndarray, context: np.ndarray):
    """Distinct pairs in the order of questions (bucket, then name): the order of the tokens
    by pair, the first token of each pair in it, and the places and ranks of the pairs."""
    order, head = _by_pair(pair)
    first = order[head]
    place = deal(name[first], context[first])
    by_place = _place_order(place, deal.buckets)
    return order, head, place[by_place], by_place


def _asked(deal: Deal, owners: int):
    """Questions of a chunk of texts: every pair, word and context once."""
    def run(texts: pa.Table) -> pa.Table:
        chunk = texts.column("chunk")[0].as_py()
        cutter, rows = rc.WordCutter(), _bytes(texts)
        name, context = (np.concatenate(x) for x in zip(*(
            _tokens(cutter, rows[lo:hi])[:2] for lo, hi in _slices(rows))))
        pair = _pair(name, context)
        order, head, place, by_place = _pairs_of(deal, pair, name, context)
        parts = [(PAIR, place, pair[order[head]][by_place])]
        words = _distinct(name)         # each is a context too, but for the end
        for kind, key in ((WORD, words), (CONTEXT, np.append(np.uint64(START), words))):
            owner = _owner(key, owners)
            by = _place_order(owner, owners)
            parts.append((kind, owner[by], key[by]))
        out = [(kind, int(place[lo]), _packed(x[lo:hi], np.uint64))
               for kind, place, x in parts for lo, hi in _runs(place)]
        return pa.table([pa.array([r[0] for r in out], pa.int32()),
                         pa.array([r[1] for r in out], pa.int32()),
                         pa.array([chunk] * len(out), pa.int32()),
                         pa.array([r[2] for r in out], pa.binary())],
                        names=["kind", "place", "chunk", "names"])
    return run


def _looked_up(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of ``x`` in the sorted keys, ``len(keys)`` if it is not there. Names are spread
    evenly: their first bits tell the place but for a few steps."""
    shift = np.uint64(63 - len(keys).bit_length())
    starts = np.searchsorted(keys, np.arange(1 << int(64 - shift), dtype=np.uint64) << shift)
    last = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))
    at = starts.astype(np.int32)[x >> shift]
    late = np.flatnonzero(last[at] < x)
    while len(late):
        at[late] += 1
        late = late[last[at[late]] < x[late]]
    at[last[at] != x] = len(keys)
    return at


def _found(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``x`` in the sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


UNKNOWN, ONCE, MORE = 0, 1, 2


def _known(model: dict):
    """Answers, one row per chunk that asked: of the words and contexts that are known, the
    customers and per sample the unigram probabilities or the parent's weights; of all pairs
    asked for, in the order of their names, whether they were seen never, once or more, and the
    scores of the latter (in single precision)."""
    d2, s2 = model["d2"], model["s2"]
    norms, unseen = np.array(model["norms"]), model["unseen"]

    def pairs(row):
        word = np.frombuffer(row["names"], np.uint64).repeat(np.frombuffer(row["sizes"], np.int32))
        at = _ranks(row["ranks"])
        dish = _pair(word, np.frombuffer(row["contexts"], np.uint64)[at])
        more = _bits(row["more"], len(at))
        score = np.zeros(len(at))
        score[more] = np.frombuffer(row["values"], np.float64)
        order, dish = _order(dish)
        more, score = more[order], score[order]

        def answer(x):
            i, hit = _found(dish, x)
            told = np.where(hit, np.where(more[i], MORE, ONCE), UNKNOWN).astype(np.uint8)
            return None, _packed(told, np.uint8), _packed(score[i[told == MORE]], np.float32)
        return answer

    def keys(row, kind):
        have, n = np.frombuffer(row["names"], np.uint64), np.frombuffer(row["counts"], np.int64)
        values = np.frombuffer(row["values"], np.float64).reshape(len(n), -1)
        values = values / norms + unseen if kind == WORD else (s2 + d2 * values) / (s2 + n[:, None])

        def answer(x):
            i, hit = _found(have, x)
            i = i[hit]
            return (_packed(x[hit], np.uint64), _packed(n[i], np.int64),
                    _packed(values[i], np.float64))
        return answer

    def run(questions: pa.Table, known: pa.Table) -> pa.Table:
        out, kind, place = [], None, None
        if len(questions) and len(known):
            kind, place = (questions.column(c)[0].as_py() for c in ("kind", "place"))
            row = known.to_pylist()[0]
            answer = pairs(row) if kind == PAIR else keys(row, kind)
            out = [(q["chunk"], *answer(np.frombuffer(q["names"], np.uint64)))
                   for q in questions.select(["chunk", "names"]).to_pylist()]
        n = len(out)
        return pa.table([pa.array([r[0] for r in out], pa.int32()),
                         pa.array([kind] * n, pa.int32()), pa.array([place] * n, pa.int32()),
                         *(pa.array([r[i] for r in out], pa.binary()) for i in range(1, 4))],
                        names=["chunk", "kind", "place", "names", "n", "values"])
    return run


def _runs(x: np.ndarray):
    """(first, end) of the runs of equal values."""
    cut = np.flatnonzero(x[1:] != x[:-1]) + 1
    return zip(np.append(0, cut), np.append(cut, len(x))) if len(x) else ()


def _scored(model: dict, deal: Deal):
    """Scores of the texts of one chunk from the answers it got."""
    tokens, types, unseen = model["tokens"], model["types"], model["unseen"]
    d2, s2 = model["d2"], model["s2"]

    def keyed(answers, kind, unknown):
        """Sorted keys, customers and values, the last entries those of an unknown key."""
        rows = answers.filter(pa.compute.equal(answers.column("kind"), kind))
        names, n = (_unpacked(rows.column(c), k) for c, k in (("names", np.uint64),
                                                              ("n", np.int64)))
        values = _unpacked(rows.column("values"), np.float64).reshape(len(names), -1)
        order = np.argsort(names)
        return (names[order], np.append(n[order], 0),
                np.vstack([values[order].reshape(-1, len(unseen)), unknown]))

    def rank(keys, x):
        at, hit = _found(keys, x)
        return np.where(hit, at, len(keys))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        words, n, parent = keyed(answers, WORD, unseen)
        contexts, customers, weight = keyed(answers, CONTEXT, np.ones(len(unseen)))
        cutter, rows = rc.WordCutter(), _bytes(texts)
        cut = [(lo, *_tokens(cutter, rows[lo:hi])) for lo, hi in _slices(rows)]
        name, context = (np.concatenate([c[i] for c in cut]) for i in (1, 2))
        doc = np.concatenate([lo + d for lo, _, _, d in cut])
        # words by their place among the known ones; a context is the word before or, at the
        # first of a text, the start. Only words that are known were seen as a context.
        word = _looked_up(words, name)
        before = np.append(word[:1], word[:-1])
        before[_heads(doc)] = len(words) + 1
        j = np.append(rank(contexts, words), [len(contexts), *rank(contexts, np.array(
            [START], np.uint64))])
        parent, customers, weight = parent.T.copy(), customers[j], weight[j].T.copy()
        base = np.log10((n + 0.5) / (tokens + 0.5 * (types + 1)))
        # what is known of every distinct pair, in the order of the questions
        order, head, place, by_place = _pairs_of(deal, _pair(name, context), name, context)
        told = {r["place"]: r for r in answers.filter(
            pa.compute.equal(answers.column("kind"), PAIR)).to_pylist()}
        state, score = np.zeros(len(place), np.uint8), np.zeros(len(place))
        for lo, hi in _runs(place):
            r = told.get(int(place[lo]))
            if r is not None:
                state[lo:hi] = np.frombuffer(r["n"], np.uint8)
                score[lo:hi][state[lo:hi] == MORE] = np.frombuffer(r["values"], np.float32)
        first = order[head][by_place]
        i, j = word[first], before[first]
        p = sum(w[j] * u[i] for w, u in zip(weight, parent))
        once, more = state == ONCE, state == MORE
        p[once] += (len(unseen) * (1 - d2) / (s2 + customers))[j[once]]
        p[more] = score[more]
        by_pair = np.empty(len(p))
        by_pair[by_place] = np.log10(p / len(unseen))
        by_pair = by_pair.repeat(np.diff(np.append(head, len(order))))

        def add(doc, x):
            return np.bincount(doc, x, len(rows))

        return pa.table({
            "doc_id": texts.column("doc_id"),
            "n_tokens": pa.array(np.bincount(doc, minlength=len(rows)).astype(np.int64)),
            "n_known": pa.array(add(doc, (n > 0)[word]).astype(np.int64)),
            "base_score": pa.array(add(doc, base[word])),
            "score": pa.array(add(doc[order], by_pair))})
    return run


def score_texts(docs: DataFrame, parts: int = 5, part: int = 1, rounds: int = 3) -> DataFrame:
    """Log10 probability of every text: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    Learns from the rows outside the fold ``crc32(doc_id) % parts == part`` and scores all,
    in ``rounds`` shares of the chunks, which bounds what is on disk at a time.

    Defined cases: a null or empty text is just its end token; a null doc_id is not held
    out; repeated rows are learnt and scored each; without training rows the counts are
    zero and all types alike; very long texts are read whole (one text is never cut, so a
    chunk is at least as large as its longest text); extra columns are ignored; an empty
    table gives no rows. Words, and pairs of words, count as the same when their 64-bit
    names agree.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    held = held_out(F.col("doc_id"), parts, part)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    buckets = 4 * chunks
    training = rows.filter(~held)
    deal = dealt_by(training, buckets)
    pairs, model = train(training, buckets, deal)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))
                            .cast("int"))
    known = pairs.select(F.lit(PAIR).alias("kind"), F.col("bucket").alias("place"), "names",
                         "sizes", "contexts", F.col("of").alias("ranks"), "more",
                         F.col("score").alias("values")).unionByName(
        model["owned"].select("kind", F.col("owner").alias("place"), "names", "counts",
                              F.col("samples").alias("values")), allowMissingColumns=True)
    place, scored = ["kind", "place"], None
    arrow_rows(docs.sparkSession)       # the buckets came by twos, chunks have many short rows
    # a share of the chunks at a time: their questions and answers take most of the disk
    for share in range(min(rounds, chunks)):
        mine = dealt.filter(F.col("chunk") % rounds == share)
        asked = mine.select("chunk", "text").groupBy("chunk").applyInArrow(
            _asked(deal, model["owners"]), "kind int, place int, chunk int, names binary")
        answers = stored(asked.groupBy(*place).cogroup(known.groupBy(*place)).applyInArrow(
            _known(model), "chunk int, kind int, place int, names binary, n binary,"
                           " values binary"), "lm-answers")
        part = stored(mine.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            _scored(model, deal),
            "doc_id long, n_tokens long, n_known long, base_score double, score double"),
            "lm-scores")
        drop_stored(answers)
        scored = part if scored is None else scored.unionByName(part)
    drop_stored(pairs)
    drop_stored(model["owned"])
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                         F.lit(model["tokens"]).cast("long").alias("train_tokens"),
                         "base_score", "score")
