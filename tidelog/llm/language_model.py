"""LM scoring by a hierarchical Pitman-Yor model.

A text is a row of lower-case tokens; the model gives the probability of each byte of a token, of the
token's end and of the text's end, given the six symbols before. A context's restaurant shares the
restaurant of the context without its oldest symbol as parent; below the shortest lies the uniform
distribution. Seating is sampled by Gibbs sweeps: given all other seats, the customers of each dish in
each restaurant are seated anew by the Chinese-restaurant rule, each new table being a customer of the
parent. Predictive probabilities are averaged over the sweeps after burn-in.

All restaurants whose contexts end in the same two symbols hang below one restaurant of a context of
one symbol. So those families are dealt out by these two symbols and sampled where they lie; only the
two topmost levels, at most 257 * 257 dishes, are sampled on the driver between the sweeps. Counts are
summed, and probabilities looked up, by the hash of the whole gram, so a frequent context is no hot key
there: a family's task sees each of its distinct grams once, however much text there is. Counts and
scores are exchanged between blocks of documents and buckets of families or of tokens, each distinct
key once a block; the model itself is never collected or broadcast.

Defined cases: a null text is empty (its end alone is scored); equal ids are scored each; without any
training text the model is uniform; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t

ORDER = 7
#: bytes, with a token's end as 0x20 and a text's end as 0x0A, both of which tokens lack
TOKEN_END, TEXT_END = 0x20, 0x0A
SYMBOLS = 256
STRENGTH = 0.5
BURN_IN, SAMPLES = 3, 3
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
HELD_OUT = 10
#: least number of families' buckets
FAMILIES = 16
WORD, GRAM = 0, 1
_END_HASH = np.uint64(0x0123456789ABCDEF)


def _symbols(data: np.ndarray, start: np.ndarray, end: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' symbols in a row, each text led by ORDER - 1 text ends, and the texts' offsets in it."""
    docs, n = len(border) - 1, ORDER - 1
    length = end - start
    per_doc = t.per_doc(length + 1, border) + n + 1
    off = np.concatenate(([0], np.cumsum(per_doc)))
    out = np.full(off[-1], TEXT_END, np.uint8)
    if len(start):
        doc = t.doc_of(border, len(start))
        before = np.cumsum(length + 1) - (length + 1)
        at = off[doc] + n + before - before[border[doc]]
        place = np.repeat(at - np.cumsum(length) + length, length) + np.arange(length.sum())
        source = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
        out[place] = data[source]
        out[at + length] = TOKEN_END
    return out, off


def _grams(symbols: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each symbol to be predicted, oldest symbol highest; texts' borders in them."""
    n = len(symbols) - ORDER + 1
    out = np.zeros(n, np.uint64)
    for j in range(ORDER):
        out = (out << np.uint64(8)) | symbols[j : n + j]
    inside = np.ones(len(symbols), bool)
    lead = off[:-1][:, None] + np.arange(ORDER - 1)
    inside[lead.ravel()] = False
    return out[inside[ORDER - 1 :]], off - (ORDER - 1) * np.arange(len(off))


def _tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with each text's end, the texts' borders in them, grams and their borders."""
    data = t.LOWER[raw]
    start, end, border = t.words(data, off)
    h = t.span_hash(t.prefix_hash(data), start, end)
    where = border + np.arange(len(border))
    all_h = np.full(len(h) + len(border) - 1, _END_HASH)
    all_h[np.arange(len(h)) + t.doc_of(border, len(h))] = h
    return all_h, where, *_grams(*_symbols(data, start, end, border))


def _buckets_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where keys are counted and looked up: by their hash, so no context is a hot key."""
    return ((keys if kind == WORD else t.mix(keys)) % np.uint64(buckets)).astype(np.int64)


def _families_of(grams: np.ndarray, families: int) -> np.ndarray:
    """Where grams are seated: by the two symbols before the last, since restaurants share parents."""
    return (t.mix((grams >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(families)).astype(np.int64)


def _dealt(keys: np.ndarray, at: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that holds some of the keys, with their places."""
    at = at.astype(np.uint16 if n <= 1 << 16 else np.int64)  # few bits are sorted by radix
    order = np.argsort(at, kind="stable")
    border = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=n))))
    for k, s, e in zip(range(n), border[:-1], border[1:], strict=True):
        if e > s:
            yield k, order[s:e]


def _merge(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate(keys)
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(np.concatenate(values)[order], first) if len(k) else np.zeros(0, np.int64)


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of training texts with their counts, and those of the others with 0."""
    x = np.sort(keys[train])
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    rest = t.distinct(keys[~train])
    return np.concatenate((x[first], rest)), np.concatenate((np.diff(np.append(first, len(x))), np.zeros(len(rest), np.int64)))


def _press(x: np.ndarray) -> bytes:
    """Numbers in planes of bytes, compressed."""
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpress(blob: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(blob[8:], n * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _press_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return _press(np.diff(keys, prepend=np.uint64(0)))


def _unpress_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpress(blob, "<u8"), dtype=np.uint64)


class _Places:
    """Finds keys' places in an array of distinct ones by an open hash table; every key asked for is there."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.uint64(64 - max(10, int(len(keys)).bit_length() + 2))
        self.table = np.full(1 << int(64 - self.bits), -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            lost = self.table[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.table[slot]
        off = np.flatnonzero(self.keys[out] != keys)
        while len(off):
            slot[off] = (slot[off] + 1) & (len(self.table) - 1)
            out[off] = self.table[slot[off]]
            off = off[self.keys[out[off]] != keys[off]]
        return out


_ROWS = "bucket int, kind int, keys binary, counts binary"
_ROW_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _count_rows(kind: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> list[tuple]:
    return [(k, kind, _press_keys(keys[own]), _press(counts[own].astype("<i8"))) for k, own in _dealt(keys, _buckets_of(kind, keys, buckets), buckets)]


def _counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, kind, keys, counts): training counts of each distinct token and gram of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def out(kind: int) -> pa.RecordBatch:
            rows = _count_rows(kind, *_merge(*zip(*held[kind], strict=True)), buckets)
            held[kind] = []
            return pa.record_batch([pa.array([r[k] for r in rows], kind_) for k, kind_ in enumerate(_ROW_TYPES)], ["bucket", "kind", "keys", "counts"])

        for b in batches:
            train = ~b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in t.chunks(b.column(1)):
                h, where, grams, border = _tokens(data, off)
                for kind, keys, at in ((WORD, h, where), (GRAM, grams, border)):
                    held[kind].append(_counted(keys, np.repeat(train[lo:hi], np.diff(at))))
                    if len(held[kind]) >= 8:
                        held[kind] = [_merge(*zip(*held[kind], strict=True))]
                        if len(held[kind][0][0]) > 1 << 20:  # so that memory stays bounded
                            yield out(kind)
        for kind in (WORD, GRAM):
            if held[kind]:
                yield out(kind)

    def add(table: pa.Table) -> pa.Table:
        keys, counts = _merge([_unpress_keys(x) for x in table["keys"].to_pylist()], [_unpress(x, "<i8") for x in table["counts"].to_pylist()])
        return pa.table([pa.array([x], kind) for x, kind in zip((table["bucket"][0].as_py(), table["kind"][0].as_py(), _press_keys(keys), _press(counts)), _ROW_TYPES, strict=True)], ["bucket", "kind", "keys", "counts"])

    return docs.select("held_out", "text").mapInArrow(count, _ROWS).groupBy("bucket", "kind").applyInArrow(add, _ROWS)


def _seat(count: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers are seated one by one.

    ``others`` are the restaurant's tables of other dishes, ``parent`` the parent's probability of the
    dish: a customer opens a table with weight (strength + discount * tables) * parent, and joins one
    with its customers less the discount. Customers beyond the 32nd of a dish come in groups of a
    sixteenth of those seated, which share one probability.
    """
    tables = np.minimum(count, 1)
    live = np.flatnonzero(count > 1)
    seated = 1
    while len(live):
        n = tables[live]
        new = (STRENGTH + discount * (others[live] + n)) * parent[live]
        group = 1 if seated < 32 else seated // 16
        tables[live] = n + rng.binomial(np.minimum(group, count[live] - seated), new / (new + seated - discount * n))
        seated += group
        live = live[count[live] > seated]
    return tables


def _discount(count: np.ndarray) -> float:
    """From how many dishes have one customer and how many two; kept away from 0 and 1."""
    one, two = int((count == 1).sum()), int((count == 2).sum())
    return min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5


class _Level:
    """The dishes of all restaurants of one context length: sorted grams of ``order`` symbols."""

    def __init__(self, grams: np.ndarray, order: int):
        self.order, self.grams = order, grams
        context = grams >> np.uint64(8)
        self.restaurant = np.cumsum(np.append(False, context[1:] != context[:-1])) if len(grams) else np.zeros(0, np.int64)
        self.count = np.zeros(len(grams), np.int64)
        self.tables = np.zeros(len(grams), np.int64)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each dish's restaurant."""
        r = self.restaurant
        return np.bincount(r, self.count)[r], np.bincount(r, self.tables)[r]

    def predictive(self, parent: np.ndarray, discount: float) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(0)
        customers, tables = self.totals()
        return (self.count - discount * self.tables + (STRENGTH + discount * tables) * parent) / (STRENGTH + customers)

    def reseat(self, parent: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        if len(self.grams):
            self.tables = _seat(self.count, self.totals()[1] - self.tables, parent, discount, rng)


def _chain(grams: np.ndarray, low: int) -> tuple[list[_Level], list[np.ndarray]]:
    """Levels from ORDER down to ``low`` symbols over the sorted grams, and each dish's place in the next."""
    levels, up = [_Level(grams, ORDER)], []
    for order in range(ORDER - 1, low - 1, -1):
        short, back = np.unique(levels[-1].grams & np.uint64((1 << (8 * order)) - 1), return_inverse=True)
        levels.append(_Level(short, order))
        up.append(back)
    return levels, up


def _sweep(levels: list[_Level], up: list[np.ndarray], top: np.ndarray, discounts: list[float], rng: np.random.Generator) -> None:
    """Seats every dish anew, deepest restaurants first; ``top`` is the probability above the last level."""
    p = [top]
    for k in range(len(levels) - 1, 0, -1):
        p.append(levels[k].predictive(p[-1], discounts[k])[up[k - 1]])
    p.reverse()
    for k, level in enumerate(levels):
        if k:
            level.count = np.bincount(up[k - 1], levels[k - 1].tables, len(level.grams)).astype(np.int64)
            level.tables = np.minimum(np.maximum(level.tables, level.count > 0), level.count)
        level.reseat(p[k], discounts[k], rng)


_STATE = "bucket int, grams binary, counts binary, tables binary, sums binary, kinds binary, total binary, samples int"
_STATE_NAMES = ["bucket", "grams", "counts", "tables", "sums", "kinds", "total", "samples"]
_STATE_TYPES = [pa.int32(), *[pa.binary()] * 6, pa.int32()]
#: levels that families hold, from ORDER down to three symbols
_FAMILY = ORDER - 2


def _state_row(bucket: int, levels: list[_Level], total: np.ndarray, samples: int) -> pa.RecordBatch:
    """A family bucket's seating; with the tables of its last level, and counts of dishes with one and two customers."""
    last = levels[-1]
    sums = np.stack((last.grams & np.uint64(0xFFFF), last.tables.astype(np.uint64)))
    kinds = np.array([[(x.count == 1).sum(), (x.count == 2).sum()] for x in levels], "<i8")
    row = (bucket, _press_keys(levels[0].grams), _press(levels[0].count.astype("<i8")), _press(np.concatenate([x.tables for x in levels]).astype("<i8")), _press(sums.ravel()), kinds.tobytes(), _press(total.astype("<f4")), samples)
    return pa.record_batch([pa.array([x], kind) for x, kind in zip(row, _STATE_TYPES, strict=True)], _STATE_NAMES)


def _levels_of(row: dict) -> tuple[list[_Level], list[np.ndarray]]:
    levels, up = _chain(_unpress_keys(row["grams"]), 3)
    levels[0].count = _unpress(row["counts"], "<i8")
    at, tables = 0, _unpress(row["tables"], "<i8")
    for k, level in enumerate(levels):
        level.tables = tables[at : at + len(level.grams)].copy()
        at += len(level.grams)
        if k:
            level.count = np.bincount(up[k - 1], levels[k - 1].tables, len(level.grams)).astype(np.int64)
    return levels, up


def _families(counts: DataFrame, families: int) -> DataFrame:
    """(family, keys, counts): the grams' summed counts, regrouped for seating; each gram comes once."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, count = _unpress_keys(k), _unpress(c, "<i8")
                rows = [(f, _press_keys(keys[own]), _press(count[own])) for f, own in _dealt(keys, _families_of(keys, families), families)]
                yield pa.record_batch([pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["family", "keys", "counts"])

    return counts.where(F.col("kind") == GRAM).select("keys", "counts").mapInArrow(split, "family int, keys binary, counts binary")


def _first_seats(table: pa.Table) -> pa.Table:
    """One table for each dish of each restaurant."""
    keys = np.concatenate([_unpress_keys(x) for x in table["keys"].to_pylist()])
    counts = np.concatenate([_unpress(x, "<i8") for x in table["counts"].to_pylist()])
    order = np.argsort(keys, kind="stable")
    levels, up = _chain(keys[order], 3)
    levels[0].count = counts[order].astype(np.int64)
    for k, level in enumerate(levels):
        if k:
            level.count = np.bincount(up[k - 1], levels[k - 1].tables, len(level.grams)).astype(np.int64)
        level.tables = np.minimum(level.count, 1)
    return pa.Table.from_batches([_state_row(table["family"][0].as_py(), levels, np.zeros(len(levels[0].grams)), 0)])


class _Top:
    """The two topmost levels, which all families share: dishes of contexts of one symbol and of none."""

    def __init__(self) -> None:
        self.pair, self.one = _Level(np.arange(1 << 16, dtype=np.uint64), 2), _Level(np.arange(256, dtype=np.uint64), 1)
        self.back = np.arange(1 << 16) & 255

    def add(self, count: np.ndarray, rng: np.random.Generator | None) -> np.ndarray:
        """Takes the families' tables as customers, seats them, and returns the probability of each pair."""
        uniform = np.full(256, 1 / SYMBOLS)
        self.discounts = [_discount(count), _discount(self.one.count)]
        below = self.one.predictive(uniform, self.discounts[1])[self.back]
        self.pair.count = count
        self.pair.tables = np.minimum(np.maximum(self.pair.tables, count > 0), count)
        if rng:
            self.pair.reseat(below, self.discounts[0], rng)
        self.one.count = np.bincount(self.back, self.pair.tables, 256).astype(np.int64)
        self.one.tables = np.minimum(np.maximum(self.one.tables, self.one.count > 0), self.one.count)
        if rng:
            self.one.reseat(uniform, self.discounts[1], rng)
        return self.pair.predictive(self.one.predictive(uniform, self.discounts[1])[self.back], self.discounts[0])


def _sweeper(sent: Broadcast, seed: tuple[int, int], keep: bool):
    """One Gibbs sweep of a family bucket; ``keep``: its probabilities afterwards are one of the samples."""

    def one(row: dict) -> pa.RecordBatch:
        levels, up = _levels_of(row)
        above, discounts = sent.value
        root = above[(levels[-1].grams & np.uint64(0xFFFF)).astype(np.int64)]
        _sweep(levels, up, root, discounts, np.random.default_rng((*seed, row["bucket"])))
        total = _unpress(row["total"], "<f4").astype(np.float64)
        if keep:
            p = root
            for k in range(len(levels) - 1, -1, -1):
                p = levels[k].predictive(p, discounts[k])
                if k:
                    p = p[up[k - 1]]
            total = total + p
        return _state_row(row["bucket"], levels, total, row["samples"] + keep)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield one(b.slice(k, 1).to_pylist()[0])

    return go


def _model(counts: DataFrame, burn_in: int, samples: int, seed: int, buckets: int) -> DataFrame:
    """(bucket, kind, keys, values, samples): each gram's probability, summed over the samples, where it is looked up."""
    spark = counts.sparkSession
    state = t.checkpoint(_families(counts, max(FAMILIES, buckets)).groupBy("family").applyInArrow(_first_seats, _STATE))
    top, rng = _Top(), np.random.default_rng(seed)
    for sweep in range(burn_in + samples + 1):
        count, kinds = np.zeros(1 << 16, np.int64), np.zeros((_FAMILY, 2), np.int64)
        for r in _pair_sums(state).collect():  # at most 257 * 257 pairs in all, and a few numbers
            if r["slice"] < 0:
                kinds += np.frombuffer(r["blob"], np.int64).reshape(kinds.shape)
            else:
                count[r["slice"] << 8 : (r["slice"] + 1) << 8] += np.frombuffer(r["blob"], np.int64)
        above = top.add(count, rng if sweep else None)
        if sweep == burn_in + samples:
            break
        discounts = [min(0.95, max(0.05, a / (a + 2 * b))) if a else 0.5 for a, b in kinds.tolist()]
        sent = spark.sparkContext.broadcast((above, discounts))  # half a megabyte
        state = t.checkpoint(state.mapInArrow(_sweeper(sent, (seed, sweep), sweep >= burn_in), _STATE))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, v, n in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                keys, total = _unpress_keys(g), _unpress(v, "<f4")
                rows = [(k, GRAM, _press_keys(keys[own]), _press(total[own]), n) for k, own in _dealt(keys, _buckets_of(GRAM, keys, buckets), buckets)]
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32())
                yield pa.record_batch([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], ["bucket", "kind", "keys", "values", "samples"])

    return state.select("grams", "total", "samples").mapInArrow(split, "bucket int, kind int, keys binary, values binary, samples int")


def _pair_sums(state: DataFrame) -> DataFrame:
    """The families' tables by pair of symbols, in slices of one context; the counts of counts as slice -1."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for sums, kinds in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pair, n = _unpress(sums, "<u8").reshape(2, -1).astype(np.int64)
                all_ = np.bincount(pair, n, 1 << 16).astype(np.int64).reshape(256, 256)
                for k in np.flatnonzero(all_.any(1)).tolist():
                    total[k] = total.get(k, 0) + all_[k]
                total[-1] = total.get(-1, 0) + np.frombuffer(kinds, np.int64)
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slice", "blob"])

    return t.sum_vectors(state.select("sums", "kinds").mapInArrow(split, "slice int, blob binary"), 4)


_ASK = "bucket int, block int, kind int, keys binary"
_ANSWER = "block int, bucket int, kind int, values binary"


def _ask(buckets: int):
    def go(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        rows = []
        for kind, keys in enumerate(_distinct(table)):
            rows += [(k, block, kind, _press_keys(keys[own])) for k, own in _dealt(keys, _buckets_of(kind, keys, buckets), buckets)]
        return pa.table([pa.array([r[k] for r in rows], x) for k, x in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["bucket", "block", "kind", "keys"])

    return go


def _distinct(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens and grams of a block."""
    words, grams = [], []
    for _, _, data, off in t.chunks(table["text"].combine_chunks()):
        h, _, g, _ = _tokens(data, off)
        words.append(t.distinct(h))
        grams.append(t.distinct(g))
    return t.distinct(np.concatenate(words)), t.distinct(np.concatenate(grams))


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """To each block, in its order: training counts of its tokens, log10 probabilities of its grams."""
    have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    rows = known.to_pylist()
    for kind in {r["kind"] for r in rows}:
        own = [r for r in rows if r["kind"] == kind]
        keys = np.concatenate([_unpress_keys(r["keys"]) for r in own])
        x = np.concatenate([_unpress(r["values"], "<i8" if kind == WORD else "<f4") for r in own])
        order = np.argsort(keys, kind="stable")
        x = x[order]
        have[kind] = keys[order], x.astype("<u4" if x.size and x.max() < 1 << 32 else "<u8") if kind == WORD else np.log10(x / max(1, own[0]["samples"]))
    rows = []
    for r in asked.to_pylist():
        keys, values = have[r["kind"]]
        got = values[np.searchsorted(keys, _unpress_keys(r["keys"]))]
        rows.append((r["block"], r["bucket"], r["kind"], _press(got.astype("<i8" if r["kind"] == WORD else "<f4"))))
    return pa.table([pa.array([r[k] for r in rows], x) for k, x in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["block", "bucket", "kind", "values"])


def _score(buckets: int, n_train: int, n_distinct: int):
    spread = np.log10(n_train + 0.1 * (n_distinct + 1))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_symbols"]

    def go(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())], names)
        keys = _distinct(table)
        values = []
        got = {(r["kind"], r["bucket"]): r["values"] for r in answers.to_pylist()}
        for kind, own in enumerate(keys):
            b = _buckets_of(kind, own, buckets)
            v = np.empty(len(own))
            for k, at in _dealt(own, b, buckets):
                v[at] = _unpress(got[kind, k], "<i8" if kind == WORD else "<f4")
            values.append(v)
        out, places = [], [_Places(k) for k in keys]
        for lo, hi, data, off in t.chunks(table["text"].combine_chunks()):
            h, where, grams, border = _tokens(data, off)
            c = values[WORD][places[WORD](h)]
            p = np.concatenate(([0.0], np.cumsum(np.log10(c + 0.1) - spread)))
            n = np.diff(where)
            s = np.add.reduceat(values[GRAM][places[GRAM](grams)], border[:-1])
            out.append(pa.table([table["doc_id"].combine_chunks().slice(lo, hi - lo), table["held_out"].combine_chunks().slice(lo, hi - lo), pa.array(n), pa.array(t.per_doc(c > 0, where)), pa.array(np.full(hi - lo, n_train)), pa.array(p[where[1:]] - p[where[:-1]]), pa.array(s), pa.array(np.diff(border))], names))
        return pa.concat_tables(out)

    return go


def score_texts(docs: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = 5, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every text's log10 probability under the model and under a smoothed unigram base.

    The model learns from the documents whose crc32(doc_id as text) mod 10 is not 0. Columns: doc_id,
    held_out, n_tokens (words and one end), n_known, train_tokens, base_score, score, n_symbols.
    """
    t.tuned(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(1, -(-total // block_bytes)), max(16, -(-total // bucket_bytes))
    counts = t.checkpoint(_counts(docs, buckets))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(2, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                c = _unpress(x, "<i8")
                n += (c.sum(), (c > 0).sum())
        yield pa.record_batch([pa.array([n[0]]), pa.array([n[1]])], ["n", "v"])

    n_train, n_distinct = counts.where(F.col("kind") == WORD).select("counts").mapInArrow(tokens, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    grams = _model(counts, burn_in, samples, seed, buckets)
    known = counts.where(F.col("kind") == WORD).select("bucket", "kind", "keys", F.col("counts").alias("values"), F.lit(1).alias("samples"))
    known = known.unionByName(grams)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    asked = docs.groupBy("block").applyInArrow(_ask(buckets), _ASK)
    answers = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_answer, _ANSWER)
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_symbols long"
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(buckets, n_train or 0, n_distinct or 0), result)
