"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared as lower-case alphanumeric words with single spaces. A benchmark item is cut into
overlapping segments of 80 bytes that start every 8, so an exact passage of 87 normalised bytes or more
holds a whole one wherever it lies in the item (a shorter one may be missed; an item of up to 80 bytes
is one segment). A segment of n bytes with at most k edits in a document shares at least
n - q + 1 - k * q of its q-grams with it, all on diagonals at most k apart. So q-grams are looked up
by item, spread to the segments where the item has enough of them, counted in overlapping bands of diagonals, and only bands that reach the bound are aligned.

The benchmark is the stated query set: it is fetched in blocks of bounded size, and each block is one
pass over all documents, without a shuffle.

Defined cases: null and empty texts and items match nothing; an item shorter than q bytes is
ignored, and so is one without an id, since no result could name it; an item that is repeated counts once;
repeated documents and those without an id are each reported; a very long text is searched whole; an empty
table gives no rows, and an empty benchmark matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t

Q = 8
SEGMENT = 80
STEP = 8
#: edits allowed, as a share of the segment
EDITS = 0.1
BLOCK_BYTES = 4 << 20
_BITS = 22


_CELL = 512
SEGMENT_SPOTS = 128


def _cell_slot(cell: np.ndarray, seg: np.ndarray) -> np.ndarray:
    return ((cell * 0x9E3779B1 + seg * 0x85EBCA77).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _BITS)).astype(np.int64)


def normalised(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case alphanumeric bytes with one space between words, and the new offsets."""
    if not len(data):
        return data, off
    low = t.LOWER[data]
    inside = t.ALNUM[low]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    keep = inside | before
    low[~inside] = 0x20
    return low[keep], np.concatenate(([0], np.cumsum(keep)))[off]


def _grams(data: np.ndarray) -> np.ndarray:
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    return np.ndarray((len(data) - Q + 1,), "<u8", data, strides=(1,)).copy()


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)


class Index:
    """q-grams of a block of benchmark items, with the segments and places where they occur."""

    def __init__(self, items: list[tuple[int, str]], segment: int = SEGMENT, step: int = STEP, edits: float = EDITS):
        self.item, self.data, whole, begin = [], [], [], []
        for name, text in items:
            data, _ = normalised(*t.buffers(pa.array([text or ""])))
            data = data[: len(data) - (len(data) > 0 and data[-1] == 0x20)]
            if len(data) < Q:
                continue
            for at in sorted({*range(0, max(1, len(data) - segment + 1), step), max(0, len(data) - segment)}):
                self.item.append(name)
                self.data.append(data[at : at + segment])
                begin.append(at)
            whole.append((data, len(self.item)))
        begin = np.array(begin, np.int64)
        self.length = np.array([len(x) for x in self.data], np.int64)
        # with at least three q-grams left to share
        self.edits = np.maximum(0, np.minimum((edits * self.length).astype(np.int64), (self.length - Q - 2) // Q))
        self.least = np.maximum(1, self.length - Q + 1 - self.edits * Q)
        grams = [_grams(x) for x, _ in whole]
        size = [len(g) for g in grams]
        flat, text = np.concatenate(grams or [np.zeros(0, np.uint64)]), np.repeat(np.arange(len(grams)), size)
        spot = np.concatenate([np.arange(n) for n in size] or [np.zeros(0, np.int64)])
        # the segments that hold a place of an item follow each other: they start at most at it, and end at least behind its q-gram
        last = np.array([n for _, n in whole], np.int64)
        first = np.concatenate(([0], last[:-1]))
        key = np.repeat(np.arange(len(whole)), last - first) << 32
        low, high = np.searchsorted(key + begin + self.length, (text << 32) + spot + Q), np.searchsorted(key + begin, (text << 32) + spot, "right")
        order = np.argsort(flat, kind="stable")
        self.gram, self.begin = np.unique(flat[order], return_index=True)
        self.begin = np.append(self.begin, len(flat))
        self.text, self.spot, self.low, self.high, self.start = text[order], spot[order], low[order], high[order], begin
        self.text_least = np.minimum.reduceat(self.least, first) if len(whole) else self.least
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[_slot(self.gram)] = True

    def search(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, segment) pairs of the normalised texts that hold a segment within its edits."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.gram):
            return none
        grams = _grams(data)
        at = np.flatnonzero(self.filter[_slot(grams)])
        k = np.minimum(np.searchsorted(self.gram, grams[at]), len(self.gram) - 1)
        real = self.gram[k] == grams[at]
        at, k = at[real], k[real]
        # places around which there can't be enough shared q-grams
        span, fewest = int((self.length + self.edits).max()), int(self.least.min())
        near = np.searchsorted(at, at + span, "right") - np.searchsorted(at, at - span)
        at, k = at[near >= fewest], k[near >= fewest]
        if not len(at):
            return none
        doc = np.searchsorted(off, at, "right") - 1
        inside = at + Q <= off[doc + 1]
        at, k, doc = at[inside], k[inside], doc[inside]
        times = self.begin[k + 1] - self.begin[k]
        post = np.repeat(self.begin[k] - np.cumsum(times) + times, times) + np.arange(times.sum())
        at, doc = np.repeat(at, times), np.repeat(doc, times)
        rest = self._enough(at, self.text[post], self.text_least)
        at, doc, post = at[rest], doc[rest], post[rest]
        times = self.high[post] - self.low[post]
        seg = np.repeat(self.low[post] - np.cumsum(times) + times, times) + np.arange(times.sum())
        at, doc, spot = np.repeat(at, times), np.repeat(doc, times), np.repeat(self.spot[post], times) - self.start[seg]
        rest = self._enough(at, seg, self.least)
        if not len(rest):
            return none
        at, doc, seg, spot = at[rest], doc[rest], seg[rest], spot[rest]
        # bands of 2 (k + 1) diagonals start every k + 1, so that each diagonal lies in two
        band = (at - spot + len(data)) // (self.edits[seg] + 1)
        bands = 2 * len(data) + 2
        key = ((np.concatenate((seg, seg)) * (len(off) - 1) + np.concatenate((doc, doc))) * bands + np.concatenate((band, band - 1)) + 1) * SEGMENT_SPOTS + np.concatenate((spot, spot))
        key.sort()
        key = key[np.append(True, key[1:] != key[:-1])] // SEGMENT_SPOTS  # a place of the segment counts once in a band
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count, key = np.diff(np.append(first, len(key))), key[first]
        band = key % bands - 1
        seg, doc = np.divmod(key // bands, len(off) - 1)
        enough = count >= self.least[seg]
        seg, doc, band = seg[enough], doc[enough], band[enough]
        low = band * (self.edits[seg] + 1) - len(data)  # the band's first diagonal
        good = self.aligned(data, off, doc, seg, low)
        pair = np.unique(np.stack((doc[good], seg[good])), axis=1)
        return pair[0], pair[1]

    @staticmethod
    def _enough(at: np.ndarray, owner: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which shared q-grams at these places may belong to an alignment with their owner."""
        # shared q-grams of an alignment lie in two neighbouring cells of the text; hashed counts of a cell
        # are never too small, so what can't reach the bound in any two goes before the sort
        cell = at // _CELL
        own = _cell_slot(cell, owner)
        held = np.bincount(own, minlength=1 << _BITS)
        most = held[own] + np.maximum(held[_cell_slot(cell + 1, owner)], held[_cell_slot(cell - 1, owner)])
        return np.flatnonzero(most >= least[owner])

    def aligned(self, data: np.ndarray, off: np.ndarray, doc: np.ndarray, seg: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Whether each candidate band holds an alignment within the segment's edits; ends in the text are free."""
        good = np.zeros(len(doc), bool)
        shape = self.length[seg] * 4096 + self.edits[seg]
        for s in np.unique(shape):
            own = np.flatnonzero(shape == s)
            n, k = int(s) // 4096, int(s) % 4096
            for part in np.array_split(own, -(-len(own) // 4096)):
                d = doc[part]
                text = np.stack([self.data[x] for x in seg[part]])
                place = (low[part] - k)[:, None] + np.arange(2 * (k + 1) + 2 * k)
                cost = np.zeros(place.shape, np.int64)
                step = np.arange(place.shape[1])
                for i in range(n):
                    p = place + i
                    held = (p >= off[d][:, None]) & (p < off[d + 1][:, None])
                    differs = ~held | (data[np.clip(p, 0, len(data) - 1)] != text[:, i][:, None])
                    skip = np.full_like(cost, n)
                    skip[:, :-1] = cost[:, 1:] + 1  # the segment's byte has no partner
                    best = np.minimum(cost + differs, skip)
                    cost = np.minimum.accumulate(best - step, axis=1) + step  # bytes of the text without partner
                good[part] = cost.min(1) <= k
        return good


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null and item_id is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()]


def _hits(arr: pa.Array, index: Index) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, data, off in t.chunks(arr):
        yield lo, hi, *index.search(*normalised(data, off))


def contamination(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: whether it holds benchmark passages, how many segments, and of which items."""
    spark = t.tuned(docs.sparkSession)
    kind = "doc_id long, text string, n_segments long, items array<long>"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_segments"), F.array().cast("array<long>").alias("items"))
    for items in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(Index(items, edits=edits))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for b in batches:
                count, names = b.column(2).to_pylist(), b.column(3).to_pylist()
                for lo, _, doc, seg in _hits(b.column(1), index):
                    for d, s in zip(doc.tolist(), seg.tolist(), strict=True):
                        count[lo + d] += 1
                        names[lo + d].append(index.item[s])
                yield pa.record_batch([b.column(0), b.column(1), pa.array(count, pa.int64()), pa.array(names, pa.list_(pa.int64()))], ["doc_id", "text", "n_segments", "items"])

        out = out.mapInArrow(run, kind)
    items = F.sort_array(F.array_distinct("items"))
    return out.select("doc_id", (F.col("n_segments") > 0).alias("contaminated"), "n_segments", F.size(items).cast("long").alias("n_items"), F.array_join(items.cast("array<string>"), ",").alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without benchmark passages, with all their columns, in the same pass over them."""
    spark = t.tuned(docs.sparkSession)
    at = docs.columns.index("text")
    out = docs
    for items in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(Index(items, edits=edits))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for lo, _, doc, _ in _hits(b.column(at), sent.value):
                    clean[lo + doc] = False
                yield b.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
