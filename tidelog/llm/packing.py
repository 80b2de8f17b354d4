"""Best-fit packing of token sequences by hierarchical residual packing.

Every document is tokenized once, in place; only lengths take part in packing. Partitions pack
their pieces by best fit (longest first), emit the bins that are nearly full and pass the underfull
ones on as items. Rounds of best fit over those items follow on ever fewer partitions, each of a
bounded number of items, until one partition holds the rest or a round stops gaining.

Tokens of a text are the concatenation of its units' tokens: white-space words, divided between letters
and ASCII signs, where the tokenizer always divides them too. Each worker looks up distinct units once
and keeps them in a bounded cache; units of letters only are encoded many at a time, divided by spaces.

Defined cases: a null or empty text is one piece with the end id alone; equal texts and ties are
packed like any others; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t

CAPACITY = 4096
END_ID = 1
#: a bin with at most this many free places is full enough to be emitted
NEARLY_FULL = 8
#: items that one partition packs in a round
NODE_ITEMS = 16_384
#: distinct units that a worker keeps, about 60 bytes each
CACHE_UNITS = 1_000_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_LETTER, _SIGN, _OTHER = 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[0x27, *range(0x30, 0x3A)]] = _OTHER  # apostrophes and digits stay with what is beside them
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[t.SPACE] = 0


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; starts, ends and borders of the units; which units are letters only.

    Texts that hold ``<|`` may name special tokens, so their chunk's units are whole words as they are.
    """
    if not len(data) or (data[:-1][data[1:] == 0x7C] == 0x3C).any():
        start, end, border = t.words(data, off)
        return data, start, end, border, np.zeros(len(start), bool)
    kind = _CLASS[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # U+00C0 to U+00FF are letters but for two
    kind[latin] = kind[latin + 1] = _LETTER
    cut = np.ones(len(data) + 1, bool)  # between the bytes
    both = kind[1:] * kind[:-1]
    cut[1:-1] = (both == 0) | (both == _LETTER * _SIGN)
    cut[off] = True
    edge = np.flatnonzero(cut)
    full = kind[edge[:-1]] > 0
    start, end = edge[:-1][full], edge[1:][full]
    other = np.concatenate(([0], np.cumsum(kind == _OTHER)))
    letters = (kind[start] == _LETTER) & (other[end] == other[start])
    return t.LOWER[data], start, end, np.searchsorted(start, off), letters


class _UnitIds:
    """Token ids of units by their 64-bit hash; arrays sorted by hash, emptied when they grow too large."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a pre-token
        self.final[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.hash, self.start, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        count, out = np.zeros(len(texts), np.int64), []
        one = np.flatnonzero(letters)
        for k in range(0, len(one), 512):
            own = one[k : k + 512]
            ids = np.array(self.tokenizer.encode(" ".join([texts[i] for i in own]), add_special_tokens=False).ids, np.uint32)
            count[own] = np.diff(np.flatnonzero(self.final[ids]), prepend=-1)
            out.append((own, ids))
        rest = np.flatnonzero(~letters)
        for k in range(0, len(rest), 512):
            own = rest[k : k + 512]
            got = [x.ids for x in self.tokenizer.encode_batch([texts[i] for i in own], add_special_tokens=False)]
            count[own] = [len(x) for x in got]
            out.append((own, np.array([i for x in got for i in x], np.uint32)))
        flat, begin = np.zeros(count.sum(), np.uint32), np.cumsum(count) - count
        for own, ids in out:
            n = count[own]
            flat[np.repeat(begin[own] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return flat, count

    def look_up(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each unit its place in ``ids`` and its number of ids."""
        own, first, back = np.unique(t.span_hash(t.prefix_hash(data), start, end), return_index=True, return_inverse=True)
        if len(self.hash) > CACHE_UNITS:
            self.clear()
        at = np.minimum(np.searchsorted(self.hash, own), max(0, len(self.hash) - 1))
        new = self.hash[at] != own if len(self.hash) else np.ones(len(own), bool)
        if new.any():
            raw, k = data.tobytes(), first[new]
            flat, count = self._encode([raw[s:e].decode() for s, e in zip(start[k].tolist(), end[k].tolist(), strict=True)], letters[k])
            where = np.searchsorted(self.hash, own[new])
            self.start = np.insert(self.start, where, np.cumsum(count) - count + len(self.ids))
            self.count = np.insert(self.count, where, count)
            self.hash = np.insert(self.hash, where, own[new])
            self.ids = np.concatenate((self.ids, flat))
        k = np.searchsorted(self.hash, own)[back]
        return self.start[k], self.count[k]


#: one cache a tokenizer in each worker, which outlives a task
_caches: dict[str, _UnitIds] = {}


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Each document's token ids and end id, cut into pieces of ``capacity``: place, length and checksum."""
    t.tuned(docs.sparkSession)
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _caches.get(path) or _caches.setdefault(path, _UnitIds(path))
        for b in batches:
            for lo, hi, data, off in t.chunks(b.column(1)):
                low, start, end, border, letters = units(data, off)
                place, count = known.look_up(low, start, end, letters)
                total = np.concatenate(([0], np.cumsum(count)))
                flat = known.ids[np.repeat(place - total[:-1], count) + np.arange(total[-1])].astype("<u4")
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
                ids = b.column(0).slice(lo, hi - lo).to_pylist()
                for d in range(hi - lo):
                    own = np.append(flat[total[border[d]] : total[border[d + 1]]], np.uint32(END_ID)).astype("<u4")
                    for p in range(0, len(own), capacity):
                        x = own[p : p + capacity]
                        for k, v in zip(out, (ids[d], p // capacity, p, len(x), zlib.crc32(x.tobytes())), strict=True):
                            out[k].append(v)
                yield pa.record_batch([pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()], list(out))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: bin and place of each item, and the fill of each bin.

    Open bins are kept by free space; one bit per free space tells which spaces occur, so the
    smallest that suffices is found by shifting.
    """
    order = np.argsort(-lengths, kind="stable")
    bin_of, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        above = bits >> n
        if above:
            space = n + (above & -above).bit_length() - 1
            k = free[space].pop()
            if not free[space]:
                bits &= ~(1 << space)
        else:
            space, k = capacity, len(fill)
            fill.append(0)
        bin_of[i], place[i] = k, fill[k]
        fill[k] += n
        if space > n:
            free[space - n].append(k)
            bits |= 1 << (space - n)
    return bin_of, place, np.array(fill, np.int64)


def _round(items: DataFrame, number: int, nodes: int, capacity: int) -> DataFrame:
    """Packs (item, length) rows on ``nodes`` partitions: item, bin, place in it and the bin's fill."""

    def pack(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        node = table["node"][0].as_py()
        # the items' order decides ties, so that a task that runs again gives the same bins
        order = np.argsort(table["item"].to_numpy(), kind="stable")
        bin_of, place, fill = best_fit(lengths[order], capacity)
        name = (number << 58) + (node << 28) + bin_of
        return pa.table({"item": table["item"].to_numpy()[order], "bin": name, "place": place, "fill": fill[bin_of]})

    node = F.pmod(F.xxhash64("item", F.lit(number)), F.lit(nodes)).cast("long")
    return items.select("item", "length", node.alias("node")).groupBy("node").applyInArrow(pack, "item long, bin long, place long, fill long")


def pack(parts: DataFrame, capacity: int = CAPACITY, node_items: int = NODE_ITEMS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``pieces``."""
    parts = t.checkpoint(parts.withColumn("item", F.monotonically_increasing_id()))  # repeated rows are different items
    n = parts.count()
    number, nodes = 1, max(1, -(-n // node_items))
    first = t.checkpoint(_round(parts.select("item", "length"), number, nodes, capacity))
    # where each underfull bin of the first round has got to so far
    place = first.where(F.col("fill") < capacity - NEARLY_FULL).groupBy("bin").agg(F.max("fill").alias("length"))
    place = place.select(F.col("bin").alias("first_bin"), F.col("bin").alias("now"), F.lit(0).cast("long").alias("shift"), "length")
    place = t.checkpoint(place)
    done, left = None, place.count()
    # a round has as many nodes as its items need, and is only worth its exchange if these are fewer than before
    while (fewer := max(1, -(-left // node_items))) < nodes and left > 1:
        number, nodes = number + 1, fewer
        items = place.groupBy(F.col("now").alias("item")).agg(F.max("length").alias("length"))
        moved = _round(items, number, nodes, capacity).withColumnsRenamed({"item": "now", "place": "more"})
        place = place.drop("length").join(moved, "now").select("first_bin", F.col("bin").alias("now"), (F.col("shift") + F.col("more")).alias("shift"), F.col("fill").alias("length"))
        place = t.checkpoint(place)
        full = place.where(F.col("length") >= capacity - NEARLY_FULL)
        done = full if done is None else done.unionByName(full)
        place = place.where(F.col("length") < capacity - NEARLY_FULL)
        left = place.select("now").distinct().count()
    moved = place if done is None else done.unionByName(place)
    out = parts.join(first.select("item", "bin", "place"), "item").join(moved.select(F.col("first_bin").alias("bin"), "now", "shift"), "bin", "left")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("now", "bin").alias("sequence_id"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All documents, tokenized and packed."""
    return pack(pieces(docs, path, capacity), capacity)
