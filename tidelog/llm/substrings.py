"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller id.

Every 50-byte string holds an anchor: the smallest hash among its 24-byte grams, so equal strings have
equal anchors at equal places. Whole copies of an earlier document are found first, by a narrow join of
text digests. The other documents are dealt into blocks of a few megabytes. A block sends each distinct
anchor once, with its first and last document and how many surroundings it has; the anchor's bucket answers
which anchors occur in several documents, and only of these the surroundings are sent as bytes, once each from
a block. There equal surroundings are recognised by their bytes, the suffixes of the distinct ones are
sorted in two stages, adjacent common prefixes of 50 bytes or more form runs, and a suffix whose run
holds a smaller id is covered. Hashes only choose what is sent; what is removed has been compared byte by
byte, but for whole copies (SHA-256 of the text) and hot anchors (see below).

A hot anchor (a frequent line, with other text around it in every document) has more surroundings than
one task should hold, as their numbers tell; then the 50-byte strings around its gram are dealt out by their own hashes, each distinct string once from
each block with its smallest document. So only equal strings meet, and no group grows with the number
of documents but with the number of blocks.

Defined cases: a null text is empty; a text under 50 bytes keeps all; equal ids don't cover each
other; a document without an id keeps all and covers none; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t
from tidelog.llm.suffixes import common_prefixes, needed, suffix_array

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 6 << 20
#: anchors that one bucket holds, about
BUCKET_ANCHORS = 250_000
#: surroundings of one anchor in a block, and in all of them together, beyond which the anchor is hot
BLOCK_MOST, BUCKET_MOST = 64, 8192
#: columns of a document's block and of its text's hash, named so that they meet no column of the documents
BLOCK, DIGEST = "__tidelog_block", "__tidelog_digest"
_SLICE = 1 << 18
#: anchors are least hashes, so their own bits are not even; mixed again, they are
_SALT = np.uint64(0x6A09E667F3BCC909)


class _Anchors:
    """The anchors of a block's documents, in order of (document, place)."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending")])
        self.doc_id = table["doc_id"].to_numpy()
        self.data, self.off = t.buffers(table["text"])
        at, key, surroundings = [], [], []
        for a in range(0, len(self.data), _SLICE):
            for got, x in zip((at, key, surroundings), self._of_slice(a), strict=True):
                got.append(x)
        at = np.concatenate(at or [np.zeros(0, np.int64)])
        self.at, one = np.unique(at, return_index=True)  # neighbouring slices share a few
        empty = [np.zeros(0, np.uint64)]
        self.key, around = np.concatenate(key or empty)[one], np.concatenate(surroundings or empty)[one]
        self.doc = np.searchsorted(self.off, self.at, "right") - 1
        self.start = np.maximum(self.at - (LENGTH - GRAM), self.off[self.doc])
        self.end = np.minimum(self.at + LENGTH, self.off[self.doc + 1])
        # anchors that agree in these bits by chance only send more surroundings to the sort
        self.low = self.key & np.uint64(0xFFFFFFFF)
        self.name = t.mix(self.key * np.uint64(0x9E3779B97F4A7C15) + around)
        # the first place of each (anchor, surroundings) in the block: that of its smallest document
        _, self.first, back = np.unique(self.name, return_index=True, return_inverse=True)
        self.earlier = self.doc_id[self.doc[self.first]][back] < self.doc_id[self.doc] if len(self.at) else np.zeros(0, bool)
        own = np.flatnonzero(self.earlier)
        one = self.first[back[own]] if len(own) else own
        size = self.end - self.start
        self.earlier[own] = (size[own] == size[one]) & _equal(self.data, self.start[own], self.data, self.start[one], np.minimum(size[own], size[one]))

    def _of_slice(self, a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        off, left = self.off, LENGTH - GRAM
        lo, hi = max(0, a - left), min(len(self.data), a + _SLICE + left + LENGTH)
        data = self.data[lo:hi]
        prefix = t.prefix_hash(data)
        n = len(data) - GRAM + 1
        none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if n <= 0:
            return none
        where = np.arange(n)
        gram = t.span_hash(prefix, where, where + GRAM)
        value = (gram & np.uint64(0xFFFFFFFFFF000000)) | where.astype(np.uint64)  # ties go to the leftmost
        width = LENGTH - GRAM + 1
        least, size = value, 1
        while 2 * size <= width:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        least = np.minimum(least[: len(value) - width + 1], least[width - size :]) if len(value) >= width else least[:0]
        begin = np.arange(len(least)) + lo
        doc = np.minimum(np.searchsorted(off, begin, "right") - 1, len(off) - 2)
        inside = (begin >= a) & (begin < a + _SLICE) & (begin + LENGTH <= off[doc + 1])
        at = t.distinct((least[inside] & np.uint64(0xFFFFFF)).astype(np.int64))
        doc = np.searchsorted(off, at + lo, "right") - 1
        start = np.maximum(at + lo - left, off[doc]) - lo
        end = np.minimum(at + lo + LENGTH, off[doc + 1]) - lo
        around = t.mix(t.span_hash(prefix, start, end) + (at - start).astype(np.uint64))
        return at + lo, gram[at], around

    def strings(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the strings around the grams of hot anchors."""
        hot = np.isin(self.low, _names(answers, HOT).astype(np.uint64)) & (self.end - self.start >= LENGTH)
        n = len(self.data)
        first, last = self.start[hot], np.minimum(self.at, self.end - LENGTH)[hot]
        start = np.flatnonzero(np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1)))
        value = np.empty(len(start), np.uint64)
        for a in range(0, n, _SLICE):
            lo, hi = np.searchsorted(start, (a, a + _SLICE))
            if lo < hi:
                own = start[lo:hi] - a
                value[lo:hi] = t.span_hash(t.prefix_hash(self.data[a : a + _SLICE + LENGTH]), own, own + LENGTH)
        return start, value

    def bucket(self, which: np.ndarray, buckets: int) -> np.ndarray:
        return (t.mix(self.key[which] + _SALT) % np.uint64(buckets)).astype(np.int64)


def _equal(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from each place of a are those from its partner in b."""
    out = np.ones(len(at), bool)
    for lo in range(0, len(at), 1 << 14):
        x, y, n = at[lo : lo + (1 << 14)], to[lo : lo + (1 << 14)], size[lo : lo + (1 << 14)]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        differs = a[np.repeat(x, n) + step] != b[np.repeat(y, n) + step]
        out[lo : lo + (1 << 14)] = np.bincount(np.repeat(np.arange(len(n)), n), differs, len(n)) == 0
    return out


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run."""
    if not len(sorted_values):
        return
    first = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    for s, e in zip(first, [*first[1:], len(sorted_values)], strict=True):
        yield int(sorted_values[s]), int(s), int(e)


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)], names)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, so that the high ones, mostly alike, compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplaned(blob: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, -1).T).view(kind).ravel()


_SENT = ["bucket", "block", "anchor", "doc", "n", "ids"]
_SENT_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
_ANSWER = "block int, kind int, blob binary"
_ANSWER_TYPES = [pa.int32(), pa.int32(), pa.binary()]
COPY, WANTED, PARTS, HOT, STRINGS = 0, 1, 2, 3, 4


def _own(table: pa.Table, answers: pa.Table) -> tuple[pa.Table, pa.Table]:
    """A block's documents that aren't whole copies of earlier ones, and those that are."""
    known = {x for k, x in zip(answers["kind"].to_pylist(), answers["blob"].to_pylist(), strict=True) if k == COPY}
    if not known:
        return table, table.slice(0, 0)
    names = zip(table["doc_id"].to_pylist(), table[DIGEST].to_pylist(), strict=True)
    copy = pa.array([f"{i}:{h}".encode() in known for i, h in names], pa.bool_())
    return table.filter(pc.invert(copy)), table.filter(copy)


def _send(buckets: int):
    def go(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, _ = _own(table, answers)
        if not table.num_rows:
            return _table([], _SENT, _SENT_TYPES)
        block = table[BLOCK][0].as_py()
        a = _Anchors(table)
        order = np.argsort(a.key, kind="stable")
        head = np.append(True, a.key[order][1:] != a.key[order][:-1]) if len(order) else np.zeros(0, bool)
        one = np.flatnonzero(head)
        first, last = order[one], order[np.append(one[1:], len(order)) - 1] if len(one) else order  # in order of documents
        fresh = np.zeros(len(order), bool)
        fresh[a.first] = True
        n = np.minimum(np.add.reduceat(fresh[order], one, dtype=np.int64) if len(one) else one, BLOCK_MOST + 1)
        b = a.bucket(first, buckets)
        order = np.argsort(b, kind="stable")
        rows = []
        for k, s, e in _runs(b[order]):
            x = order[s:e]
            low = a.low[first[x]]
            sort = np.argsort(low, kind="stable")
            x, low = x[sort], low[sort]
            docs, doc = np.unique(np.concatenate((a.doc[first[x]], a.doc[last[x]])), return_inverse=True)
            least, most = doc.reshape(2, -1)
            rows.append((k, block, _planes(np.diff(low, prepend=np.uint64(0)).astype("<u4")), _planes(least.astype("<u4")) + _planes((most - least).astype("<u4")), n[x].astype("<u1").tobytes(), a.doc_id[docs].astype("<i8").tobytes()))
        return _table(rows, _SENT, _SENT_TYPES)

    return go


def _meet(table: pa.Table) -> pa.Table:
    """What a bucket's anchors tell each block: of which the surroundings are wanted as bytes, since another document has the anchor, and which are hot."""
    block, low, least, most, n = [], [], [], [], []
    for r in table.to_pylist():
        low.append(np.cumsum(_unplaned(r["anchor"], "<u4"), dtype=np.uint64).astype("<u4"))
        half = len(r["doc"]) // 2
        at, further = _unplaned(r["doc"][:half], "<u4"), _unplaned(r["doc"][half:], "<u4")
        ids = np.frombuffer(r["ids"], "<i8")
        least.append(ids[at])
        most.append(ids[at + further])
        n.append(np.frombuffer(r["n"], "<u1").astype(np.int64))
        block.append(np.full(len(low[-1]), r["block"], np.int32))
    block, low, least, most, n = map(np.concatenate, (block, low, least, most, n))
    order = np.argsort(low, kind="stable")
    block, low, least, most, n = block[order], low[order], least[order], most[order], n[order]
    head = np.append(True, low[1:] != low[:-1])
    anchor, first = np.cumsum(head) - 1, np.flatnonzero(head)
    several = (np.minimum.reduceat(least, first) < np.maximum.reduceat(most, first))[anchor]
    hot = ((np.add.reduceat(n, first) > BUCKET_MOST) | (np.maximum.reduceat(n, first) > BLOCK_MOST))[anchor]
    rows = []
    for kind, mask in ((WANTED, several & ~hot), (HOT, hot)):
        own = np.flatnonzero(mask)
        own = own[np.argsort(block[own], kind="stable")]
        rows += [(b, kind, low[own[s:e]].tobytes()) for b, s, e in _runs(block[own])]
    return _table(rows, ["block", "kind", "blob"], _ANSWER_TYPES)


def _names(answers: pa.Table, kind: int) -> np.ndarray:
    """The anchors' low bits (wanted, hot) or the strings' hashes of one kind, sorted."""
    blobs = [b for k, b in zip(answers["kind"].to_pylist(), answers["blob"].to_pylist(), strict=True) if k == kind]
    return np.sort(np.frombuffer(b"".join(blobs), "<u8" if kind == STRINGS else "<u4"))


_PASSAGES = ["bucket", "block", "name", "doc", "size", "data"]
_PASSAGE_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _passages(buckets: int):
    """The wanted surroundings as bytes, and the hashes of hot anchors' strings (in buckets below 0), each once."""

    def go(table: pa.Table, answers: pa.Table) -> pa.Table:
        want = _names(answers, WANTED)
        table, _ = _own(table, answers)
        if not (len(want) or len(_names(answers, HOT))) or not table.num_rows:
            return _table([], _PASSAGES, _PASSAGE_TYPES)
        a = _Anchors(table)
        own = a.first[np.isin(a.low[a.first], want.astype(np.uint64))]
        b = a.bucket(own, buckets)
        order = np.argsort(b, kind="stable")
        rows = []
        for k, s, e in _runs(b[order]):
            x = own[order[s:e]]
            size = a.end[x] - a.start[x]
            place = np.repeat(a.start[x] - np.cumsum(size) + size, size) + np.arange(size.sum())
            rows.append((k, table[BLOCK][0].as_py(), a.name[x].astype("<u8").tobytes(), a.doc_id[a.doc[x]].astype("<i8").tobytes(), size.astype("<u1").tobytes(), a.data[place].tobytes()))
        start, value = a.strings(answers)
        value, first = np.unique(value, return_index=True)  # the first place is that of the smallest document
        doc = a.doc_id[np.searchsorted(a.off, start[first], "right") - 1].astype("<i8")
        b = (value % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        for k, s, e in _runs(b[order]):
            rows.append((-1 - k, table[BLOCK][0].as_py(), value[order[s:e]].astype("<u8").tobytes(), doc[order[s:e]].tobytes(), b"", b""))
        return _table(rows, _PASSAGES, _PASSAGE_TYPES)

    return go


def covered_starts(data: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Places of the passages' ``length``-byte strings that also start in a passage of a smaller document."""
    depth = -(-length // 8) * 8
    gap = 1  # a zero byte after each passage
    off = np.concatenate(([0], np.cumsum(size + gap)))
    text = np.zeros(off[-1] + depth + 8, np.uint8)
    place = np.repeat(off[:-1] - np.cumsum(size) + size, size) + np.arange(len(data))
    text[place] = data + 1  # UTF-8 has no byte 255, so this keeps their order
    owner = np.repeat(np.arange(len(size)), size)
    whole = place + length <= (off[1:] - gap)[owner]
    wanted = np.zeros(len(text), bool)
    wanted[place[whole]] = True
    order = suffix_array(text, needed(text, wanted), depth)
    order = order[wanted[order]]
    if not len(order):
        return order
    new = np.append(True, common_prefixes(text, order, depth) < length)
    run = np.cumsum(new) - 1
    of = doc[np.searchsorted(off, order, "right") - 1]
    least = np.minimum.reduceat(of, np.flatnonzero(new))
    hit = np.sort(order[least[run] < of])
    return hit - (np.searchsorted(off, hit, "right") - 1) * gap


def _meet_strings(table: pa.Table) -> pa.Table:
    """The strings of a bucket that an earlier document of another block has, by block."""
    rows = table.to_pylist()
    value = np.frombuffer(b"".join(r["name"] for r in rows), "<u8")
    doc = np.frombuffer(b"".join(r["doc"] for r in rows), "<i8")
    block = np.repeat([r["block"] for r in rows], [len(r["doc"]) // 8 for r in rows])
    order = np.lexsort((doc, value))
    value, doc, block = value[order], doc[order], block[order]
    head = np.append(True, value[1:] != value[:-1])
    own = np.flatnonzero(doc[np.flatnonzero(head)][np.cumsum(head) - 1] < doc)
    own = own[np.argsort(block[own], kind="stable")]
    return _table([(b, STRINGS, value[own[s:e]].tobytes()) for b, s, e in _runs(block[own])], ["block", "kind", "blob"], _ANSWER_TYPES)


def _sort(table: pa.Table) -> pa.Table:
    """A bucket's passages through the suffix array; the covered parts, by block. Buckets below 0 hold strings."""
    if table["bucket"][0].as_py() < 0:
        return _meet_strings(table)
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    name = np.frombuffer(b"".join(r["name"] for r in rows), "<u8")
    doc = np.frombuffer(b"".join(r["doc"] for r in rows), "<i8")
    size = np.frombuffer(b"".join(r["size"] for r in rows), np.uint8).astype(np.int64)
    block = np.repeat([r["block"] for r in rows], [len(r["size"]) for r in rows])
    data = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
    off = np.concatenate(([0], np.cumsum(size)))
    # passages of one name are one passage if their bytes are equal; its first document is the smallest
    order = np.lexsort((doc, name))
    head = np.append(True, name[order][1:] != name[order][:-1])
    one = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    same = (size[order] == size[one]) & _equal(data, off[order], data, off[one], np.minimum(size[order], size[one]))
    later = np.zeros(len(name), bool)
    later[order] = same & (doc[order] > doc[one])
    own = np.zeros(len(name), bool)
    own[order] = head | ~same
    own = np.flatnonzero(own)
    place = np.repeat(off[own] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
    hit = covered_starts(data[place], size[own], doc[own])
    begin = np.concatenate(([0], np.cumsum(size[own])))
    of = np.searchsorted(begin, hit, "right") - 1
    head = np.ones(len(hit), bool)
    head[1:] = (hit[1:] != hit[:-1] + 1) | (of[1:] != of[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
    whole = np.flatnonzero(later & (size >= LENGTH))
    part = np.zeros(len(first) + len(whole), [("name", "<u8"), ("start", "<u2"), ("end", "<u2")])
    part["name"], part["start"] = np.concatenate((name[own[of[first]]], name[whole])), np.concatenate((hit[first] - begin[of[first]], np.zeros(len(whole), np.int64)))
    part["end"] = np.concatenate((hit[last] - begin[of[last]] + LENGTH, size[whole]))
    to = np.concatenate((block[own[of[first]]], block[whole]))
    order = np.argsort(to, kind="stable")
    part, to = part[order], to[order]
    out = [(b, PARTS, part[s:e].tobytes()) for b, s, e in _runs(to)]
    return _table(out, ["block", "kind", "blob"], _ANSWER_TYPES)


def _covered(a: _Anchors, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the block's maximal covered runs."""
    whole = a.earlier & (a.end - a.start >= LENGTH)
    start, end = [a.start[whole]], [a.end[whole]]
    blobs = [b for k, b in zip(answers["kind"].to_pylist(), answers["blob"].to_pylist(), strict=True) if k == PARTS]
    part = np.frombuffer(b"".join(blobs), [("name", "<u8"), ("start", "<u2"), ("end", "<u2")])
    if len(part):
        order = np.argsort(a.name, kind="stable")
        sorted_names = a.name[order]
        lo, hi = np.searchsorted(sorted_names, part["name"]), np.searchsorted(sorted_names, part["name"], "right")
        which = np.repeat(np.arange(len(part)), hi - lo)
        at = a.start[order[np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange(len(which))]]
        start.append(at + part["start"][which])
        end.append(at + part["end"][which])
    at, value = a.strings(answers)
    if len(at):
        _, first, back = np.unique(value, return_index=True, return_inverse=True)
        of = a.doc_id[np.searchsorted(a.off, at, "right") - 1]
        at = at[(of[first][back] < of) | np.isin(value, _names(answers, STRINGS))]
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1)[: len(at)])
        start.append(at[head])
        end.append(at[np.append(head[1:], len(at)) - 1] + LENGTH if len(at) else at)
    start, end = np.concatenate(start), np.concatenate(end)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(order) else end
    doc = np.searchsorted(a.off, start, "right") - 1
    head = np.ones(len(start), bool)
    head[1:] = (start[1:] > end[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    return start[first], end[np.append(first[1:], len(start)) - 1] if len(first) else end, doc[first]


def _kept(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each of n bytes lies outside all of the runs."""
    change = np.zeros(n + 1, np.int8)
    change[start] = 1
    change[end] -= 1
    return np.cumsum(change[:-1], dtype=np.int8) == 0


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
_EMPTY = hashlib.sha256().hexdigest()


def _result(table: pa.Table, answers: pa.Table) -> pa.Table:
    table, copies = _own(table, answers)
    size = pc.binary_length(copies["text"]).cast(pa.int64()).combine_chunks()
    out = [pa.table([copies["doc_id"].combine_chunks(), size, size, pa.array(np.ones(len(size), np.int64)), pa.array([_EMPTY] * len(size), pa.string())], _NAMES)]
    if table.num_rows:
        a = _Anchors(table)
        start, end, doc = _covered(a, answers)
        n = len(a.doc_id)
        keep = _kept(len(a.data), start, end)
        sha = [hashlib.sha256(a.data[s:e][keep[s:e]].tobytes()).hexdigest() for s, e in zip(a.off[:-1], a.off[1:], strict=True)]
        removed = np.bincount(doc, end - start, n).astype(np.int64)
        out.append(pa.table([pa.array(a.doc_id), pa.array(np.diff(a.off)), pa.array(removed), pa.array(np.bincount(doc, minlength=n)), pa.array(sha)], _NAMES))
    return pa.concat_tables(out)


def _cut(columns: list[str], schema: pa.Schema):
    """The documents with their covered bytes removed; a character that loses a byte goes whole."""

    def go(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, copies = _own(table, answers)
        cut = pa.table([pa.array([""] * copies.num_rows, pa.string()) if c == "text" else copies[c].combine_chunks() for c in columns], columns)
        if not table.num_rows:
            return cut
        table = table.sort_by([("doc_id", "ascending")])
        a = _Anchors(table)
        start, end, doc = _covered(a, answers)
        inner = np.append(a.data, np.uint8(0)) & 0xC0 == 0x80
        for _ in range(3):
            start = start - inner[start]
            end = end + ((end < a.off[doc + 1]) & inner[end])
        keep = np.ones(len(a.data), bool)
        for s, e in zip(start.tolist(), end.tolist(), strict=True):  # widened runs may touch
            keep[s:e] = False
        less = np.zeros(len(a.doc_id), bool)
        less[doc] = True
        text = [a.data[s:e][keep[s:e]].tobytes().decode() if n else x for s, e, n, x in zip(a.off[:-1], a.off[1:], less, table["text"].to_pylist(), strict=True)]
        return pa.concat_tables([cut, pa.table([pa.array(text, pa.string()) if c == "text" else table[c].combine_chunks() for c in columns], columns)])

    return go


def _copies(docs: DataFrame) -> DataFrame:
    """(block, kind, blob) of the documents whose whole text an earlier document has: narrow rows, no text is exchanged."""
    narrow = docs.where(F.octet_length("text") >= LENGTH).select("doc_id", BLOCK, DIGEST, F.sha2("text", 256).alias("_sha"))
    first = narrow.groupBy("_sha").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last").select("_sha", "_first")
    own = narrow.join(first, "_sha").where("doc_id > _first")
    return own.select(F.col(BLOCK).alias("block"), F.lit(COPY).alias("kind"), F.concat_ws(":", F.col("doc_id").cast("string"), F.col(DIGEST).cast("string")).cast("binary").alias("blob"))


def _answers(docs: DataFrame, block_bytes: int, bucket_anchors: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their blocks, and what is to be known of each block."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(1, -(-total // block_bytes)), int(max(16, total * 2 / (LENGTH - GRAM + 2) // bucket_anchors))
    docs = docs.withColumn(BLOCK, F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).withColumn(DIGEST, F.xxhash64("text"))
    copies = _copies(docs)
    # all passes read the documents with the same columns, so they share one exchange
    sent = docs.groupBy(BLOCK).cogroup(copies.groupBy("block")).applyInArrow(_send(buckets), "bucket int, block int, anchor binary, doc binary, n binary, ids binary")
    known = copies.unionByName(sent.groupBy("bucket").applyInArrow(_meet, _ANSWER))
    wanted = docs.groupBy(BLOCK).cogroup(known.groupBy("block")).applyInArrow(_passages(buckets), "bucket int, block int, name binary, doc binary, size binary, data binary")
    return docs, known.unionByName(wanted.groupBy("bucket").applyInArrow(_sort, _ANSWER))


def repeated_bytes(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    t.tuned(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.lit(0).cast("long")
    unnamed = docs.where("doc_id is null").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
    docs, answers = _answers(docs.where("doc_id is not null"), block_bytes, bucket_anchors)
    return docs.groupBy(BLOCK).cogroup(answers.groupBy("block")).applyInArrow(_result, _RESULT).unionByName(unnamed)


def cut_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    """The documents, with all their columns, without the bytes that ``repeated_bytes`` removes."""
    from pyspark.sql.pandas.types import to_arrow_schema

    t.tuned(docs.sparkSession)
    columns, schema = docs.columns, docs.schema
    unnamed = docs.where("doc_id is null")
    docs, answers = _answers(docs.where("doc_id is not null"), block_bytes, bucket_anchors)
    return docs.groupBy(BLOCK).cogroup(answers.groupBy("block")).applyInArrow(_cut(columns, to_arrow_schema(schema)), schema).unionByName(unnamed)
