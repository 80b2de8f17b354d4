"""N-gram Jaccard join by chosen paths.

A text's set is its shingles of five lower-case words. Texts with the same set are one node. Each set
is embedded as 64 minhash tokens; a run samples tokens of the current path's bucket by a hash of the
path, and a set goes on to the sub-bucket of every sampled token that it holds, so that a pair at the
threshold keeps about one common path. Buckets of one set are dropped, small buckets are compared by
brute force on token sketches, larger ones are split again; the number of runs follows from the
target recall at the deepest level. Buckets that stay large there are compared in pairs of bounded
chunks.

Candidate pairs only serve to form candidate groups. Sets at the threshold differ in size by a fifth at
most, so a group is divided into bands of sizes, each a fifth above the last; all pairs of sets of one band, and
of two neighbouring ones, are verified exactly on whole shingle sets, in pairs of chunks bounded by sets
and by bytes. A pair is never emitted, only each set's number of links and a spanning forest of the chunk
pair. So a link between two sets of one candidate group can't be lost, whichever run found the group.

Sets are named by a hash of their shingles, so ids may be missing or repeated. Defined cases: a null text
is empty; a text with one to four words has one shingle of them all; a text without words links to nothing;
a class's id is the smallest id in it, and null if none of its documents has one; repeated rows are
documents of one text; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t
from tidelog.llm.components import components

WORDS = 5
SIMILARITY = 0.8
TOKENS = 64
DEPTH = 3
RECALL = 0.999
#: a bucket of at most this many sets is compared by brute force (72 bytes a set)
BUCKET = 1024
#: sets on either side of an exact comparison, and their bytes of shingles
CHUNK, CHUNK_BYTES = 1024, 8 << 20
#: share of equal tokens from which a pair is a candidate: the threshold less four standard deviations
CANDIDATE = 0.6

_rng = np.random.default_rng(11)
_MULTIPLY = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64)
_COORDINATE = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64)


def shingles(data: np.ndarray, off: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted by text, and the texts' borders in them."""
    data = t.LOWER[data]
    start, end, border = t.words(data, off)
    h = t.span_hash(t.prefix_hash(data), start, end)
    got, at = t.windows(h, border, k)
    doc = t.doc_of(border, len(h))[at] if len(at) else np.zeros(0, np.int64)
    few = np.diff(border)
    for n in range(1, k):  # short texts
        own = np.flatnonzero(few == n)
        if len(own):
            x = np.zeros(len(own), np.uint64)
            for j in range(n):
                x += h[border[own] + j] * t._K[32 + j]
            got, doc = np.concatenate((got, t.mix(x + np.uint64(n)))), np.concatenate((doc, own))
    order = np.lexsort((got, doc)) if len(data) < 65_536 else np.argsort(t.mix(got + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    got, doc = got[order], doc[order]
    fresh = np.ones(len(got), bool)
    fresh[1:] = (got[1:] != got[:-1]) | (doc[1:] != doc[:-1])
    got, doc = got[fresh], doc[fresh]
    order = np.argsort(doc, kind="stable")
    return got[order], np.searchsorted(doc[order], np.arange(len(off)))


def _sums(x: np.ndarray, border: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x)))
    return total[border[1:]] - total[border[:-1]]


def _set_hash(x: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sums(t.mix(x + np.uint64(1)), border).view(np.int64), _sums(t.mix(x ^ np.uint64(0x5BD1E9955BD1E995)), border).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, off in t.chunks(b.column(2)):
            x, border = shingles(data, off)
            n = np.diff(border)
            tokens = np.zeros((len(n), TOKENS), np.uint32)
            full = np.flatnonzero(n)
            if len(full):
                at = border[:-1][full]
                for j in range(TOKENS):
                    tokens[full, j] = np.minimum.reduceat(((x * _MULTIPLY[j] + _ADD[j]) >> np.uint64(32)).astype(np.uint32), at)
            h1, h2 = _set_hash(x, border)
            rows = [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(h1), pa.array(h2), pa.array(n), pa.array([r.tobytes() if k else b"" for r, k in zip(tokens, n, strict=True)], pa.binary())]
            yield pa.record_batch(rows, ["doc_id", "text_hash", "h1", "h2", "n", "tokens"])


def runs_for(recall: float = RECALL, depth: int = DEPTH, similarity: float = SIMILARITY) -> int:
    """Runs after which a pair at the threshold shares a bucket of the deepest level with this probability."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - p / TOKENS) ** TOKENS  # each of the tokens is sampled at 1 / (similarity * TOKENS), and shared at similarity
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _sampled(path: np.ndarray, similarity: float) -> np.ndarray:
    """Which tokens a path goes on with: each at the rate 1 / (similarity * TOKENS)."""
    return t.mix(path[:, None] + _COORDINATE) < np.uint64(int((1 << 64) / (similarity * TOKENS)))


def _first_paths(sets: DataFrame, runs: int, similarity: float) -> DataFrame:
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = t.mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        run, j = np.nonzero(_sampled(root, similarity))
        for b in batches:
            tokens = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, TOKENS)
            sid = b.column(0).to_numpy(zero_copy_only=False)
            path = t.mix(t.mix(root[run] ^ _COORDINATE[j]) + tokens[:, j].astype(np.uint64))
            yield pa.record_batch([pa.array(path.ravel().view(np.int64)), pa.array(np.repeat(sid, len(j)))], ["path", "sid"])

    return sets.select("sid", "tokens").mapInArrow(go, "path long, sid long")


def _next_paths(rows: DataFrame, similarity: float) -> DataFrame:
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tokens = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, TOKENS)
            path, sid = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), b.column(1).to_numpy(zero_copy_only=False)
            i, j = np.nonzero(_sampled(path, similarity))
            new = t.mix(t.mix(path[i] ^ _COORDINATE[j]) + tokens[i, j].astype(np.uint64))
            yield pa.record_batch([pa.array(new.view(np.int64)), pa.array(sid[i])], ["path", "sid"])

    return rows.select("path", "sid", "tokens").mapInArrow(go, "path long, sid long")


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that are sorted by their first ``keys`` columns; many groups a table."""
    held: list[pa.RecordBatch] = []

    def key(b: pa.RecordBatch, i: int) -> tuple:
        return tuple(b.column(k)[i].as_py() for k in range(keys))

    for b in batches:
        if not b.num_rows:
            continue
        if held and key(b, 0) == key(held[-1], held[-1].num_rows - 1):
            last = key(b, b.num_rows - 1)
            if last == key(b, 0):
                held.append(b)
                continue
        elif held:
            yield pa.Table.from_batches(held)
            held = []
        last, cut = key(b, b.num_rows - 1), b.num_rows - 1
        if keys == 1 and b.num_rows > 64:
            x = b.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(x, last[0]))
        else:
            while cut > 0 and key(b, cut - 1) == last:
                cut -= 1
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _linked(same: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric matrix of links."""
    out, left = [], np.ones(len(same), bool)
    for s in range(len(same)):
        if not left[s]:
            continue
        left[s] = False
        queue = [s]
        while queue:
            u = queue.pop()
            for v in np.flatnonzero(same[u] & left).tolist():
                left[v] = False
                out.append((u, v))
                queue.append(v)
    return out


def _bucket_edges(sid: np.ndarray, sketch: np.ndarray, side: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Edges that connect the bucket's candidates: each set found is compared with those not found yet."""
    left = np.arange(len(sid))
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            hit = (sketch[left] == sketch[u]).sum(1) >= need
            if hit.any():
                found = left[hit]
                out += [(int(sid[u]), int(sid[v])) for v in found]
                queue += found.tolist()
                left = left[~hit]
    return out


def _candidates(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct candidate edges (a, b) of (path, part, sid) buckets; ``part`` divides large ones."""
    need = math.ceil(CANDIDATE * TOKENS)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, 2):
            path, part, sid = (table.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in range(3))
            tokens = np.frombuffer(b"".join(table.column(3).to_pylist()), np.uint32).reshape(-1, TOKENS)
            sketch = (t.mix(tokens.astype(np.uint64)) & np.uint64(255)).astype(np.uint8) if tokens.size else np.zeros((0, TOKENS), np.uint8)
            head = np.ones(len(path), bool)
            head[1:] = (path[1:] != path[:-1]) | (part[1:] != part[:-1])
            first = np.flatnonzero(head)
            size = np.diff(np.append(first, len(path)))
            two = first[size == 2]
            good = two[(sketch[two] == sketch[two + 1]).sum(1) >= need] if len(two) else two
            a, b = [sid[good]], [sid[good + 1]]
            for f, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                if e := _bucket_edges(sid[f : f + n], sketch[f : f + n], part, need):
                    e = np.array(e, np.int64)
                    a.append(e[:, 0])
                    b.append(e[:, 1])
            a, b = np.concatenate(a), np.concatenate(b)
            pair = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1) if len(a) else np.zeros((2, 0), np.int64)
            yield pa.record_batch([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    rows = members.join(sets.select("sid", "tokens"), "sid").select("path", "part", "sid", "tokens")
    rows = rows.repartition("path", "part").sortWithinPartitions("path", "part", "sid")
    return rows.mapInArrow(go, "a long, b long").distinct()


def _buckets(sets: DataFrame, similarity: float, runs: int, depth: int, bucket: int) -> DataFrame:
    """Candidate edges of all runs, level by level; distinct in each level."""
    out = None
    paths = _first_paths(sets, runs, similarity)
    for level in range(1, depth + 1):
        several = paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        members = t.checkpoint(paths.join(several, "path"))
        small = members if level == depth else members.where(F.col("n") <= bucket)
        # beyond the last level: chunk pairs, so that no task holds more than two chunks
        m = F.ceil(F.col("n") / bucket).cast("int")
        own = F.pmod(F.xxhash64("sid", "path"), m).cast("int")
        part = F.when(F.col("n") <= bucket, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), m - 1), lambda j: F.least(own, j) * m + F.greatest(own, j)))
        found = _candidates(small.select("path", F.explode(part).alias("part"), "sid"), sets)
        out = found if out is None else out.unionByName(found)
        large = members.where(F.col("n") > bucket)
        if level == depth or large.isEmpty():
            break
        paths = _next_paths(large.join(sets.select("sid", "tokens"), "sid"), similarity)
    return out


def _verify(groups: DataFrame, docs: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """(sid, other, links, linked_docs) of candidate groups (gid, sid, n, n_texts, n_docs, doc_id, text_hash): counts, and forest edges."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in t.chunks(b.column(1)):
                x, border = shingles(data, off)
                blob = [np.sort(x[border[i] : border[i + 1]]).tobytes() for i in range(hi - lo)]
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(blob, pa.binary())], ["sid", "x"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, 3):
            gid, low, high, sid, side, texts, n_docs = (table.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in range(7))
            blobs = table.column(7).combine_chunks()
            head = np.ones(len(gid), bool)
            head[1:] = (gid[1:] != gid[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            first = np.append(np.flatnonzero(head), len(gid))
            out: list[tuple] = []
            for f, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                ids, one = np.unique(sid[f:e], return_index=True)  # a repeated row counts once
                at = f + one
                same = similar([np.frombuffer(blobs[int(i)].as_buffer(), np.uint64) for i in at], similarity)
                if low[f] != high[f]:
                    same &= side[at][:, None] != side[at][None, :]
                total, reach = same @ texts[at], same @ n_docs[at]
                out += [(int(s), None, int(a), int(b)) for s, a, b in zip(ids, total, reach, strict=True) if a]
                out += [(int(ids[u]), int(ids[v]), 0, 0) for u, v in _linked(same)]
            yield pa.record_batch([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], ["sid", "other", "links", "linked_docs"])

    # one text of each set: by its document, or of those without an id by the text's hash
    named = groups.where("doc_id is not null").select("sid", "doc_id", "text_hash").join(docs, ["doc_id", "text_hash"]).select("sid", "text")
    nameless = groups.where("doc_id is null").select("sid", "text_hash").join(docs.where("doc_id is null"), "text_hash").groupBy("sid").agg(F.first("text").alias("text"))
    x = named.unionByName(nameless).mapInArrow(sets_of, "sid long, x binary")
    # two sets at the threshold are of one band of sizes or of neighbouring ones
    groups = groups.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / -math.log(similarity) * (1 - 1e-9)).cast("int"))
    size = groups.groupBy("gid", "band").agg(F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum("n") * 8 / CHUNK_BYTES)).cast("int").alias("m"))
    above = size.select("gid", (F.col("band") - 1).alias("band"), F.col("m").alias("m_above"))
    below = size.select("gid", (F.col("band") + 1).alias("band"), F.col("m").alias("m_below"))
    rows = groups.join(size.join(above, ["gid", "band"], "left").join(below, ["gid", "band"], "left"), ["gid", "band"])
    chunk_of = lambda band, k: band.cast("long") * (1 << 31) + k.cast("long")
    own = F.pmod(F.xxhash64("sid"), F.col("m")).cast("int")
    others = lambda m, band: F.when(m.isNotNull(), F.transform(F.sequence(F.lit(0), m - 1), lambda j: chunk_of(band, j))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("own", chunk_of(F.col("band"), own))
    rows = rows.withColumn("to", F.explode(F.concat(others(F.col("m"), F.col("band")), others(F.col("m_above"), F.col("band") + 1), others(F.col("m_below"), F.col("band") - 1))))
    rows = rows.join(x, "sid").select("gid", F.least("own", "to").alias("low"), F.greatest("own", "to").alias("high"), "sid", "own", "n_texts", "n_docs", "x")
    key = ["gid", "low", "high"]
    return rows.repartition(*key).sortWithinPartitions(*key, "sid").mapInArrow(compare, "sid long, other long, links long, linked_docs long")


def similar(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Which pairs of sorted sets have at least this Jaccard similarity, exactly; a set isn't linked to itself."""
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    head = np.ones(len(flat), bool)
    head[1:] = flat[1:] != flat[:-1]
    name = np.cumsum(head) - 1
    shared = np.bincount(name)[name] > 1 if len(flat) else np.zeros(0, bool)
    _, name = np.unique(name[shared], return_inverse=True)
    owner = owner[shared]
    both = np.zeros((len(sets), len(sets)), np.float32)
    step = 4096
    for a in range(0, int(name.max()) + 1 if len(name) else 0, step):  # columns of the incidence matrix, a slice at a time
        lo, hi = np.searchsorted(name, [a, a + step])
        m = np.zeros((len(sets), step), np.float32)
        m[owner[lo:hi], name[lo:hi] - a] = 1
        both += m @ m.T
    both = np.rint(both).astype(np.int64)
    same = both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9
    np.fill_diagonal(same, False)
    return same & (both > 0)


def _classes(docs: DataFrame, similarity: float, recall: float, depth: int, bucket: int, chunk: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """The signed documents, their sets with each set's first document, the candidate groups, what verifying them found, and (sid, class) of linked sets."""
    t.tuned(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", _text_hash())
    signed = t.checkpoint(docs.select("doc_id", "text_hash", "text").mapInArrow(_signatures, "doc_id long, text_hash long, h1 long, h2 long, n long, tokens binary"))
    key = ["h1", "h2"]
    texts = signed.where("n > 0").groupBy(*key, "text_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("docs"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    sets = texts.groupBy(*key).agg(first.alias("first"), F.count("*").alias("n_texts"), F.sum("docs").alias("n_docs"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    sets = t.checkpoint(sets.select(F.xxhash64(*key).alias("sid"), *key, "first.doc_id", "first.text_hash", "n_texts", "n_docs", "n", "tokens"))
    edges = _buckets(sets, similarity, runs_for(recall, depth, similarity), depth, bucket)
    groups = components(edges).select(F.col("node").alias("sid"), F.col("component").alias("gid"))
    groups = t.checkpoint(groups.join(sets.drop("tokens", *key), "sid"))
    found = t.checkpoint(_verify(groups, docs, similarity, chunk))
    classes = components(found.where("other is not null").select(F.col("sid").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("sid"), F.col("component").alias("class"))
    return signed, sets, groups, found, classes


def _classified(docs: DataFrame, similarity: float, recall: float, depth: int, bucket: int, chunk: int) -> DataFrame:
    """doc_id and n (shingles) of each document, its class by smallest id, and its links."""
    signed, sets, groups, found, classes = _classes(docs, similarity, recall, depth, bucket, chunk)
    key = ["h1", "h2"]
    links = found.where("other is null").groupBy("sid").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    least = classes.join(groups.select("sid", "doc_id"), "sid").groupBy("class").agg(F.min("doc_id").alias("class_id"))
    known = sets.drop("tokens", "n").join(links, "sid", "left").join(classes.join(least, "class"), "sid", "left")
    known = known.select(
        *key, F.when(F.col("class").isNotNull(), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        (F.col("n_texts") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), (F.col("n_docs") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_linked_docs"),
    )
    return signed.select("doc_id", *key, "n").join(known, key, "left").drop(*key)


def _text_hash() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def jaccard_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, depth: int = DEPTH, bucket: int = BUCKET, chunk: int = CHUNK) -> DataFrame:
    """One row per document: class, links to other texts, and documents linked.

    ``class_id`` is the smallest id that links lead to; ``n_links`` counts the different texts at the
    threshold or above, ``n_linked_docs`` the other documents with them or with the same set.
    """
    out = _classified(docs, similarity, recall, depth, bucket, chunk)
    has = F.col("n") > 0
    return out.select("doc_id", F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.when(has, F.col("n_links")).otherwise(0).alias("n_links"), F.when(has, F.col("n_linked_docs")).otherwise(0).alias("n_linked_docs"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, of which one of each class stays: one row of the smallest id.

    A document without an id stays if no other of its class has one; texts without words all stay.
    """
    id_, hash_ = "__tidelog_id", "__tidelog_hash"
    named = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    some = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")
    _, sets, _, _, classes = _classes(docs.where(some), similarity, RECALL, DEPTH, BUCKET, CHUNK)
    # a set has its own first document, so neither the documents nor their links are needed again
    kept = sets.join(classes, "sid", "left").groupBy(F.coalesce("class", "sid").alias("class")).agg(first)
    kept = kept.select(F.coalesce("r.doc_id", F.lit(-(1 << 63))).alias(id_), F.col("r.text_hash").alias(hash_))
    rows = docs.where(some).withColumn(id_, named).withColumn(hash_, _text_hash()).join(kept, [id_, hash_], "left_semi")
    return rows.dropDuplicates([id_, hash_]).select(*docs.columns).unionByName(docs.where(~some))
