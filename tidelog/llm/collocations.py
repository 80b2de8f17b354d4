"""Phrase collocations by set-oriented relational mining (SETM) over whole texts.

The relation of length m holds every occurrence of a phrase of m words whose parts are frequent: (piece and
position, phrase), sorted by position, as arrays of a block of documents. A round merge-joins a block's relation
with itself at the next position, counts the groups of all blocks together, and semi-joins the relation with the
frequent groups before it is extended again. Relations are persisted in the shared folder, bucketed by block. What
crosses the network is each block's distinct groups with counts, in ranges of their ids, and one bit for each
of them back; occurrences never leave their block.

Phrases are named by 64-bit ids made of the bytes of their language and words; two phrases that are told
apart by nothing else would be counted as one (for 10^8 frequent words the odds are 1 in 3700).

Defined results: a null text is empty and gives nothing; a null language is ``und``; rows without a doc_id count
as any other; repeated rows count again; a text longer than a block is a block of its own; an empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import _text as t

#: bytes of text in a block of the relations
BLOCK_BYTES = 12 << 20
#: ranges of ids that group counts are dealt by, for each partition of the input
RANGES = 8
UNKNOWN = "und"

_SPLIT = np.zeros(256, bool)
_SPLIT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_SPLIT
_WORD[[0x20, 0x09]] = False
_A, _B = np.uint64(0x9E6C63D0876A9A35), np.uint64(0xD1B54A32D192ED03)

#: kinds of a round's rows: a block's relation, a range of its groups' counts, what frequent groups are, words by language
_RELATION, _COUNTS, _DEFINED, _TOTAL = 0, 1, 2, 3
_ROUND = "kind int, block long, bucket long, blob binary, words binary, ids binary, sizes binary, id long, n long, lead long, rest long, lang string, word string"
_FOUND = "block long, bucket long, mask binary, leads binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte plane by byte plane."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.dtype.num, len(a))]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * count, 8).tolist()
    out, at = [], 8 + 16 * count
    for num, n in zip(head[::2], head[1::2], strict=True):
        kind = next(np.dtype(d) for d in (np.uint8, np.int32, np.int64, np.uint64) if np.dtype(d).num == num)
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * kind.itemsize
    return out


def _rows(schema_names: list[str], types: list[pa.DataType], rows: list[dict]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.get(c) for r in rows], k) for c, k in zip(schema_names, types, strict=True)], schema_names)


_ROUND_NAMES = [f.split()[0] for f in _ROUND.split(", ")]
_ROUND_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_FOUND_NAMES = [f.split()[0] for f in _FOUND.split(", ")]
_FOUND_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _round_rows(rows: list[dict]) -> pa.RecordBatch:
    return _rows(_ROUND_NAMES, _ROUND_TYPES, rows)


def _grouped(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids ascending, each row's place among them, counts)."""
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    first = np.append(True, s[1:] != s[:-1]) if len(s) else np.zeros(0, bool)
    code = np.empty(len(ids), np.int32)
    code[order] = np.cumsum(first) - 1
    return s[first], code, np.diff(np.append(np.flatnonzero(first), len(s)))


def _counts(block: int, ids: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[dict]:
    """The block's groups with their counts, a row for each range of ids."""
    width = (1 << 64) // buckets + 1
    bucket = (ids // np.uint64(width)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(ids) else np.zeros(0, np.int64)
    for lo, hi in zip(cuts, np.append(cuts[1:], len(ids)), strict=True):
        yield {"kind": _COUNTS, "block": block, "bucket": int(bucket[lo]), "ids": _pack(np.diff(ids[lo:hi], prepend=np.uint64(0))), "sizes": _pack(n[lo:hi].astype(np.int64))}


def _first_relation(buckets: int, block_bytes: int):
    """Blocks of documents as relations of single words."""

    def words_of(texts: pa.Array, langs: pa.Array, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """(positions, ids, starts in the text, ends) of a run of texts; a border between pieces leaves a position out."""
        parts, base = [], 0
        seeds = {s: np.uint64(int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little")) for s in langs.unique().to_pylist()}
        seed = np.array([seeds[s] for s in langs.to_pylist()], np.uint64)
        for lo, hi, data, off in t.chunks(texts):
            data = t.LOWER[data]
            s, e, border = t.words(data, off, _WORD)
            doc = t.doc_of(border, len(s))
            ids = t.mix(t.span_hash(t.prefix_hash(data), s, e) * _A + seed[lo:hi][doc])
            cuts = np.cumsum(_SPLIT[data], dtype=np.int64)[s] if len(s) else np.zeros(0, np.int64)
            apart = np.append(True, (cuts[1:] != cuts[:-1]) | (doc[1:] != doc[:-1])) if len(s) else np.zeros(0, bool)
            at = np.arange(len(s)) + np.cumsum(apart) + start
            start = int(at[-1]) + 1 if len(s) else start
            parts.append((at.astype(np.int64), ids, s + base, e + base, lo + doc))
            base += len(data)
        join = lambda k, kind: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
        return join(0, np.int64), join(1, np.uint64), join(2, np.int64), join(3, np.int64), join(4, np.int64)

    def block_rows(texts: pa.Array, langs: pa.Array, block: int) -> Iterator[dict]:
        at, ids, start, end, doc = words_of(texts, langs, 0)
        if not len(at):
            return
        known, code, n = _grouped(ids)
        first = np.full(len(known), -1, np.int64)
        first[code[::-1]] = np.arange(len(ids) - 1, -1, -1)
        data, _ = t.buffers(texts)
        lower = t.LOWER[data]
        names = langs.to_pylist()
        spelled = b"\n".join(lower[a:b].tobytes() for a, b in zip(start[first], end[first], strict=True))
        used = sorted(set(names))
        place = {s: k for k, s in enumerate(used)}
        lang = np.array([place[s] for s in names], np.int32)[doc]
        yield {"kind": _RELATION, "block": block, "bucket": 0, "blob": _pack(np.diff(at, prepend=0).astype(np.int32), code, known, lang[first]), "words": zstandard.ZstdCompressor(level=1).compress(json.dumps(used).encode() + b"\0" + spelled)}
        yield from _counts(block, known, n, buckets)
        for k, c in enumerate(np.bincount(lang, minlength=len(used)).tolist()):
            yield {"kind": _TOTAL, "lang": used[k], "n": c}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, held, size
            if held:
                texts, langs = (pa.concat_arrays([h[k] for h in held]) for k in (0, 1))
                for r in block_rows(texts, langs, block):
                    yield _round_rows([r])
                block, held, size = block + 1, [], 0

        for b in batches:
            texts, langs = b.column(0).cast(pa.large_string()), b.column(1)
            _, off = t.buffers(texts)
            lo = 0
            while lo < len(off) - 1:
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + block_bytes - size, "right")) - 1)
                held.append((texts.slice(lo, hi - lo), langs.slice(lo, hi - lo)))
                size += int(off[hi] - off[lo])
                lo = hi
                if size >= block_bytes or hi < len(off) - 1:
                    yield from flush()
        yield from flush()

    return run


def _frequent(least: int):
    """Group counts of one range of ids after the other: for each block a bit for every frequent group, and its
    count in the one block that is to say what the group is."""

    def settle(rows: list[tuple[int, int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        parts = [(np.cumsum(_unpack(ids)[0], dtype=np.uint64), _unpack(n)[0]) for _, _, ids, n in rows]
        ids, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(ids, kind="stable")
        cut = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
        total = np.add.reduceat(n[order], cut)
        often, lead = np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        often[order] = np.repeat(total >= least, np.diff(np.append(cut, len(ids))))
        lead[order[cut]] = np.where(total >= least, total, 0)
        at = 0
        for (bucket, block, _, _), (own, _) in zip(rows, parts, strict=True):
            end = at + len(own)
            if often[at:end].any():
                yield _rows(_FOUND_NAMES, _FOUND_TYPES, [{"block": block, "bucket": bucket, "mask": np.packbits(often[at:end]).tobytes(), "leads": _pack(lead[at:end])}])
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes, bytes]] = []
        for b in batches:
            for row in zip(*[b.column(k).to_pylist() for k in range(4)], strict=True):
                if held and held[0][0] != row[0]:
                    yield from settle(held)
                    held = []
                held.append(row)
        if held:
            yield from settle(held)

    return run


def _often(known: np.ndarray, found: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of a block's groups are frequent, and the counts of those that this block is to define."""
    often, lead = np.zeros(len(known), bool), np.zeros(len(known), np.int64)
    bucket = (known // np.uint64((1 << 64) // buckets + 1)).astype(np.int64)
    for f in found:
        lo, hi = np.searchsorted(bucket, [f["bucket"], f["bucket"] + 1])
        often[lo:hi] = np.unpackbits(np.frombuffer(f["mask"], np.uint8))[: hi - lo].astype(bool)
        lead[lo:hi] = _unpack(f["leads"])[0]
    return often, lead


def _joined(at: np.ndarray, code: np.ndarray, known: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The relation merge-joined with itself at the next position: positions, codes, ids, their counts, and the ids of
    the first and of the last words of each."""
    meet = np.flatnonzero(at[1:] == at[:-1] + 1)
    a, b = code[meet], code[meet + 1]
    ids, new, n = _grouped(t.mix(known[a] * _A + t.mix(known[b] * _B + np.uint64(length))))
    one = np.zeros(len(ids), np.int64)
    one[new] = np.arange(len(meet))
    return at[meet], new, ids, n, known[a[one]], known[b[one]]


def _kept(at: np.ndarray, code: np.ndarray, known: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The relation semi-joined with the frequent groups."""
    keep = often[code]
    return at[keep], (np.cumsum(often) - 1).astype(np.int32)[code[keep]], known[often]


def _extended(length: int, buckets: int, last: bool):
    """Each block's relation of this length, semi-joined with the frequent groups, and the counts of the next length.

    What a block keeps is the semi-joined relation of one word less (of single words: all); joining it again gives
    the same groups in the same order as when they were counted.
    """

    def extend(block: int, blob: bytes, words: bytes | None, found: list[dict]) -> Iterator[dict | pa.RecordBatch]:
        step, code, known, *lang = _unpack(blob)
        at = np.cumsum(step, dtype=np.int64)
        if length > 1:
            at, code, known, _, lead_id, rest_id = _joined(at, code, known, length - 1)
        often, lead = _often(known, found, buckets)
        said = np.flatnonzero(lead)
        if len(said):
            if length == 1:
                langs, _, spelled = zstandard.ZstdDecompressor().decompress(words).partition(b"\0")
                langs, spelled = json.loads(langs), spelled.split(b"\n")
                columns = {"lang": [langs[k] for k in lang[0][said].tolist()], "word": [spelled[k].decode() for k in said.tolist()]}
            else:
                columns = {"lead": lead_id.view(np.int64)[said], "rest": rest_id.view(np.int64)[said]}
            columns |= {"kind": np.full(len(said), _DEFINED, np.int32), "id": known.view(np.int64)[said], "n": lead[said]}
            yield pa.record_batch([pa.array(columns[c], k) if c in columns else pa.nulls(len(said), k) for c, k in zip(_ROUND_NAMES, _ROUND_TYPES, strict=True)], _ROUND_NAMES)
        at, code, known = _kept(at, code, known, often)
        if last or len(at) < 2:
            return
        _, _, ids, n, _, _ = _joined(at, code, known, length)
        if len(ids):
            yield _round_rows([{"kind": _RELATION, "block": block, "blob": _pack(np.diff(at, prepend=0).astype(np.int32), code, known)}])
            for r in _counts(block, ids, n, buckets):
                yield _round_rows([r])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                yield from extend(*(b.column(c)[k].as_py() for c in range(4)))

    return run


def frequent_phrases(docs: DataFrame, longest: int, least: int, folder: str, block_bytes: int = BLOCK_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """([words (id, n, lang, word), then for each longer length (id, n, lead, rest)], words by language (lang, n)).

    ``lead`` and ``rest`` are the ids of a phrase's first and last m - 1 words.
    """
    spark = t.tuned(docs.sparkSession)
    texts = docs.select(F.col("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    buckets, found = max(2, RANGES * texts.rdd.getNumPartitions()), []
    name = f"relation_{uuid.uuid4().hex}"

    def persist(rows: DataFrame, m: int) -> None:
        # bucketed by block, so that a block's bits come to its relation and the relation stays where it is
        rows.write.option("compression", "none").option("path", f"{folder}/{m}").bucketBy(buckets, "block").sortBy("block").saveAsTable(f"{name}_{m}")

    persist(texts.mapInArrow(_first_relation(buckets, block_bytes), _ROUND), 0)
    for m in range(1, longest + 1):
        rows = spark.table(f"{name}_{m - 1}")
        counts = rows.where(F.col("kind") == _COUNTS).select("bucket", "block", "ids", "sizes")
        settled = counts.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(_frequent(least), _FOUND)
        bits = settled.groupBy("block").agg(F.collect_list(F.struct("bucket", "mask", "leads")).alias("found"))  # a row a range at most
        meet = rows.where(F.col("kind") == _RELATION).select("block", "blob", "words").join(bits, "block")
        persist(meet.mapInArrow(_extended(m, buckets, m == longest), _ROUND), m)
        said = spark.read.schema(_ROUND).parquet(f"{folder}/{m}").where(F.col("kind") == _DEFINED)
        found.append(said.select("id", "n", *(("lang", "word") if m == 1 else ("lead", "rest"))))
    for m in range(longest + 1):
        spark.sql(f"DROP TABLE {name}_{m}")  # its files stay
    total = spark.read.schema(_ROUND).parquet(f"{folder}/0").where(F.col("kind") == _TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    return found, total


def candidates(found: list[DataFrame], folder: str) -> list[DataFrame]:
    """For each length from 2 the phrases with their parts' counts: lang, phrase, last (its last word), a, heads and
    tails (counts of its first and last 1 to m - 1 words). Each is written once, since the next two uses read it."""
    one = found[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("n").alias("a"), F.array().cast("array<bigint>").alias("heads"), F.array().cast("array<bigint>").alias("tails"))
    out, below = [], one
    for rows in found[1:]:
        left = below.select(F.col("id").alias("lead"), "lang", F.col("phrase").alias("_phrase"), F.concat("heads", F.array("a")).alias("heads"))
        right = below.select(F.col("id").alias("rest"), "last", F.concat("tails", F.array("a")).alias("tails"))
        below = rows.join(left, "lead").join(right, "rest").select("id", "lead", "rest", "lang", F.concat_ws(" ", "_phrase", "last").alias("phrase"), "last", F.col("n").alias("a"), "heads", "tails")
        below.write.parquet(f"{folder}/phrases-{len(out)}")
        below = below.sparkSession.read.parquet(f"{folder}/phrases-{len(out)}")
        out.append(below)
    return out


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, covered: tuple[int, int] = (80, 100), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's best phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its worst cut in two parts, floor(2000000 a / (l + r)). Phrases that a longer
    candidate holds in at least ``covered`` of their occurrences are left out. It is enough to look at candidates
    that are one word longer: whatever a longer one covers, those in between do too.
    """
    folder = f"{t.checkpoint_folder(docs.sparkSession)}/collocations-{uuid.uuid4().hex}"
    found, total = frequent_phrases(docs, longest, least, folder, block_bytes)
    levels = candidates(found, folder)
    parts = []
    exact = lambda c: c.cast("decimal(19,0)")
    for k, rows in enumerate(levels):
        m = k + 2
        cuts = []
        for first in range(1, m):
            l, r = F.get("heads", F.lit(first - 1)), F.get("tails", F.lit(m - first - 1))
            score = F.expr(f"cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(get(heads, {first - 1}) as decimal(19,0)) + cast(get(tails, {m - first - 1}) as decimal(19,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(first).alias("k"), l.alias("l"), r.alias("r")))
        cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        if k + 1 < len(levels):
            longer = levels[k + 1].select(F.explode(F.array_distinct(F.array("lead", "rest"))).alias("id"), F.col("a").alias("_a")).groupBy("id").agg(F.max("_a").alias("_longer"))
            rows = rows.join(longer, "id", "left").where(F.col("_longer").isNull() | (F.lit(covered[1]) * exact(F.col("_longer")) < F.lit(covered[0]) * exact(F.col("a"))))
        parts.append(rows.select("lang", "phrase", "a", cut.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each share first, so that no task orders a whole language
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(1 << 8))).orderBy(*order)
    rows = rows.withColumn("_own", F.row_number().over(share)).where(F.col("_own") <= top).drop("_own")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
