"""The trie of conversations' shared beginnings, with counts of every node.

Conversations are sorted by their turns' ids and dealt out in ranges. A task takes a run of them as a padded
matrix of turn ids, sorts it by columns, marks where nodes start by OR-accumulating the columns' changes, and adds up
every depth with ``reduceat``, the deepest first. Nodes that touch an end of the run may go on in the next
one: the run's first and last conversation are passed on with their nodes' partial sums, and are themselves rows of
the next round, until one run holds all that is left. A hot beginning thus costs two rows a run.

Long conversations are cut in segments of turns, each a trie below the node where it begins; the deepest are
built first, and each hands its sums to that node. So a matrix has a bounded width, and no task holds a
conversation. What one task has to read alone are the ids behind one ``ends_sha256``: a digest has no parts.

Defined results: rows without conv_id take no part; null roles and texts are empty; turns that tie are ordered by
role and text, null turns come first; repeated rows are turns of their own; conv_id % 20 has the sign of conv_id;
turns are told apart by the MD5 of role and text; an empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import _text as t

#: turns in a segment
SEGMENT = 256
#: cells of a run's matrix
CELLS = 1 << 19
#: rows that are left for the last round, at most
CLOSE_ROWS = 2048

_NONE = np.iinfo(np.int64).max
_ID = 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE, _PATH, _PIECE, _ROOT = 0, 1, 2, 3

_TURNS = "part int, conv_id long, own long, id string, words int, first long, last long, n_last long, n long"
_OUT = "kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, root binary, ids binary, words array<int>, stats binary, piece string"
_NAMES = [f.split()[0] for f in _OUT.split(", ")]
_TYPES = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.string()]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns with their number within the partition's part of their conversation; at the end a row about the partition."""
    part, last, n_last, first, n = TaskContext.get().partitionId(), None, 0, None, 0
    names = [f.split()[0] for f in _TURNS.split(", ")]
    for b in batches:
        if not len(b):
            continue
        conv = np.asarray(b.column(0))
        cut = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        own = np.arange(len(conv)) - np.repeat(cut, np.diff(np.append(cut, len(conv))))
        if last is not None and conv[0] == last:
            own[: cut[1] if len(cut) > 1 else len(conv)] += n_last
        first = int(conv[0]) if first is None else first
        last, n_last, n = int(conv[-1]), int(own[-1]) + 1, n + len(conv)
        data, off = t.buffers(b.column(2))
        start, _, border = t.words(data, off)
        words = np.diff(border).astype(np.int32)
        roles = b.column(1).to_pylist()
        ids = []
        for k, role in enumerate(roles):
            r = role.encode()
            ids.append(hashlib.md5(b"%d:" % len(r) + r + data[off[k] : off[k + 1]].tobytes()).hexdigest())
        none = pa.nulls(len(conv), pa.int64())
        yield pa.record_batch([pa.array(np.full(len(conv), part, np.int32)), b.column(0), pa.array(own.astype(np.int64)), pa.array(ids, pa.string()), pa.array(words), none, none, none, none], names)
    if n:
        yield pa.record_batch([pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), *[pa.array([v], pa.int64()) for v in (first, last, n_last, n)]], names)


def ranked_turns(conversations: DataFrame, folder: str) -> DataFrame:
    """(conv_id, rank from 0, id, words) of every turn. A conversation may lie in several partitions."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text")).where(F.col("conv_id").isNotNull())
    ordered = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", "role", "text")
    ordered.mapInArrow(_turns, _TURNS).write.parquet(f"{folder}/turns")
    turns = conversations.sparkSession.read.schema(_TURNS).parquet(f"{folder}/turns")
    ends = sorted(turns.where(F.col("conv_id").isNull()).select("part", "first", "last", "n_last", "n").collect())  # a row a partition
    before, carried = [], (None, 0)
    for r in ends:
        goes_on = carried[1] if r["first"] == carried[0] else 0
        if goes_on:
            before.append((r["part"], r["first"], goes_on))
        carried = r["last"], r["n_last"] + (goes_on if r["first"] == r["last"] else 0)
    turns = turns.where(F.col("conv_id").isNotNull()).select("part", "conv_id", "own", "id", "words")
    rank = F.col("own")
    if before:
        turns = turns.join(F.broadcast(turns.sparkSession.createDataFrame(before, "part int, conv_id long, before long")), ["part", "conv_id"], "left")
        rank = rank + F.coalesce("before", F.lit(0))
    return turns.select("conv_id", rank.alias("rank"), "id", "words")


def rebuilt_turns(turns: DataFrame, kept: Column, family: int) -> DataFrame:
    """(conv_id, rank, id, words) after a conversation's first ``kept`` (three at most) turns gave way to those of the first
    one of its family; a conversation without turns has one row of nulls."""
    base = F.col("conv_id") - F.col("conv_id") % family
    turn = F.struct("rank", "id", "words")
    heads = turns.where((F.col("rank") < 3) & (F.col("conv_id") % family == 0)).groupBy(F.col("conv_id").alias("_base")).agg(F.array_sort(F.collect_list(turn)).alias("_head"))
    rows = turns.withColumn("_base", base).withColumn("_kept", kept.cast("int")).join(heads, "_base", "left")
    lead = F.coalesce(F.slice("_head", F.lit(1), F.col("_kept")), F.array().cast("array<struct<rank:bigint,id:string,words:int>>"))
    rows = rows.withColumn("_lead", lead)
    own = rows.where(F.col("rank") >= F.col("_kept")).select("conv_id", (F.col("rank") - F.col("_kept") + F.size("_lead")).alias("rank"), "id", "words")
    led = rows.where("rank = 0").select("conv_id", F.explode_outer("_lead").alias("e")).select("conv_id", "e.rank", "e.id", "e.words")
    return own.unionByName(led)


def segments(turns: DataFrame, length: int) -> DataFrame:
    """(conv_id, seg, ids, words): up to ``length`` turns in a row."""
    turn = F.when(F.col("rank").isNotNull(), F.struct("rank", "id", "words"))
    rows = turns.groupBy("conv_id", F.floor(F.coalesce("rank", F.lit(0)) / length).cast("long").alias("seg")).agg(F.array_sort(F.collect_list(turn)).alias("e"))
    return rows.select("conv_id", "seg", F.unhex(F.array_join(F.transform("e", lambda x: x["id"]), "")).alias("ids"), F.transform("e", lambda x: x["words"]).alias("words"))


class _Run:
    """A run of sorted rows as padded matrices; ``depth`` d is column d, and column 0 the root."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        n = np.array([len(r["ids"]) // _ID for r in rows], np.int64)
        width = int(n.max()) + 1
        raw = np.frombuffer(b"".join(r["ids"] for r in rows), f"V{_ID}")
        _, code = np.unique(raw, return_inverse=True) if len(raw) else (raw, np.zeros(0, np.int64))
        roots = {v: k for k, v in enumerate(sorted({r["root"] for r in rows}))}
        matrix = np.full((len(rows), width), -1, np.int32)
        row = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(raw)) - np.repeat(np.cumsum(n) - n, n) + 1
        matrix[row, at] = code
        matrix[:, 0] = [roots[r["root"]] for r in rows]
        conv = np.array([r["conv_id"] for r in rows], np.int64)
        order = np.lexsort((conv, *(matrix[:, d] for d in reversed(range(width)))))
        words = np.zeros((len(rows), width), np.int64)
        words[row, at] = [w for r in rows for w in r["words"]]
        self.rows = [rows[k] for k in order.tolist()]
        self.n, self.conv, self.matrix, self.words = n[order], conv[order], matrix[order], words[order]
        change = np.ones(self.matrix.shape, bool)
        change[1:] = self.matrix[1:] != self.matrix[:-1]
        self.start = np.logical_or.accumulate(change, axis=1)
        self.live = self.matrix >= 0
        self.ends = np.array([bool(r["ends"]) for r in self.rows])
        # convs, smallest conv, children, leaves below, tokens saved below
        self.stats = np.zeros((5, *self.matrix.shape), np.int64)
        self.stats[0] = self.live
        self.stats[1] = np.where(self.live, self.conv[:, None], _NONE)
        for k, r in enumerate(self.rows):
            if r["stats"] is not None:
                own = np.frombuffer(r["stats"], np.int64).reshape(5, -1)
                self.stats[:, k] = np.array([0, _NONE, 0, 0, 0])[:, None]
                self.stats[:, k, : own.shape[1]] = own
            elif r["n_children"] is not None:
                self.stats[2:, k, self.n[k]] = r["n_children"], r["n_leaves"], r["saved_tokens"]

    def key(self, row: int, depth: int) -> bytes:
        """The name of the row's node at a depth."""
        r = self.rows[row]
        return hashlib.md5(r["root"] + r["ids"][: depth * _ID]).digest() if depth else r["root"]


def _summed(run: _Run, level: int, length: int, first: bool, closed: bool, named: bool) -> Iterator[dict]:
    """The nodes of a run, and what its open ends pass on."""
    rows, width = run.matrix.shape
    kids_in, leaves_in, saved_in = np.zeros((3, rows), np.int64)
    partial = [np.zeros((5, width), np.int64) for _ in range(2)]
    for p in partial:
        p[1] = _NONE
    waiting: list[tuple[int, dict]] = []
    for d in reversed(range(width)):
        s = np.flatnonzero(run.start[:, d])
        end = np.append(s[1:], rows)
        live = run.live[s, d]
        x = [f.reduceat(run.stats[k][:, d] + extra, s) for k, (f, extra) in enumerate([(np.add, 0), (np.minimum, 0), (np.add, kids_in), (np.add, leaves_in), (np.add, saved_in)])]
        open_ = np.zeros(len(s), bool)
        if not closed:
            open_[0], open_[-1] = live[0], live[-1] if len(s) > 1 else live[0]
            for side, k in ((0, 0), (1, len(s) - 1)):
                if live[k] and (side == 0 or k):
                    partial[side][:, d] = [v[k] for v in x]
        whole = live & ~open_
        kids_in, leaves_in, saved_in = np.zeros((3, rows), np.int64)
        at = np.flatnonzero(whole)
        leaves = np.where(x[2] == 0, 1, x[3])
        saved = x[4] + np.maximum(x[0] - 1, 0) * run.words[s, d]
        kids_in[s[at]], leaves_in[s[at]], saved_in[s[at]] = 1, leaves[at], saved[at]
        # the nodes below know their parents now
        for row, node in waiting:
            k = int(np.searchsorted(s, row, "right")) - 1
            if open_[k] or level and d == 0:
                yield node | {"parent_key": run.key(row, d)}
            else:
                yield node | {"parent_conv_id": int(x[1][k])}
        waiting = []
        if first and not closed:
            for k in {0, len(s) - 1}:
                own = np.arange(s[k], end[k])
                own = own[(run.n[own] == d) & run.ends[own]]
                if open_[k] and len(own):
                    yield {"kind": _PIECE, "key": run.key(int(s[k]), d), "conv_id": int(run.conv[own[0]]), "piece": ",".join(map(str, run.conv[own].tolist()))}
        stop = np.add.reduceat((run.n == d) & run.ends, s) if first else None
        for k in at.tolist():
            row = int(s[k])
            if level and d == 0:
                yield {"kind": _ROOT, "conv_id": int(x[1][k]), "n_children": int(x[2][k]), "n_leaves": int(x[3][k]), "saved_tokens": int(x[4][k])}
                continue
            node = {"kind": _NODE, "conv_id": int(x[1][k]), "depth": level * length + d, "n_convs": int(x[0][k]), "n_children": int(x[2][k]), "n_leaves": int(leaves[k]), "saved_tokens": int(saved[k])}
            if first:
                own = run.conv[row : end[k]][(run.n[row : end[k]] == d) & run.ends[row : end[k]]] if stop[k] else []
                node["ends_sha256"] = hashlib.sha256(",".join(map(str, own.tolist())).encode()).hexdigest() if len(own) else _EMPTY
            if not first or named and d == length:
                node["key"] = run.key(row, d)
            if d:
                waiting.append((row, node))
            else:
                yield node
    if not closed:
        for side, row in ((0, 0), (1, rows - 1)):
            own = partial[side][:, : run.n[row] + 1]
            if side == 0 or own[0].any():
                r = run.rows[row]
                yield {"kind": _PATH, "root": r["root"], "ids": r["ids"], "words": r["words"], "conv_id": int(run.conv[row]), "stats": own.tobytes()}


def _tries(level: int, length: int, cells: int, first: bool, closed: bool, named: bool):
    """Runs of a sorted partition, one after the other."""

    def emitted(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        for r in _summed(_Run(rows), level, length, first, closed, named):
            found.append(r)
            if len(found) >= 4096:
                yield _batch(found)
                found = []
        if found:
            yield _batch(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        width = 1
        for b in batches:
            for r in b.to_pylist():
                wide = max(width, len(r["ids"]) // _ID + 1)
                if held and not closed and wide * (len(held) + 1) > cells:
                    yield from emitted(held)
                    held, wide = [], len(r["ids"]) // _ID + 1
                held.append(r)
                width = wide
        if held:
            yield from emitted(held)

    return run


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.get(c) for r in rows], k) for c, k in zip(_NAMES, _TYPES, strict=True)], _NAMES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of all pieces of each key, which come in order."""
    key, digest, out = None, None, []
    for b in batches:
        for k, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if k != key:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if digest is not None:
        out.append((key, digest.hexdigest()))
    yield pa.record_batch([pa.array([k for k, _ in out], pa.binary()), pa.array([v for _, v in out], pa.string())], ["key", "ends"])


_IN = ["root", "ids", "words", "conv_id", "ends", "n_children", "n_leaves", "saved_tokens", "stats"]


def trie(turns: DataFrame, folder: str, length: int = SEGMENT, cells: int = CELLS) -> DataFrame:
    """The nodes of the trie of (conv_id, rank, id, words); see ``conversation_trie``."""
    spark = turns.sparkSession
    segments(turns, length).write.parquet(f"{folder}/segments")
    parts = spark.read.parquet(f"{folder}/segments")
    deepest = parts.agg(F.max("seg")).first()[0]
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    if deepest is None:
        return spark.createDataFrame([], schema)
    # the node below which each segment lies
    levels = [parts.where("seg = 0").withColumn("root", F.lit(b"").cast("binary"))]
    for k in range(1, deepest + 1):
        above = levels[-1].select("conv_id", F.unhex(F.md5(F.concat("root", "ids"))).alias("root"))
        parts.where(F.col("seg") == k).join(above, "conv_id").write.parquet(f"{folder}/level-{k}")
        levels.append(spark.read.parquet(f"{folder}/level-{k}"))
    outs, below = [], None
    none = F.lit(None).cast("long")
    for k in reversed(range(deepest + 1)):
        rows = levels[k]
        if below is None:
            rows = rows.select("*", F.lit(True).alias("ends"), none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens"))
        else:
            longer = parts.where(F.col("seg") == k + 1).select("conv_id", F.lit(False).alias("_ends"))
            rows = rows.join(longer, "conv_id", "left").join(below.select("conv_id", "n_children", "n_leaves", "saved_tokens"), "conv_id", "left").withColumn("ends", F.coalesce("_ends", F.lit(True)))
        rows, left, number = rows.withColumn("stats", F.lit(None).cast("binary")), None, 0
        while True:
            closed = number > 0 and left <= CLOSE_ROWS
            ordered = (rows.repartition(1) if closed else rows.repartitionByRange("root", "ids", "conv_id")).sortWithinPartitions("root", "ids", "conv_id").select(*_IN)
            path = f"{folder}/{k}-{number}"
            ordered.mapInArrow(_tries(k, length, cells, number == 0, closed, k < deepest), _OUT).write.parquet(path)
            out = spark.read.schema(_OUT).parquet(path)
            outs.append((number == 0, out))
            if closed:
                break
            rows = out.where(F.col("kind") == _PATH).select("root", "ids", "words", "conv_id", F.lit(False).alias("ends"), none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens"), "stats")
            left, number = rows.count(), number + 1
        below = None
        for _, out in outs[-(number + 1) :]:
            found = out.where(F.col("kind") == _ROOT)
            below = found if below is None else below.unionByName(found)
    columns = [f.split()[0] for f in schema.split(", ")]
    union = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(union(dfs[1:]))
    pieces = union([o.where(F.col("kind") == _PIECE).select("key", "piece", "conv_id") for is_first, o in outs if is_first])
    digests = pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "piece").mapInArrow(_digests, "key binary, ends string")
    nodes = [o.where(F.col("kind") == _NODE).select("key", "parent_key", *columns) for is_first, o in outs if is_first]
    late = union([o.where(F.col("kind") == _NODE).select("key", "parent_key", *columns) for is_first, o in outs if not is_first])
    late = late.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(_EMPTY))).drop("ends")
    nodes = union([*nodes, late.select("key", "parent_key", *columns)])
    known = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    given = nodes.where("parent_key is null").select(*columns)
    asked = nodes.where("parent_key is not null").join(known, "parent_key").withColumn("parent_conv_id", F.col("_parent")).select(*columns)
    return given.unionByName(asked)


def conversation_trie(conversations: DataFrame, family: int = 20, length: int = SEGMENT, cells: int = CELLS) -> DataFrame:
    """The prefix trie of the rebuilt conversations, a row a node.

    A conversation c takes its first crc32(c) % 4 turns from conversation c - c % ``family``. Columns: conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = t.tuned(conversations.sparkSession)
    folder = f"{t.checkpoint_folder(spark)}/trie-{uuid.uuid4().hex}"
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return trie(rebuilt_turns(ranked_turns(conversations, folder), kept, family), folder, length, cells)
