"""Nearest neighbours by a forest of hash prefixes.

Each tree names a vector by a string of 64 signs of random projections and keeps the strings sorted, dealt out
in runs of neighbouring strings. A query descends in every tree to the strings with the longest prefix of its own and
ascends in all trees at once, one sign at a time, until they hold ``budget`` candidates together (one found in
several trees counts in each). All rows below the prefixes where it stops are scored with the given vectors.

How many rows share a prefix is known for the first 14 signs from exact counts of all rows (a table of one size
for any input). If even 14 signs leave over ``budget`` candidates, each tree goes down on its own, to the longest
prefix that holds its share. Inner products become angles by one more coordinate, which brings all rows to the
longest one's length. Copies of one vector are one entry with its 21 smallest ids, which is all that a query can
return of them, so hot vectors cost one row a tree.

The projections are drawn from a fixed seed and fitted to nothing. While a table holds no more than
budget / trees rows, the ascent ends at the root and the search is exhaustive.

Defined results: rows without id, without vector, or whose vector is zero or has null or non-finite components take
no part; shorter vectors are filled up with zeros; repeated rows count once; rows that share an id are never
each other's neighbours; sums that overflow to no number rank last, as minus infinity; fewer rows than asked for
are all returned; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import _text as t

TREES = 24
BUDGET = 32_768
#: rows that one sorted run holds, about
RUN_ROWS = 32_768
#: leading signs whose counts are known everywhere
CELL_BITS = 14
BITS = 64
#: rows that are searched for copies together
COPY_ROWS = 65_536
SEED = 20_240_611

_GROUPS = "key binary, vector binary, ids array<bigint>, asks boolean"
_ROUTED = "tree int, run int, part int, kind int, key binary, hash long, vector binary, ids array<bigint>, depth int, share long"
_FOUND = "key binary, vec_id long, score double"


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Lists as rows of doubles, filled up with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = np.asarray(col.value_lengths().fill_null(0), np.int64)
    out = np.zeros((len(n), dim))
    flat = np.asarray(col.flatten(), np.float64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1, initial=0.0)
    return most * np.sqrt(((x / np.where(most > 0, most, 1)[:, None]) ** 2).sum(axis=1))


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, the longest vector's components and length, and whether single precision holds all, batch by batch."""
    for b in batches:
        n = np.asarray(b.column(0).value_lengths(), np.int64)
        if len(n):
            x = _matrix(b.column(0), int(n.max()))
            with np.errstate(over="ignore"):
                yield pa.record_batch([pa.array([len(n)], pa.int64()), pa.array([int(n.max())], pa.int32()), pa.array([float(np.minimum(_norms(x), np.finfo(float).max).max())]), pa.array([bool((x.astype(np.float32) == x).all())])], ["n", "dim", "norm", "single"])


def _keys(x: np.ndarray) -> list[bytes]:
    return [hashlib.md5(r.tobytes()).digest() for r in x]


def _copies(dim: int, kind: str, ids_kept: int):
    """Vectors with their smallest ids, for every run of rows."""

    def one(vectors: list[pa.Array], ids: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
        x = np.concatenate([_matrix(v, dim) for v in vectors]).astype(kind)
        rows = np.ascontiguousarray(x).view(f"V{x.itemsize * dim}").ravel() if dim else np.zeros(len(x), "V1")
        _, first, place = np.unique(rows, return_index=True, return_inverse=True)
        order = np.lexsort((ids, place))
        same = np.append(False, (place[order][1:] == place[order][:-1]) & (ids[order][1:] == ids[order][:-1]))
        order = order[~same]
        start = np.searchsorted(place[order], np.arange(len(first) + 1))
        own = [ids[order[a : min(b, a + ids_kept)]].tolist() for a, b in zip(start[:-1], start[1:], strict=True)]
        asked = np.zeros(len(first), bool)
        asked[place[asks]] = True
        x = x[first]
        return pa.record_batch([pa.array(_keys(x), pa.binary()), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(own, pa.list_(pa.int64())), pa.array(asked)], ["key", "vector", "ids", "asks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(len(h) for h in held) >= COPY_ROWS:
                yield one([h.column(1) for h in held], *(np.concatenate([np.asarray(h.column(k)) for h in held]) for k in (0, 2)))
                held = []
        if sum(len(h) for h in held):
            yield one([h.column(1) for h in held], *(np.concatenate([np.asarray(h.column(k)) for h in held]) for k in (0, 2)))

    return run


def _asking(dim: int, kind: str):
    """(key, query_id) of the rows that ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield pa.record_batch([pa.array(_keys(_matrix(b.column(1), dim).astype(kind)), pa.binary()), b.column(0)], ["key", "query_id"])

    return run


class _Hash:
    """The trees' strings of rows and of queries."""

    def __init__(self, dim: int, norm: float, trees: int):
        self.dim, self.norm, self.trees = dim, norm, trees

    def _strings(self, z: np.ndarray) -> np.ndarray:
        planes = np.random.default_rng(SEED).standard_normal((self.dim + 1, self.trees * BITS)).astype(np.float32)
        signs = np.packbits(z.astype(np.float32) @ planes > 0, axis=1)
        return np.ascontiguousarray(signs).view(">u8").astype(np.uint64)

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        return self._strings(np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(axis=1)))]))

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        own = _norms(x)
        return self._strings(np.column_stack([x / np.where(own > 0, own, 1)[:, None], np.zeros(len(x))]))


def _vectors(col: pa.Array, dim: int, kind: str) -> np.ndarray:
    data, _ = t.buffers(col)
    return np.frombuffer(data.tobytes(), kind).reshape(len(col), dim).astype(np.float64)


def _cells(strings: np.ndarray) -> np.ndarray:
    return (strings >> np.uint64(BITS - CELL_BITS)).astype(np.int64)


def _histogram(hashed: _Hash, kind: str):
    """How many rows each tree has in each cell of leading signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((hashed.trees, 1 << CELL_BITS), np.int64)
        for b in batches:
            if len(b):
                c = _cells(hashed.of_rows(_vectors(b.column(0), hashed.dim, kind)))
                for k in range(hashed.trees):
                    total[k] += np.bincount(c[:, k], minlength=1 << CELL_BITS)
        yield pa.record_batch([pa.array(range(hashed.trees), pa.int32()), pa.array([v.tobytes() for v in total], pa.binary())], ["slice", "blob"])

    return run


class _Layout:
    """Where the trees' runs lie, from the rows of every cell."""

    def __init__(self, counts: np.ndarray):
        self.below = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
        self.run = self.below[:, :-1] // RUN_ROWS
        # a run grows by its last cell at most; larger ones, of crowded cells, are dealt out in parts
        self.parts = []
        for k in range(len(counts)):
            rows = np.bincount(self.run[k], weights=counts[k])
            self.parts.append(np.maximum(1, np.ceil(rows / (2 * RUN_ROWS))).astype(np.int64))

    def depth(self, cells: np.ndarray, budget: int) -> np.ndarray:
        """The most leading signs at which all trees together still hold the budget; none if they never do."""
        out = np.zeros(len(cells), np.int64)
        tree = np.arange(cells.shape[1])
        for x in range(1, CELL_BITS + 1):
            width = 1 << (CELL_BITS - x)
            lo = cells // width * width
            held = (self.below[tree, lo + width] - self.below[tree, lo]).sum(axis=1)
            out[held >= budget] = x
        return out


def _routed(hashed: _Hash, kind: str, layout, budget: int):
    """Rows to their run of every tree, queries to the runs that their prefixes reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lay = layout.value
        for b in batches:
            if not len(b):
                continue
            key, vector, ids = b.column(0), b.column(1), b.column(2)
            x = _vectors(vector, hashed.dim, kind)
            strings = hashed.of_rows(x)
            cells = _cells(strings)
            salt = np.array([int.from_bytes(v[:4], "little") for v in key.to_pylist()], np.int64)
            n = len(b)
            for k in range(hashed.trees):
                place = lay.run[k][cells[:, k]]
                rest = pa.nulls(n, pa.int32())
                yield pa.record_batch([pa.array(np.full(n, k, np.int32)), pa.array(place.astype(np.int32)), pa.array((salt % lay.parts[k][place]).astype(np.int32)), pa.array(np.zeros(n, np.int32)), key, pa.array(strings[:, k].view(np.int64)), vector, ids, rest, pa.nulls(n, pa.int64())], names)
            ask = np.flatnonzero(np.asarray(b.column(3)))
            if not len(ask):
                continue
            strings = hashed.of_queries(x[ask])
            cells = _cells(strings)
            depth = lay.depth(cells, budget)
            for k in range(hashed.trees):
                # at the root every tree holds the same rows
                use = np.flatnonzero(depth > 0) if k else np.arange(len(ask))
                width = 1 << (CELL_BITS - depth[use])
                lo = cells[use, k] // width * width
                first, last = lay.run[k][lo], lay.run[k][lo + width - 1]
                for q, d, s, a, z in zip(ask[use].tolist(), depth[use].tolist(), strings[use, k].view(np.int64).tolist(), first.tolist(), last.tolist(), strict=True):
                    at = [(r, p) for r in range(a, z + 1) if r < len(lay.parts[k]) for p in range(int(lay.parts[k][r]))]
                    m = len(at)
                    share = [max(1, budget // hashed.trees // int(lay.parts[k][r])) for r, _ in at]
                    yield pa.record_batch([pa.array([k] * m, pa.int32()), pa.array([r for r, _ in at], pa.int32()), pa.array([p for _, p in at], pa.int32()), pa.array([1] * m, pa.int32()), pa.array([key[q].as_py()] * m, pa.binary()), pa.array([s] * m, pa.int64()), pa.array([vector[q].as_py()] * m, pa.binary()), pa.nulls(m, pa.list_(pa.int64())), pa.array([d] * m, pa.int32()), pa.array(share, pa.int64())], names)

    names = [f.split()[0] for f in _ROUTED.split(", ")]
    return run


def _bounds(strings: np.ndarray, asked: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of the sorted strings that share so many leading signs with each asked one."""
    free = (BITS - depth).astype(np.uint64)
    mask = np.where(depth == 0, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(free, np.uint64(63))) - np.uint64(1))
    return np.searchsorted(strings, asked & ~mask), np.searchsorted(strings, asked | mask, "right")


def _searched(dim: int, kind: str, k: int):
    """Each run's sorted array, and what the queries that reach it find below their prefixes."""

    def search(strings: np.ndarray, x: np.ndarray, ids: list[list[int]], q: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked, y = np.asarray(q.column(5)).view(np.uint64), _vectors(q.column(6), dim, kind)
        depth, share = np.asarray(q.column(8)).astype(np.int64), np.asarray(q.column(9))
        # beyond the counted signs each tree goes on to the longest prefix that holds its share
        deep = depth == CELL_BITS
        for d in range(CELL_BITS + 1, BITS + 1):
            if not deep.any():
                break
            lo, hi = _bounds(strings, asked, np.full(len(asked), d))
            deep &= hi - lo >= share
            depth[deep] = d
        lo, hi = _bounds(strings, asked, depth)
        keys, out, found, scores = q.column(4).to_pylist(), [], [], []
        first = np.array([i[0] for i in ids], np.int64)
        groups: dict[tuple[int, int], list[int]] = {}
        for i, span in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
            groups.setdefault(span, []).append(i)
        for (a, b), own in groups.items():
            if a == b:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                near = x[a:b] @ y[own].T
            for j, i in enumerate(own):
                s = near[:, j]
                with np.errstate(over="ignore", invalid="ignore"):
                    slack = 1e-13 * dim * float(np.abs(y[i]).max() * np.abs(x[a:b]).max() * dim)
                    low = np.partition(s, b - a - k)[b - a - k] - slack if b - a > k else -np.inf
                    at = np.flatnonzero(~(s < low)) + a
                    # exactly: products added in the components' order
                    exact = np.add.accumulate(x[at] * y[i], axis=1)[:, -1]
                exact = np.where(np.isnan(exact), -np.inf, exact)
                best = np.lexsort((first[at], -exact))[:k]
                left = k
                for s1, row in sorted(((-e, ids[r]) for e, r in zip(exact[best].tolist(), at[best].tolist(), strict=True)), key=lambda r: (r[0], r[1][0])):
                    out += [keys[i]] * len(row)
                    found += row
                    scores += [-s1] * len(row)
                    left -= len(row)
        if out:
            yield pa.record_batch([pa.array(out, pa.binary()), pa.array(found, pa.int64()), pa.array(scores, pa.float64())], ["key", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[pa.RecordBatch] = []
        array: tuple | None = None
        for b in batches:
            if not len(b):
                continue
            place = np.column_stack([np.asarray(b.column(c)) for c in range(4)])
            cut = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1)))
            for lo, hi in zip(cut, np.append(cut[1:], len(place)), strict=True):
                own, kind_ = tuple(place[lo, :3].tolist()), int(place[lo, 3])
                if own != at:
                    at, held, array = own, [], None
                part = b.slice(lo, hi - lo)
                if kind_ == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if array is None:
                    strings = np.concatenate([np.asarray(h.column(5)) for h in held]).view(np.uint64)
                    x = np.concatenate([_vectors(h.column(6), dim, kind) for h in held])
                    order = np.argsort(strings, kind="stable")
                    ids = [i for h in held for i in h.column(7).to_pylist()]
                    array = strings[order], x[order], [ids[o] for o in order.tolist()]
                yield from search(*array, part)

    return run


def nearest(rows: DataFrame, asks: Column | None = None, k: int = 20, id: str = "vec_id", vector: str = "embedding", trees: int = TREES, budget: int = BUDGET) -> DataFrame:
    """The ``k`` nearest found of every asking row: query_id, rank, vec_id, score (the inner product).

    ``asks`` says which rows are queries, by default those whose id is divisible by 20; candidates are all rows but
    those of the query's own id.
    """
    spark = t.tuned(rows.sparkSession)
    good = F.forall(F.col("v"), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(F.col("v"), lambda e: e != 0)
    asks = F.coalesce((F.col(id) % 20 == 0) if asks is None else asks, F.lit(False))
    rows = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), asks.alias("asks")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(good)
    about = rows.select("v").mapInArrow(_sized, "n long, dim int, norm double, single boolean").agg(F.sum("n").alias("n"), F.max("dim").alias("dim"), F.max("norm").alias("norm"), F.every("single").alias("single")).first()
    if about["n"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, kind = about["dim"], "<f4" if about["single"] else "<f8"
    hashed = _Hash(dim, about["norm"], trees)
    merged = F.slice(F.array_distinct(F.array_sort(F.flatten(F.collect_list("ids")))), 1, k + 1)
    folder = f"{t.checkpoint_folder(spark)}/forest-{uuid.uuid4().hex}"
    copies = rows.mapInArrow(_copies(dim, kind, k + 1), _GROUPS)
    copies.groupBy("key").agg(F.first("vector").alias("vector"), merged.alias("ids"), F.bool_or("asks").alias("asks")).write.parquet(folder)
    entries = spark.read.parquet(folder)
    cells = t.sum_vectors(entries.select("vector").mapInArrow(_histogram(hashed, kind), "slice int, blob binary"), trees).collect()  # one size for any input
    layout = spark.sparkContext.broadcast(_Layout(np.stack([np.frombuffer(r["blob"], np.int64) for r in sorted(cells, key=lambda r: r["slice"])])))
    place = ["tree", "run", "part"]
    routed = entries.mapInArrow(_routed(hashed, kind, layout, budget), _ROUTED).repartition(*place).sortWithinPartitions(*place, "kind")
    found = routed.mapInArrow(_searched(dim, kind, k + 1), _FOUND).groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("best"))
    queries = rows.where("asks").select("vec_id", "v").mapInArrow(_asking(dim, kind), "key binary, query_id long").distinct()
    others = F.filter("best", lambda e: e["vec_id"] != F.col("query_id"))
    out = queries.join(best, "key").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "e"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))
