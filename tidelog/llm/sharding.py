"""K-d tree partitioning: shards as leaves of recursive weighted medians over document metadata.

Items are groups of equal texts, which stay together. Each item has a position in every dimension (size,
language, source, length in characters), made a total order by a hash of its text. A node with several
leaves is cut along its widest dimension where the weight splits as its leaves' targets do. One pass a
level counts the weights of all nodes in all dimensions; the cut is then found by refining the histogram
around it, for all nodes at once, so the driver only ever sees a few numbers a node and bucket. Cutting stops
when every leaf has its target bytes.

Copies of one text that are together heavy (over 1/64 of a shard) would upset the balance wherever the tree puts
them. There are at most 64 such groups a shard, and they are dealt out first, the heaviest to the emptiest shard;
what is left of each shard's target is its leaf's. A group that alone exceeds a shard's target can't stay
together: it is dealt in pieces of about an eighth of a shard.

Law: ``bytes``, shard sizes are near equal (within about the heaviest item of the tree).

Defined cases: a null text has no bytes and size 8; null metadata sorts first; repeated rows are copies like
any others; rows without an id are placed too; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import _text as t

SHARDS = 24
#: copies of one text that weigh more than this share of a shard's target are dealt out before the tree
HEAVY = 64
#: pieces a shard's target, of a group that exceeds it
PIECES = 8
BUCKETS = 1 << 13
#: bits of a position that the first histogram of a level tells apart
FIRST_BITS = 10
#: bits of the total order: the dimension's position above, the text's hash below
POSITION_BITS, HASH_BITS = 20, 40
SLOT_ROWS = 50_000
DIMENSIONS = ("d_size", "d_chars", "d_lang", "d_source")


def _position(c: F.Column) -> F.Column:
    """A non-negative number on a log scale, to POSITION_BITS."""
    return F.least(F.lit((1 << POSITION_BITS) - 1), (F.log2(F.coalesce(c.cast("double"), F.lit(0.0)) + 1) * (1 << (POSITION_BITS - 6))).cast("long"))


def _name(c: F.Column) -> F.Column:
    """A name's position, by hash: names have no distances."""
    return F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit(""))), F.lit(1 << POSITION_BITS))


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    low = F.lit((1 << HASH_BITS) - 1)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.xxhash64(F.lit(1), F.coalesce(text, F.lit(""))).bitwiseAND(low).alias("h2"),
        _position(F.col("n_chars")).alias("d_chars"),
        _name(F.col("lang")).alias("d_lang"),
        _name(F.col("source")).alias("d_source"),
    )


def _key(dimension: str) -> F.Column:
    return F.col(dimension) * (1 << HASH_BITS) + F.col("tie")


def _placed(items: DataFrame, targets: list[float]) -> DataFrame:
    """The items with their leaf, as ``node``: level by level, all nodes at once.

    A node's name is its first leaf; a dict holds how many leaves each has. A cut is (node, dimension,
    first key of the right side, left child, right child).
    """
    spark = items.sparkSession
    leaves = {0: len(targets)}
    now, held = items.withColumn("node", F.lit(0)), []
    shift = POSITION_BITS - FIRST_BITS
    while any(n > 1 for n in leaves.values()):
        open_nodes = [k for k, n in leaves.items() if n > 1]
        live = now.where(F.col("node").isin(open_nodes))
        one = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("at")) for d in DIMENSIONS]))
        first = live.select("node", "weight", one.alias("p")).groupBy("node", "p.dim", F.shiftright("p.at", shift).alias("bucket"))
        coarse: dict[int, dict[str, list]] = {k: {d: [] for d in DIMENSIONS} for k in open_nodes}
        for r in first.agg(F.sum("weight").alias("weight"), F.count("*").alias("n"), F.min("p.at").alias("low"), F.max("p.at").alias("high")).collect():
            coarse[r["node"]][r["dim"]].append((r["bucket"], r["weight"], r["n"], r["low"], r["high"]))
        cut: dict[int, list] = {}  # dimension, the cut's range of keys, the weight before it, the weight wanted left of it, leaves left of it
        for k in open_nodes:
            left, by = leaves[k] // 2, coarse[k]
            spread = {d: max((x[4] for x in by[d]), default=0) - min((x[3] for x in by[d]), default=0) for d in DIMENSIONS}
            d = max(DIMENSIONS, key=lambda d: (spread[d], -DIMENSIONS.index(d)))
            own = targets[k : k + leaves[k]]
            share = sum(own[:left]) / sum(own) if sum(own) else left / leaves[k]
            cut[k] = [d, 0, 1 << (POSITION_BITS + HASH_BITS), 0, sum(x[1] for x in by[d]) * share, left]
            _narrow_cut(cut[k], [x[:3] for x in by[d]], 1 << (shift + HASH_BITS))
        while busy := {k: c for k, c in cut.items() if c[2] - c[1] > 1}:
            width = {k: -(-(c[2] - c[1]) // BUCKETS) for k, c in busy.items()}
            rows = [(k, c[0], c[1], c[2], width[k]) for k, c in busy.items()]
            want = F.broadcast(spark.createDataFrame(rows, "node int, dim string, lo long, hi long, width long"))  # at most one row a node
            at = F.coalesce(*[F.when(F.col("dim") == d, _key(d)) for d in DIMENSIONS])
            hist = live.join(want, "node").withColumn("at", at).where("at >= lo and at < hi").groupBy("node", F.expr("(at - lo) div width").cast("int").alias("bucket")).agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
            found: dict[int, list[tuple[int, int, int]]] = {k: [] for k in busy}
            for r in hist.collect():
                found[r["node"]].append((r["bucket"], r["weight"], r["n"]))
            for k, c in busy.items():
                _narrow_cut(c, found[k], width[k])
        level = []
        for k, c in cut.items():
            level.append((k, c[0], c[1], k, k + c[5]))
            leaves[k + c[5]] = leaves[k] - c[5]
            leaves[k] = c[5]
        now = _descend(now, level).persist()  # the next level's passes share it; a lost part is made again from the items
        held.append(now)
    for df in held[:-1]:
        df.unpersist()
    return now


def _narrow_cut(c: list, buckets: list[tuple[int, int, int]], width: int) -> None:
    """Narrows a cut's range to the bucket (number, weight, items) in which the wanted weight is reached."""
    before = c[3]
    for b, w, n in sorted(buckets):
        if before + w > c[4]:
            lo = c[1] + b * width
            if n == 1 or width == 1:  # one item: to the nearer side
                lo = lo + width if before + w - c[4] < c[4] - before else lo
                c[1:4] = lo, lo, before
            else:
                c[1:4] = lo, min(lo + width, c[2]), before
            return
        before += w
    c[1:4] = c[2], c[2], before


def _deal(heavy: list[tuple[tuple, int]], rest: int, shards: int) -> tuple[dict[tuple, int], list[float]]:
    """The shard of each heavy piece, the heaviest first to the emptiest one, and what each shard has left for the tree."""
    held = [(0, k) for k in range(shards)]
    where = {}
    for name, weight in sorted(heavy, key=lambda x: (-x[1], x[0])):
        load, k = heapq.heappop(held)
        where[name] = k
        heapq.heappush(held, (load + weight, k))
    loads = [load for load, _ in sorted(held, key=lambda x: x[1])]
    level, left, free = 0.0, float(rest), sorted(loads)  # how high the rest fills the shards
    for n in range(1, shards + 1):
        level = (left + sum(free[:n])) / n
        if n == shards or level <= free[n]:
            break
    return where, [max(0.0, level - load) for load in loads]


def _descend(rows: DataFrame, level: list[tuple[int, str, int, int, int]]) -> DataFrame:
    """Each row's node after one level's cuts; a level has at most one cut a shard, looked up by the node's number."""
    most = 1 + max(k for k, *_ in level)
    dim, first, right = [0] * most, [None] * most, [None] * most
    for k, d, at, _, to in level:
        dim[k], first[k], right[k] = DIMENSIONS.index(d), at, to
    of = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("node"))
    at = F.get(F.array(*DIMENSIONS), of(dim, "int")) * (1 << HASH_BITS) + F.col("tie")
    return rows.withColumn("node", F.when(at >= of(first, "long"), of(right, "int")).otherwise(F.col("node")))


def _slots(rows: DataFrame, n: int) -> DataFrame:
    """Gapless places in each shard: rows are numbered in hash buckets, the buckets by running sums."""
    buckets = max(16, -(-n // SLOT_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").count()
    before = counts.select("shard", "bucket", (F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")) - 1
    return rows.withColumn("own", own).join(before, ["shard", "bucket"]).withColumn("slot", (F.col("own") + F.col("before")).cast("long"))


def _items(rows: DataFrame) -> DataFrame:
    """The tree's items: groups of equal texts with their weight, positions and place among equals."""
    group = ["h", "h2", "size"]
    # a group's metadata is that of its document with the smallest id
    first = F.min(F.struct("doc_id", "d_chars", "d_lang", "d_source"))
    items = rows.groupBy(*group).agg(F.sum("size").alias("weight"), first.alias("first"))
    tie = F.pmod(F.xxhash64("h", "h2"), F.lit(1 << HASH_BITS))
    return items.select(*group, "weight", "first.d_chars", "first.d_lang", "first.d_source", _position(F.col("size")).alias("d_size"), tie.alias("tie"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    spark = docs.sparkSession
    narrow = t.checkpoint(_narrow(docs))
    total = narrow.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    if not total["n"]:
        return narrow.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    target, group = total["bytes"] / shards, ["h", "h2", "size"]
    sums = narrow.groupBy(*group).agg(F.sum("size").alias("weight"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("weight") > target / HEAVY))
    large = sums.select(*group, F.when(F.col("weight") > target, F.ceil(F.col("weight") * PIECES / target)).otherwise(1).cast("long").alias("pieces"))
    large = t.checkpoint(large)  # at most HEAVY groups a shard
    part = F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("long")
    rows = narrow.join(F.broadcast(large), group, "left").withColumn("part", part)
    pieces = rows.where("pieces is not null").groupBy(*group, "part").agg(F.sum("size").alias("weight"))
    heavy = [(tuple(r[:4]), r[4]) for r in pieces.collect()]  # and at most PIECES more a shard
    light = rows.where("pieces is null")
    where, targets = _deal(heavy, total["bytes"] - sum(w for _, w in heavy), shards)
    placed = _placed(t.checkpoint(_items(light)), targets)
    out = light.join(placed.select(*group, F.col("node").alias("shard")), group).select("doc_id", "size", "text_crc32", "shard")
    if where:
        dealt = spark.createDataFrame([(*name, k) for name, k in where.items()], "h long, h2 long, size long, part long, shard int")
        out = out.unionByName(rows.where("pieces is not null").join(F.broadcast(dealt), [*group, "part"]).select("doc_id", "size", "text_crc32", "shard"))
    out = t.checkpoint(out)
    placed.unpersist()
    return _slots(out, total["n"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
