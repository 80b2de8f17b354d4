"""Keyed tables as Parquet folders of committed batches, folded on read.

A commit is one batch of one source (a stream, a history run, a snapshot). It writes its changes of each
table to folders of its own and, last of all, one commit row; only batches that have a commit row are
read. So all changes of a batch appear together or not at all, a replayed batch writes nothing new, and
sources that count their batches alike can't touch each other's. A source commits its batches in order.

Reading folds the committed batches of each key: log tables keep the first arrived row, bookkeeping
tables each column's last value, state tables go through guarded upserts and closes batch by batch, as if applied one
after the other. A batch is reduced to one upsert and one close a key when it is written, so a key has at most
two changes a batch. Commits are numbered, each one past those that are there; no clock decides.

``compact`` folds a table's committed batches into a base, bucketed and sorted by key: reads then join the few later
changes to it, and the base itself isn't shuffled. A base holds what the batches came to in their order, so when
it is made changes no later read. Folders of batches that a base covers may be deleted.

Closes of all tables are one tagged frame, written once with a folder a table.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.core.schemas import BOOK_TABLES, LOG_TABLES, STATE_PAYLOAD, key_of, table_schema
from tidelog.operators.keyed import append_dedup, last_closes, newest_updates

_COMMIT = "seq long, tables array<string>, marks map<string,string>, source string, batch long"
_BASE = "seq long, covers map<string,bigint>, buckets int, table string, base string"
UPSERT, CLOSE = 0, 1
#: the tagged closes of all tables
CLOSES = "closes"
_CLOSE_ROWS = "pubkey binary, slot bigint, _only string"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, as the session names it; only a local session may lack it, as tests do."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        import tempfile

        given = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", given)
    return given


@dataclass(frozen=True)
class Commit:
    source: str
    batch: int
    seq: int
    tables: tuple[str, ...]
    marks: dict[str, str]


class Store:
    """The tables below one folder. ``pending`` commits are visible to this object only."""

    def __init__(self, spark: SparkSession, root: str, pending: tuple[Commit, ...] = ()):
        self.spark, self.root, self.pending = spark, root.rstrip("/"), pending
        if not pending:
            self._note("commits", "source=init/batch=-1", [(0, [], {})], "seq long, tables array<string>, marks map<string,string>", "ignore")
            self._note("bases", "table=init/base=none", [(0, {}, 0)], "seq long, covers map<string,bigint>, buckets int", "ignore")

    def _note(self, kind: str, folder: str, rows: list[tuple], schema: str, mode: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(f"{self.root}/{kind}/{folder}")

    # --- commits -------------------------------------------------------------------------------

    def commits(self) -> list[Commit]:
        """The commits in order, one small row a batch."""
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.root}/commits").where("source <> 'init'").collect()
        found = [Commit(r["source"], r["batch"], r["seq"], tuple(r["tables"]), dict(r["marks"])) for r in rows]
        return sorted([*found, *self.pending], key=lambda c: (c.seq, c.source, c.batch))

    def marks(self) -> dict[str, str]:
        """All completion marks; later ones win."""
        return reduce(lambda a, c: a | c.marks, self.commits(), {})

    def last_batch(self, source: str) -> int | None:
        """The number of a source's last committed batch."""
        done = [c.batch for c in self.commits() if c.source == source]
        return max([*done, *(high for _, covers, _ in self._bases().values() for s, high in covers.items() if s == source)], default=None)

    def commit(self, source: str, batch: int, changes: list[tuple[str, DataFrame]], marks: dict[str, str] | Callable[[], dict[str, str]] | None = None, verify: Callable[[Store], bool] | None = None) -> bool:
        """Commits the changes and marks of a source's batch together; False if it was committed before.

        ``marks`` may be asked for after the changes are written, when what was observed of them is known.
        ``verify`` sees the store with the batch in it; if it says no, nothing of the batch becomes visible,
        its marks included.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", source):
            raise ValueError(f"not a source's name: {source!r}")
        done = {c.batch for c in self.commits() if c.source == source}
        covered = max((high for _, covers, _ in self._bases().values() for s, high in covers.items() if s == source), default=-math.inf)
        if batch in done or batch <= covered:
            return False
        if done and batch < max(done):
            raise ValueError(f"{source}: batch {batch} comes after batch {max(done)}")
        tables = []
        for table, rows in changes:
            write = rows.write.mode("overwrite")
            (write.partitionBy("table") if table == CLOSES else write).parquet(f"{self.root}/rows/{table}/{source}/{batch}")
            tables.append(table)
        marks = marks() if callable(marks) else marks
        number = 1 + max((c.seq for c in self.commits()), default=0)
        new = Commit(source, batch, number, tuple(tables), {k: str(v) for k, v in (marks or {}).items()})
        if verify and not verify(Store(self.spark, self.root, (new,))):
            return False
        self._note("commits", f"source={source}/batch={batch}", [(new.seq, list(tables), new.marks)], "seq long, tables array<string>, marks map<string,string>", "overwrite")
        return True

    # --- changes -------------------------------------------------------------------------------

    def appended(self, table: str, rows: DataFrame, arrival: Column) -> tuple[str, DataFrame]:
        """First arrivals of a batch for a log table."""
        return table, append_dedup(rows, key_of(table), arrival)

    def put(self, table: str, rows: DataFrame, gone: DataFrame | None = None) -> tuple[str, DataFrame]:
        """Values of a bookkeeping table's rows, each column for itself (NULL or absent: left as it is), and keys to remove."""
        rows = rows.withColumn("_gone", F.lit(False))
        if gone is not None:
            rows = gone.select(*key_of(table), F.lit(True).alias("_gone")).unionByName(rows, allowMissingColumns=True)
        fields = table_schema(table).fields
        return table, rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields], "_gone")

    def changed(self, table: str, updates: DataFrame | None = None, closes: DataFrame | None = None) -> tuple[str, DataFrame]:
        """A batch's upserts (with ``arrival``) and closes (pubkey, slot, and maybe ``postcode``: only if the
        row's list holds that one item alone) for a state table."""
        parts = []
        if updates is not None:
            parts.append(newest_updates(updates, key_of(table)).withColumn("_phase", F.lit(UPSERT)).withColumn("_only", F.lit(None).cast("string")))
        if closes is not None:
            only = F.col("postcode") if "postcode" in closes.columns else F.lit(None).cast("string")
            parts.append(last_closes(closes.withColumn("_only", only), [*key_of(table), "_only"]).withColumn("_phase", F.lit(CLOSE)))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        schema = table_schema(table)
        have = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return table, rows.select(*have, "_phase", "_only")

    def routed(self, closes: DataFrame) -> tuple[str, DataFrame]:
        """A batch's closes of any tables (table, pubkey, slot, and maybe ``postcode``), in one frame."""
        only = F.col("postcode") if "postcode" in closes.columns else F.lit(None).cast("string")
        rows = last_closes(closes.withColumn("_only", only), ["table", "pubkey", "_only"])
        return CLOSES, rows.select("pubkey", F.col("slot").cast("long").alias("slot"), "_only", "table")

    # --- reading -------------------------------------------------------------------------------

    def _bases(self) -> dict[str, tuple[str, dict[str, int], int]]:
        """Each table's newest base: its folder, the last batch of each source that it covers, and its buckets."""
        rows = self.spark.read.schema(_BASE).parquet(f"{self.root}/bases").where("table <> 'init'").collect()
        return {r["table"]: (r["base"], dict(r["covers"]), r["buckets"]) for r in sorted(rows, key=lambda r: (r["seq"], r["base"]))}

    def _base(self, table: str, base: str, buckets: int) -> DataFrame:
        """A base as a table of its buckets; any session finds it by its folder."""
        name = f"base_{base}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(table).fields)
            key = ", ".join(key_of(table))
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{self.root}/folded/{table}/{base}'")
        return self.spark.table(name)

    def _deltas(self, table: str, commits: list[Commit], schema: str, closes: bool) -> DataFrame | None:
        """The table's rows of these commits, or its closes, with the commits' order."""
        kind = CLOSES if closes else table
        commits = [(n, c) for n, c in enumerate(commits) if kind in c.tables]
        if not commits:
            return None
        folders = [f"{self.root}/rows/{kind}/{c.source}/{c.batch}" for _, c in commits]
        read = self.spark.read.schema(f"{_CLOSE_ROWS}, table string" if closes else schema)
        up = 2 if closes else 1
        if closes:  # a folder a table below each; the others are pruned
            rows = reduce(DataFrame.unionByName, [read.parquet(f) for f in folders]).where(F.col("table") == table).drop("table")
        else:
            rows = read.parquet(*folders)
        place = F.element_at(F.split(F.input_file_name(), "/"), -1 - up), F.element_at(F.split(F.input_file_name(), "/"), -2 - up)
        order = self.spark.createDataFrame([(c.source, c.batch, n) for n, c in commits], "_source string, _batch long, _order long")
        return rows.withColumn("_batch", place[0].cast("long")).withColumn("_source", place[1]).join(F.broadcast(order), ["_source", "_batch"]).drop("_source", "_batch")

    def read(self, table: str) -> DataFrame:
        """The table as of the commits that are there now."""
        return self._fold(table)[0]

    def _fold(self, table: str) -> tuple[DataFrame, dict[str, int]]:
        base, covers, buckets = self._bases().get(table, (None, {}, 0))
        state = table in STATE_PAYLOAD
        own = [c for c in self.commits() if (table in c.tables or state and CLOSES in c.tables) and c.batch > covers.get(c.source, -1)]
        schema, key = table_schema(table), key_of(table)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        extra = {"_gone": "boolean"} if table in BOOK_TABLES else {"_phase": "int", "_only": "string"} if table in STATE_PAYLOAD else {}
        old = None if base is None else self._base(table, base, buckets)
        new = self._deltas(table, own, ", ".join([ddl, *[f"{k} {v}" for k, v in extra.items()]]), False)
        shut = self._deltas(table, own, "", True) if state else None
        if shut is not None:
            shut = shut.withColumn("_phase", F.lit(CLOSE))
            new = shut if new is None else new.unionByName(shut, allowMissingColumns=True)
            if new is shut:
                new = shut.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in shut.columns])
        reach = covers | {s: max(c.batch for c in own if c.source == s) for s in {c.source for c in own}}
        if new is None:
            return (self.spark.createDataFrame([], schema) if old is None else old), reach
        if table in LOG_TABLES:
            out = append_dedup(new, key, "_order").drop("_order").select(*schema.fieldNames())
            if old is not None:  # what the base has stays where it is
                out = old.unionByName(out.join(old.select(*key), key, "left_anti").select(*old.columns))
        elif table in BOOK_TABLES:
            if old is not None:  # a row a program
                new = old.withColumn("_gone", F.lit(False)).withColumn("_order", F.lit(-1).cast("long")).unionByName(new)
            out = _last_values(new, key)
        else:
            out = _applied(new, key, old)
        return out.select(*schema.fieldNames()), reach

    def compact(self, table: str, buckets: int | None = None) -> None:
        """Folds the table's committed batches into a new base of so many buckets (as many as shuffles have, by default)."""
        rows, reach = self._fold(table)
        name = uuid.uuid4().hex
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        key = key_of(table)
        number = 1 + max((c.seq for c in self.commits()), default=0)
        # one file a bucket: rows go to their bucket's task before they are written
        dealt = rows.repartition(buckets, *key)
        dealt.write.option("path", f"{self.root}/folded/{table}/{name}").bucketBy(buckets, *key).sortBy(*key).saveAsTable(f"base_{name}")
        self._note("bases", f"table={table}/base={name}", [(number, reach, buckets)], "seq long, covers map<string,bigint>, buckets int", "overwrite")


def _last_values(changes: DataFrame, key: list[str]) -> DataFrame:
    """Each column's last value since the key was last removed; a removal and a row of one commit leave the row."""
    rest = [c for c in changes.columns if c not in (*key, "_gone", "_order")]
    place = F.struct("_order", (~F.col("_gone")).alias("later"))
    values = [F.max(F.when(F.col(c).isNotNull() & ~F.col("_gone"), F.struct(place.alias("at"), F.col(c).alias("v")))).alias(c) for c in rest]
    rows = changes.groupBy(*key).agg(F.max(F.when(F.col("_gone"), place)).alias("_gone"), F.max(F.when(~F.col("_gone"), place)).alias("_set"), *values)
    since = lambda at: F.col("_gone").isNull() | (at > F.col("_gone"))
    return rows.where(F.col("_set").isNotNull() & since(F.col("_set"))).select(*key, *[F.when(since(F.col(f"{c}.at")), F.col(f"{c}.v")).alias(c) for c in rest])


def _applied(changes: DataFrame, key: list[str], base: DataFrame | None = None) -> DataFrame:
    """Guarded upserts and closes of each key in the order of their commits, onto the base's row; a key has a few changes."""
    payload = [c for c in changes.columns if c not in (*key, "slot", "closed_at_slot", "_phase", "_only", "_order")]
    event = F.struct("_order", "_phase", "slot", "closed_at_slot", "_only", F.struct(*payload).alias("p"))
    rows = changes.groupBy(*key).agg(F.array_sort(F.collect_list(event)).alias("e"))
    kind = next(f for f in rows.schema["e"].dataType.elementType.fields if f.name == "p").dataType.simpleString()

    def step(now: Column, e: Column) -> Column:
        put = F.struct(e["slot"].alias("slot"), e["closed_at_slot"].alias("closed_at_slot"), e["p"].alias("p"))
        shut = F.struct(e["slot"].alias("slot"), e["slot"].alias("closed_at_slot"), now["p"].alias("p"))
        newer = now["slot"] < e["slot"]
        meant = e["_only"].isNull()
        if "locations" in payload:
            items = now["p"]["locations"]
            meant = meant | F.coalesce((F.size(items) == 1) & (F.get(items, F.lit(0))["postcode"] == e["_only"]), F.lit(False))
        return F.when((e["_phase"] == UPSERT) & (now.isNull() | newer), put).when((e["_phase"] == CLOSE) & now.isNotNull() & newer & meant, shut).otherwise(now)

    start = F.lit(None).cast(f"struct<slot:bigint,closed_at_slot:bigint,p:{kind}>")
    if base is not None:
        old = F.struct("slot", "closed_at_slot", F.struct(*payload).cast(kind).alias("p")).alias("_old")
        rows = base.select(*key, old).join(rows, key, "full_outer")
        start = F.coalesce("_old", start)
    fold = F.aggregate("e", start, step) if base is None else F.when(F.col("e").isNull(), start).otherwise(F.aggregate("e", start, step))
    out = rows.select(*key, fold.alias("s")).where("s is not null")  # a close alone makes no row
    return out.select(*key, "s.slot", "s.closed_at_slot", *[F.col(f"s.p.{c}").alias(c) for c in payload])
