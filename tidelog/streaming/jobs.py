"""Streaming forms: the batch transformations inside ``foreachBatch``, folds that stream as they are, and
the jobs that join them: snapshot, history and reconcile runs.

Late rows are legal at any time, so nothing here has a watermark: the slot guard and the folds decide.
Progress is the stream's checkpoint; the store skips batches that a source has committed. Every writer
serves batch and stream alike, and several of them write one store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.core.registry import Program, action_rule_table, close_rule_table, program_dimension
from tidelog.operators import completeness, fold, keyed, mapping, payloads
from tidelog.operators.keyed import open_keys
from tidelog.sources.store import CLOSES, Store

#: the writer's batch limits: a trigger, and how many files of the feed a batch takes (``read_changes``)
FLUSH_INTERVAL = "250 milliseconds"
FLUSH_FILES = 100


def observed(seen: Observation) -> int:
    """The observed count ``n``, once its frame is written; where Spark saw that a frame is empty, it left it out of the plan, and
    the observation is empty too."""
    try:
        return seen.get["n"]
    except Py4JJavaError as e:
        if "assertion failed" in str(e):
            return 0
        raise


def transaction_writer(store: Store, source: str, times: DataFrame | None = None, tables: Iterable[str] | None = None, compact_every: int = 100, also: list[tuple[str, DataFrame]] | None = None) -> Callable[[DataFrame, int], None]:
    """History, actions, closes and rejects of a batch of transactions, committed together.

    ``tables``: the state tables that closes are written to, by default all that close rules name. ``also``:
    further changes of the same commit.
    """
    tables = None if tables is None else list(tables)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = times if times is not None else spark.createDataFrame([], "slot bigint, block_time bigint")
        acting, closing = action_rule_table(spark), close_rule_table(spark)
        judged = mapping.judged_instructions(batch, program_dimension(spark), acting, closing, known).persist()  # several tables are written from it
        try:
            m = mapping.mapped(judged, acting, closing)
            changes = [
                store.appended("program_instructions", m.history, F.col("slot")),
                store.appended("whitelist_actions", m.actions, F.struct("slot", "id")),
                store.appended("rejects", m.rejected, F.struct("slot", "reason")),
            ]
            shut = m.closes if tables is None else m.closes.where(F.col("table").isin(*tables))
            changes.append(store.routed(shut))
            store.commit(source, number, [*changes, *(also or [])])
        finally:
            judged.unpersist()
        _compacted(store, [t for t, _ in changes if t != CLOSES], number, compact_every)

    return write


def state_writer(store: Store, table: str, source: str, compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """Guarded upserts of a batch of account updates into one state table; rows without payload are closes.

    Payloads that can't be decoded and kinds that no table has change nothing: they are kept with their reason in
    ``account_rejects``, and their number stands in the commit's marks (``<source>-undecodable``: of its last batch).
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            own = batch.where(F.col("kind") == table)
            given = own.where("payload is not null")
            seen = Observation()
            bad = payloads.document_rejects(batch.where("payload is not null"), [table]).observe(seen, F.count("*").alias("n"))
            changes = [store.changed(table, mapping.state_rows(given, table), own.where("payload is null").select("pubkey", "slot")), store.appended("account_rejects", bad, F.lit(0))]
            store.commit(source, number, changes, lambda: {f"{source}-undecodable": str(observed(seen))})
        finally:
            batch.unpersist()
        _compacted(store, [table], number, compact_every)

    return write


def payload_writer(store: Store, program: Program, source: str, compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """Guarded upserts of a program's accounts from their bytes (``data``), into all its tables in one commit.

    Rows without data are closes of the tables that hold their key open. Undecodable ones go as in ``state_writer``.
    """
    tables = [t for t in program.tables if t in payloads.layouts()]

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.where(F.col("owner") == F.lit(bytes(program.id))).persist()
        try:
            given, seen = batch.where("data is not null"), Observation()
            bad = payloads.payload_rejects(given).observe(seen, F.count("*").alias("n"))
            changes = [store.changed(t, payloads.payload_rows(given, t)) for t in tables]
            gone = _tracked_closes(batch.where("data is null").select("pubkey", "slot"), {t: store.read(t) for t in tables})
            store.commit(source, number, [*changes, store.routed(gone), store.appended("account_rejects", bad, F.lit(0))], lambda: {f"{source}-undecodable": str(observed(seen))})
        finally:
            batch.unpersist()
        _compacted(store, tables, number, compact_every)

    return write


def deletion_writer(store: Store, source: str, tables: list[str]) -> Callable[[DataFrame, int], None]:
    """Deletions whose table isn't known: of the keys that some table holds open, tried on every table that has them.

    Each table is read once, and all closes are one frame that is written once.
    """

    def write(batch: DataFrame, number: int) -> None:
        store.commit(source, number, [store.routed(_tracked_closes(batch.select("pubkey", "slot"), {t: store.read(t) for t in tables}))])

    return write


def _tracked_closes(deletions: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, pubkey, slot) of the deletions, for each table that has the key, if any of them holds it open."""
    held = [rows.select(F.lit(t).alias("table"), "pubkey", F.col("closed_at_slot").isNull().alias("_open")) for t, rows in tables.items()]
    last = deletions.groupBy("pubkey").agg(F.max("slot").alias("slot"))
    hit = reduce(DataFrame.unionByName, held).join(last, "pubkey")
    return hit.withColumn("_any", F.max("_open").over(Window.partitionBy("pubkey"))).where("_any").select("table", "pubkey", "slot")


def _compacted(store: Store, tables: list[str], number: int, every: int) -> None:
    if number % every == every - 1:
        for t in tables:
            store.compact(t)


def close_rows(batch: DataFrame) -> DataFrame:
    """The closes that a batch of transactions causes."""
    spark = batch.sparkSession
    return mapping.closes(mapping.instructions(mapping.succeeded(batch), program_dimension(spark)), close_rule_table(spark))[0]


def run_stream(source: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Runs a writer over a stream: at the flush interval, or over what is there now.

    How much a batch takes is set where the stream is read: ``FLUSH_FILES`` files by default.
    """
    w = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=FLUSH_INTERVAL)).start()


# --- jobs over the store -------------------------------------------------------------------------


def seed(store: Store, programs: Iterable[Program]) -> None:
    """A bookkeeping row for every program that has none: the frontier at its floor, nothing complete."""
    for p in programs:
        one = program_dimension(store.spark).where(F.col("program_id") == F.lit(bytes(p.id)))
        have = store.read("sync_state")
        store.commit(f"seed-{p.name}", 0, [store.put("sync_state", keyed.seed_if_absent(have.limit(0), one.join(have, "program_id", "left_anti")))])


def _sync_row(store: Store, program: Program) -> DataFrame:
    return store.read("sync_state").where(F.col("program_id") == F.lit(bytes(program.id)))


def load_snapshot(store: Store, program: Program, updates: DataFrame, snapshot_slot: int) -> DataFrame:
    """Loads all current rows of a program, tagged with a slot that was taken before they were read.

    What the store holds open and the snapshot lacks is closed at that slot; the program's snapshot slot
    is set in the same commit. What can't be decoded is skipped, kept in ``account_rejects`` and counted; but a row
    that is there undecodable isn't missing, so it closes nothing. Returns loaded and closed_missing by table, as
    observed while they were written; ``snapshot_counts`` has the undecodable ones too. A snapshot at or below the last
    one's slot changes nothing, and returns no rows.
    """
    source, schema = f"snapshot-{program.name}", "table string, loaded long, closed_missing long"
    last = store.last_batch(source)
    if last is not None and snapshot_slot <= last:
        return store.spark.createDataFrame([], schema)
    updates = updates.withColumn("slot", F.lit(snapshot_slot).cast("long")).persist()
    try:
        changes, seen, skipped = [], {}, Observation()
        bad = payloads.document_rejects(updates, list(program.tables))
        for t in program.tables:
            seen[t] = Observation(), Observation()
            rows = mapping.state_rows(updates, t)
            there = updates.where(F.col("kind") == t).select("pubkey")
            gone = keyed.missing_keys(store.read(t), there, snapshot_slot, ["pubkey"]).select("pubkey", F.lit(snapshot_slot).cast("long").alias("slot"))
            changes.append(store.changed(t, rows.observe(seen[t][0], F.count("*").alias("n")), gone.observe(seen[t][1], F.count("*").alias("n"))))
        changes.append(store.appended("account_rejects", bad.observe(skipped, F.count("*").alias("n")), F.lit(0)))
        changes.append(store.put("sync_state", store.spark.createDataFrame([(bytearray(program.id), snapshot_slot)], "program_id binary, snapshot_slot long")))
        counts = lambda: [(t, observed(loaded), observed(gone)) for t, (loaded, gone) in seen.items()]
        total = lambda: {"loaded": sum(r[1] for r in counts()), "undecodable": observed(skipped), "closed_missing": sum(r[2] for r in counts())}
        store.commit(source, snapshot_slot, changes, lambda: {source: str(snapshot_slot), f"{source}-counts": json.dumps(total())})
        return store.spark.createDataFrame(counts(), schema)
    finally:
        updates.unpersist()


def snapshot_counts(store: Store, program: Program) -> dict[str, int]:
    """loaded, undecodable and closed_missing of a program's last snapshot."""
    return json.loads(store.marks().get(f"snapshot-{program.name}-counts", "{}"))


def load_history(store: Store, program: Program, signatures: DataFrame, transactions: DataFrame, low: int, high: int, batch: int, times: DataFrame | None = None) -> None:
    """One window of a program's history, newest window first: every expected signature must be delivered.

    The program's cursor moves to the window's oldest entry after its rows are committed; a window that
    reaches the floor completes the backfill and clears the cursor. Something missing is an error, and
    then nothing is marked.
    """
    window = F.col("slot").between(low, high)
    own = signatures.where(window & (F.col("program_id") == F.lit(bytes(program.id))))
    given = mapping.touching(transactions.where(window), [program.id])
    lacking = completeness.missing(own, given.select(F.lit(bytes(program.id)).alias("program_id"), "signature"))
    if some := lacking.limit(3).collect():
        raise ValueError(f"{program.name}: {len(some)} or more signatures were not delivered, such as {bytes(some[0]['signature']).hex()}")
    transaction_writer(store, f"history-{program.name}", times)(given, batch)
    oldest = own.agg(F.min_by(F.struct(F.hex("signature").alias("signature"), "slot"), F.struct("slot", F.hex("signature"))).alias("r"))
    cursor = oldest.where("r is not null").select(F.lit(bytes(program.id)).alias("program_id"), F.lower("r.signature").alias("signature"), "r.slot", F.lit(None).cast("timestamp").alias("updated_at"))
    walk = store.spark.createDataFrame([(bytearray(program.id), low)], "program_id binary, floor_used long")
    sync = completeness.finish_backfill(_sync_row(store, program), walk)
    cursors = completeness.kept_cursors(cursor, sync)
    done = sync.where("backfill_complete").select("program_id")
    store.commit(f"cursor-{program.name}", batch, [store.put("backfill_cursor", cursors, done), store.put("sync_state", done.withColumn("backfill_complete", F.lit(True)))])


def backfill(store: Store, program: Program, signatures: DataFrame, transactions: DataFrame, page_size: int, floor: int | None = None, times: DataFrame | None = None, windows: int | None = None) -> dict[str, int]:
    """Walks a program's history from the newest entry down to the floor, window by window, from where the last run stopped.

    A window is a page of the plan. Its transactions must all be delivered, else the run ends with an error; its rows
    and the cursor at its last entry are one commit, so a run that ends anywhere goes on below the last whole window.
    The window that reaches the floor, or the end of the history, clears the cursor, and completes the program if
    the walk's floor isn't above its real one. A complete program has no cursor: a further run walks all again.
    ``windows`` ends the run after so many. Returns what this run did: windows, expected and failed entries.
    """
    spark, key, source = store.spark, F.lit(bytes(program.id)), f"history-{program.name}"
    sync = _sync_row(store, program).first()
    if sync is None:
        raise ValueError(f"{program.name}: no bookkeeping row; seed it first")
    floor = sync["backfill_floor_slot"] if floor is None else floor
    hexed = F.lower(F.hex("signature")).alias("signature")
    own = signatures.where(F.col("program_id") == key).select("program_id", hexed, "slot", "failed").distinct()
    cursor = store.read("backfill_cursor").where(F.col("program_id") == key).select("program_id", "signature", "slot")
    rest = completeness.below_cursor(own, cursor)
    # what is left, entries by page and the plan of pages are written once a run; a window reads its own page
    folder = f"{store.root}/walks/{source}-{uuid.uuid4().hex}"
    rest.write.parquet(f"{folder}/rest")
    rest = spark.read.parquet(f"{folder}/rest")
    ranked = completeness.ranked(rest, ["program_id"], "slot", ["signature"])
    ranked.where(F.col("slot") >= floor).withColumn("page", F.floor((F.col("rank") - 1) / page_size)).drop("rank").write.partitionBy("page").parquet(f"{folder}/entries")
    plan = completeness.plan_pages(rest, floor, page_size).orderBy("page")
    did = {"windows": 0, "expected": 0, "failed": 0}
    for page in plan.toLocalIterator():  # one small row a window
        if windows is not None and did["windows"] >= windows:
            return did
        changes = _window_changes(store, program, page, floor)
        if page["n_expected"] + page["n_failed"]:
            entries = spark.read.parquet(f"{folder}/entries").where(F.col("page") == page["page"])
            expected = entries.where(~F.col("failed")).select("program_id", F.unhex("signature").alias("signature"), "slot", "failed")
            given = mapping.touching(transactions.where(F.col("slot").between(page["oldest_slot"], page["newest_slot"])), [program.id]).join(expected.select("signature"), "signature", "left_semi")
            lacking = completeness.missing(expected, given.select(key.alias("program_id"), "signature"))
            if some := lacking.limit(3).collect():
                raise ValueError(f"{program.name}: {len(some)} or more signatures were not delivered, such as {bytes(some[0]['signature']).hex()}")
            transaction_writer(store, source, times, also=changes)(given, _next_batch(store, source))
        else:
            store.commit(source, _next_batch(store, source), changes)
        did = {"windows": did["windows"] + 1, "expected": did["expected"] + page["n_expected"], "failed": did["failed"] + page["n_failed"]}
    if not did["windows"]:  # nothing below the cursor, or no history at all
        store.commit(source, _next_batch(store, source), _walk_done(store, program, floor))
    return did


def _next_batch(store: Store, source: str) -> int:
    last = store.last_batch(source)
    return 0 if last is None else last + 1


def _window_changes(store: Store, program: Program, page: Row, floor: int) -> list[tuple[str, DataFrame]]:
    """What a walked window does to the cursor and the program's row."""
    if page["stop"] is not None:
        return _walk_done(store, program, floor)
    cursor = [(bytearray(program.id), page["next_cursor"], page["oldest_slot"])]
    return [store.put("backfill_cursor", store.spark.createDataFrame(cursor, "program_id binary, signature string, slot long"))]


def _walk_done(store: Store, program: Program, floor: int) -> list[tuple[str, DataFrame]]:
    one = store.spark.createDataFrame([(bytearray(program.id), floor)], "program_id binary, floor_used long")
    complete = completeness.finish_backfill(_sync_row(store, program), one).where("backfill_complete").select("program_id", F.lit(True).alias("backfill_complete"))
    none = store.read("backfill_cursor").limit(0)
    return [store.put("backfill_cursor", none, one.select("program_id")), store.put("sync_state", complete)]


def reconcile(store: Store, program: Program, signatures: DataFrame, delivered: DataFrame, tip: int) -> None:
    """Moves a program's frontier to a tip that was taken before the walk, if nothing up to it is missing.

    A tip that isn't ahead of the frontier (another node's, or a lagging one's) is no news: nothing is done.
    """
    spark, key = store.spark, F.lit(bytes(program.id))
    now = _sync_row(store, program).select("last_contiguous_slot").first()
    if now is None or now[0] is not None and tip <= now[0]:
        return
    own = signatures.where(F.col("program_id") == key)
    lacking = completeness.missing(own, delivered.where(F.col("program_id") == key))
    tips = spark.createDataFrame([(bytearray(program.id), tip)], "program_id binary, slot long")
    source = f"reconcile-{program.name}"
    last = store.last_batch(source)
    store.commit(source, 0 if last is None else last + 1, [store.put("sync_state", completeness.advance_frontier(_sync_row(store, program), tips, lacking).select("program_id", "last_contiguous_slot"))])


def follow(start_stream: Callable[[], StreamingQuery], read_tip: Callable[[], int], load: Callable[[int], object]) -> StreamingQuery:
    """The order of a start: the stream first, then the snapshot's slot, then the snapshot itself.

    So a change during the load comes by the stream at a larger slot, and the guard keeps it.
    """
    query = start_stream()
    load(read_tip())
    return query


# --- what streams as it is -----------------------------------------------------------------------


def fold_stream(actions: DataFrame) -> DataFrame:
    """Role assignments of a stream of actions, for the update or complete mode."""
    return fold.role_assignments_of(fold.role_state(actions))


def admins_stream(actions: DataFrame) -> DataFrame:
    return fold.admins_of(fold.admin_state(actions))


def tracked_deletions(deletions: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Deletions of keys that some table holds open."""
    return deletions.join(open_keys(tables, ["pubkey"]).select("pubkey"), "pubkey", "left_semi")


def sessions(arrivals: DataFrame, gap: str, source: str = "source") -> DataFrame:
    """Sessions of input by source: where one ends and the next begins lies a gap. Streams with a watermark."""
    out = arrivals.groupBy(source, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(source, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
