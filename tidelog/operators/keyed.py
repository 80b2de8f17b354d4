"""Keyed state: idempotent append, slot-guarded upsert, soft close, snapshot sweep.

Rows carry an explicit ``arrival`` where order of arrival matters; a stored row counts as arrived
before all others. Everything is a union with one aggregation by key, or a join by key; nothing is
collected. Within one batch upserts come before closes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STORED = -1


def append_dedup(rows: DataFrame, key: list[str], arrival: Column | str) -> DataFrame:
    """The first-arrived row of each key; ties in arrival are broken by the whole row."""
    arrival = F.col(arrival) if isinstance(arrival, str) else arrival
    rest = [c for c in rows.columns if c not in key]
    first = rows.groupBy(*key).agg(F.min(F.struct(arrival.alias("_a"), *rest)).alias("r"))
    return first.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def append_new(stored: DataFrame, rows: DataFrame, key: list[str], arrival: Column | str) -> DataFrame:
    """What an idempotent append adds to ``stored``: first arrivals of keys that it lacks."""
    return append_dedup(rows, key, arrival).join(stored.select(*key), key, "left_anti").select(*rows.columns)


def newest_rows(updates: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """``updates`` without those that a later slot of their key outdoes, or at their slot an earlier arrival.

    Which they are is found from the numbers alone, in two aggregations by hash; wide rows are neither sorted nor
    gathered for it. Rows that tie in slot and arrival all stay.
    """
    first = updates.groupBy(*key, "slot").agg(F.min(arrival).alias("_first"))
    best = first.groupBy(*key).agg(F.max("slot").alias("_slot"), F.max_by("_first", F.coalesce("slot", F.lit(-(1 << 63)))).alias("_first"))
    mine = [F.col(f"u.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    won = [*mine, F.col("u.slot").eqNullSafe(F.col("n._slot")), F.col(f"u.{arrival}").eqNullSafe(F.col("n._first"))]
    return updates.alias("u").join(best.alias("n"), won, "left_semi")


def newest_updates(updates: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """Of each key's updates the one with the largest slot, the first-arrived of equal ones; all that a batch can change."""
    rest = [c for c in updates.columns if c not in (*key, arrival)]
    order = F.struct(F.col("slot"), *([-F.col(arrival)] if arrival in updates.columns else []))
    return updates.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def last_closes(closes: DataFrame, key: list[str]) -> DataFrame:
    """Each key's latest close; earlier ones of a batch can't outdo it."""
    return closes.groupBy(*key).agg(F.max("slot").alias("slot"))


def slot_guarded_upsert(state: DataFrame, updates: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """Insert if absent, replace iff the stored slot is strictly smaller; a replaced row is open.

    At equal slots the stored row stays, then the first-arrived update. ``updates`` has the columns
    of ``state`` without ``closed_at_slot``, and the arrival.
    """
    payload = [c for c in state.columns if c not in (*key, "closed_at_slot")]
    old = state.select(*key, *payload, "closed_at_slot", F.lit(STORED).cast("long").alias("_arrival"))
    new = updates.select(*key, *payload, F.lit(None).cast("long").alias("closed_at_slot"), F.col(arrival).cast("long").alias("_arrival"))
    kept = ["closed_at_slot", *payload]
    order = F.struct(F.col("slot"), -F.col("_arrival"))
    row = old.unionByName(new).groupBy(*key).agg(F.max_by(F.struct(*kept), order).alias("r"))
    return row.select(*[F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in state.columns])


def soft_close(state: DataFrame, closes: DataFrame, key: list[str], when: Column | None = None) -> DataFrame:
    """Sets slot and closed_at_slot to the latest close of the row's key iff it is past the row's slot.

    The payload stays; a close of an unknown key does nothing; a later close overwrites an earlier.
    ``when`` is a further condition on the stored row.
    """
    last = closes.groupBy(*key).agg(F.max("slot").alias("_close"))
    hit = F.col("_close") > F.col("slot")
    hit = hit if when is None else hit & F.coalesce(when, F.lit(False))
    out = state.join(last, key, "left").withColumn("_hit", F.coalesce(hit, F.lit(False)))
    new = {"slot": F.when(F.col("_hit"), F.col("_close")).otherwise(F.col("slot")), "closed_at_slot": F.when(F.col("_hit"), F.col("_close")).otherwise(F.col("closed_at_slot"))}
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in state.columns])


def close_routed(tables: DataFrame, closes: DataFrame, key: list[str]) -> DataFrame:
    """Closes in the named table only, over rows tagged with ``table``."""
    return soft_close(tables, closes, ["table", *key])


def close_everywhere(tables: DataFrame, closes: DataFrame, key: list[str]) -> DataFrame:
    """Closes of a key whose table isn't known, over all rows tagged with ``table``."""
    return soft_close(tables, closes, key)


def close_if_last(state: DataFrame, removals: DataFrame, key: list[str], items: str = "locations", item: str = "postcode") -> DataFrame:
    """Closes iff the guard holds and the list's only element is the removed one.

    Of a key's removals only those that name the only element count, the latest of them.
    """
    only = state.where(F.size(items) == 1).select(*key, F.get(items, F.lit(0))[item].alias(item))
    return soft_close(state, removals.join(only, [*key, item], "left_semi"), key)


def open_keys(tables: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """(table, key) of all open rows of all tables."""
    parts = [df.where(F.col("closed_at_slot").isNull()).select(F.lit(name).alias("table"), *key) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def close_missing(state: DataFrame, live: DataFrame, snapshot_slot: int, key: list[str]) -> DataFrame:
    """Rows that are open, older than the snapshot and not in it are closed at its slot."""
    seen = live.select(*key).distinct().withColumn("_seen", F.lit(True))
    gone = F.col("closed_at_slot").isNull() & (F.col("slot") < snapshot_slot) & F.col("_seen").isNull()
    out = state.join(seen, key, "left").withColumn("_gone", gone)
    new = {c: F.when(F.col("_gone"), F.lit(snapshot_slot).cast("long")).otherwise(F.col(c)) for c in ("slot", "closed_at_slot")}
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in state.columns])


def missing_keys(state: DataFrame, live: DataFrame, snapshot_slot: int, key: list[str]) -> DataFrame:
    """The rows that ``close_missing`` closes."""
    return state.where(F.col("closed_at_slot").isNull() & (F.col("slot") < snapshot_slot)).join(live.select(*key), key, "left_anti").select(*state.columns)


def apply_batch(state: DataFrame, updates: DataFrame, closes: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """One batch: its upserts, then its closes, each in any order."""
    return soft_close(slot_guarded_upsert(state, updates, key, arrival), closes, key)


def snapshot_summary(state: DataFrame, live: DataFrame, rejected: DataFrame, snapshot_slot: int, key: list[str]) -> DataFrame:
    """One row: loaded, undecodable, closed_missing."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return one(live, "loaded").crossJoin(one(rejected, "undecodable")).crossJoin(one(missing_keys(state, live, snapshot_slot, key), "closed_missing"))


# --- bookkeeping: a row for each program, so any of it is small ---------------------------------


def seed_if_absent(sync: DataFrame, programs: DataFrame) -> DataFrame:
    """Adds programs that have no row: the frontier starts at the floor, and nothing is complete."""
    fresh = programs.join(sync, "program_id", "left_anti").select(
        "program_id", F.col("floor_slot").alias("last_contiguous_slot"), F.lit(False).alias("backfill_complete"), F.col("floor_slot").alias("backfill_floor_slot"), F.lit(None).cast("long").alias("snapshot_slot")
    )
    return sync.unionByName(fresh, allowMissingColumns=True)


def advance_monotonic(state: DataFrame, moves: DataFrame, key: list[str], column: str = "last_contiguous_slot") -> DataFrame:
    """A slot that only moves forward, by the largest of a key's moves."""
    to = moves.groupBy(*key).agg(F.max("slot").alias("_to"))
    return state.join(to, key, "left").withColumn(column, F.greatest(column, "_to")).select(*state.columns)


def set_field(state: DataFrame, values: DataFrame, key: list[str], column: str) -> DataFrame:
    """A plain setter: rows of ``values`` (key, value) overwrite the column."""
    new = values.select(*key, F.struct("value").alias("_v"))
    return state.join(new, key, "left").withColumn(column, F.when(F.col("_v").isNotNull(), F.col("_v.value")).otherwise(F.col(column))).select(*state.columns)


def set_cursor(cursors: DataFrame, new: DataFrame) -> DataFrame:
    """Unguarded upsert by program."""
    return cursors.join(new, "program_id", "left_anti").unionByName(new.select(*cursors.columns))


def clear_cursor(cursors: DataFrame, programs: DataFrame) -> DataFrame:
    return cursors.join(programs, "program_id", "left_anti")
