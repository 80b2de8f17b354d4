"""Completeness of crawled history: page plans, missing rows, contiguous frontiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REACHED_FLOOR, EXHAUSTED = "ReachedFloor", "HistoryExhausted"


def ranked(rows: DataFrame, part: list[str], slot: str, ties: list[str], width: int = 1 << 10) -> DataFrame:
    """``rank`` from 1, newest slot first, of each row within its part, without one task a part.

    Rows are numbered within ranges of slots; the ranges' running sums, one small row for each, are
    joined on. So a part of any size is spread over its ranges.
    """
    rows = rows.withColumn("_range", F.floor(F.col(slot) / width))
    sums = rows.groupBy(*part, "_range").agg(F.count("*").alias("_n"))
    newer = Window.partitionBy(*part).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(newer), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(*part, "_range").orderBy(F.desc(slot), *ties))
    return rows.withColumn("_own", own).join(before, [*part, "_range"]).withColumn("rank", (F.col("_own") + F.col("_before")).cast("long")).drop("_own", "_before", "_range")


def plan_pages(signatures: DataFrame, floor: int, page_size: int, width: int = 1 << 10) -> DataFrame:
    """A newest-to-oldest walk by pages of each program: what each page expects and where it stops.

    ``signatures`` has program_id, signature, slot, failed. A page is ``page_size`` entries and one more
    as a probe. Columns: page, n_expected, n_failed, newest and oldest slot, until (the entry below the
    window), next_cursor (the window's last entry, failed or not, if the walk goes on) and stop. Slots at
    the floor belong to the walk; pages after a stop don't exist. A program without entries has no page.
    """
    r = ranked(signatures, ["program_id"], "slot", ["signature"], width)
    r = r.withColumn("below", F.col("slot") < floor).withColumn("page", F.floor((F.col("rank") - 1) / page_size))
    # an entry is also the probe of the page before, if it is the first of its own
    probe = r.where(((F.col("rank") - 1) % page_size == 0) & (F.col("rank") > 1)).withColumn("page", F.col("page") - 1).withColumn("probe", F.lit(True))
    entry = F.struct("rank", "signature")
    seen = r.withColumn("probe", F.lit(False)).unionByName(probe)
    inside = ~F.col("below") & ~F.col("probe")
    pages = seen.groupBy("program_id", "page").agg(
        F.count_if(inside & ~F.col("failed")).alias("n_expected"),
        F.count_if(inside & F.col("failed")).alias("n_failed"),
        F.max(F.when(inside, F.col("slot"))).alias("newest_slot"),
        F.min(F.when(inside, F.col("slot"))).alias("oldest_slot"),
        F.min(F.when(F.col("below"), entry)).alias("_floor"),
        F.max(F.when(F.col("probe"), entry)).alias("_probe"),
        F.max(F.when(~F.col("probe"), entry)).alias("_last"),
        F.min(F.when(~F.col("probe"), F.col("below").cast("int"))).alias("_all_below"),
    )
    stop = F.when(F.col("_floor").isNotNull(), F.lit(REACHED_FLOOR)).when(F.col("_probe").isNull(), F.lit(EXHAUSTED))
    # a page that lies wholly below the floor exists only as the first, since the one before has stopped at its probe
    pages = pages.where((F.col("page") == 0) | (F.col("_all_below") == 0))
    return pages.select(
        "program_id", F.col("page").cast("long").alias("page"), "n_expected", "n_failed", "newest_slot", "oldest_slot",
        F.coalesce("_floor.signature", "_probe.signature").alias("until"), F.when(stop.isNull(), F.col("_last.signature")).alias("next_cursor"), stop.alias("stop"),
    )


def below_cursor(signatures: DataFrame, cursors: DataFrame) -> DataFrame:
    """The entries strictly below each program's cursor, in newest-first order; all if it has none."""
    c = cursors.select("program_id", F.col("slot").alias("_slot"), F.col("signature").alias("_signature"))
    rest = F.col("_slot").isNull() | (F.col("slot") < F.col("_slot")) | ((F.col("slot") == F.col("_slot")) & (F.col("signature") > F.col("_signature")))
    return signatures.join(c, "program_id", "left").where(rest).select(*signatures.columns)


def missing(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """Expected signatures that were not delivered; whether they gave rows doesn't matter."""
    return expected.where(~F.col("failed")).join(delivered.select("program_id", "signature"), ["program_id", "signature"], "left_anti").select("program_id", "signature", "slot")


def walk_summary(pages: DataFrame) -> DataFrame:
    """Windows, expected and failed entries, newest and oldest slot of each program's walk."""
    return pages.groupBy("program_id").agg(
        F.count("*").alias("windows"), F.sum("n_expected").alias("expected"), F.sum("n_failed").alias("failed"), (F.sum("n_expected") + F.sum("n_failed")).alias("enumerated"),
        F.max("newest_slot").alias("newest_slot"), F.min("oldest_slot").alias("oldest_slot"), F.max("stop").alias("stop"),
    )


def finish_backfill(sync: DataFrame, walks: DataFrame) -> DataFrame:
    """Marks a program complete iff the floor that its walk used is not above its real floor."""
    w = walks.select("program_id", F.col("floor_used").alias("_floor"))
    done = F.col("backfill_complete") | F.coalesce(F.col("_floor") <= F.col("backfill_floor_slot"), F.lit(False))
    return sync.join(w, "program_id", "left").withColumn("backfill_complete", done).select(*sync.columns)


def kept_cursors(cursors: DataFrame, sync: DataFrame) -> DataFrame:
    """Cursors of complete programs go, those of partial walks stay."""
    return cursors.join(sync.where("backfill_complete").select("program_id"), "program_id", "left_anti")


def advance_frontier(sync: DataFrame, tips: DataFrame, lacking: DataFrame) -> DataFrame:
    """Moves each complete program's frontier to its tip, taken before the walk, if nothing is missing.

    ``lacking`` holds missing signatures (program_id, slot). Each program is decided alone.
    """
    s = sync.join(tips.select("program_id", F.col("slot").alias("_tip")), "program_id", "left")
    gaps = lacking.join(s.select("program_id", F.col("last_contiguous_slot").alias("_from"), "_tip"), "program_id").where("slot > _from and slot <= _tip").groupBy("program_id").agg(F.count("*").alias("_gaps"))
    clean = F.col("backfill_complete") & F.col("_gaps").isNull()
    return s.join(gaps, "program_id", "left").withColumn("last_contiguous_slot", F.when(clean, F.greatest("last_contiguous_slot", "_tip")).otherwise(F.col("last_contiguous_slot"))).select(*sync.columns)


def gap_state(events: DataFrame) -> DataFrame:
    """Whether each program's gap is open after its last event, and whether its frontier may move.

    ``events``: program_id, seq, kind of session_start, session_end, walk_done or complete. A gap is open
    at the start and after each session's end; a finished walk closes it. Both gates are needed.
    """
    last = lambda kinds: F.max(F.when(F.col("kind").isin(*kinds), F.col("seq")))
    e = events.groupBy("program_id").agg(last(("session_end",)).alias("ended"), last(("walk_done",)).alias("walked"), last(("complete",)).alias("complete"))
    is_open = F.col("walked").isNull() | F.coalesce(F.col("ended") > F.col("walked"), F.lit(False))
    return e.select("program_id", is_open.alias("gap_open"), (~is_open & F.col("complete").isNotNull()).alias("may_advance"))


def slot_lag(sync: DataFrame, tip: int) -> DataFrame:
    """Slots behind the tip of each program, not below 0."""
    return sync.select("program_id", F.greatest(F.lit(tip) - F.col("last_contiguous_slot"), F.lit(0)).cast("long").alias("slot_lag"))
