"""Streams with a state of their own for each key: gaps of silent sources, conditions that hold, bounded dedup.

State is kept by source or series, one small value each, in Spark's state store; timers follow the watermark,
so what happens while nothing comes is seen as soon as other sources move on. Rows of one key are taken in the order of their time
within a batch; a row that is older than its key's last one changes nothing. Each has a batch form that gives the same rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.metrics import with_previous
from tidelog.sources.store import Store

# workers get the processors themselves, wherever the package is
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> SparkSession:
    """A session of its own for these streams, whose state store can keep timers; the caller's settings stay."""
    own = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        if (v := spark.conf.get(k, None)) is not None:
            own.conf.set(k, v)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return own


def _millis(ts: pd.Timestamp) -> int:
    return int(ts.value // 1_000_000)


def _times(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(list(frames), ignore_index=True)
    return rows.sort_values("ts", kind="stable")


# --- gaps ----------------------------------------------------------------------------------------

_GAP = "source string, start timestamp, end timestamp"


class _Gaps(StatefulProcessor):
    """Remembers each source's last row; a timer at the time from which it is silent for too long."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.get()[0] if self.last.exists() else None
        last = None if known is None else pd.Timestamp(known)
        gaps = []
        for ts in _times(rows)["ts"]:
            if last is not None and (ts - last).total_seconds() >= self.seconds:
                gaps.append((key[0], last, ts))
            last = ts if last is None else max(last, ts)
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        self.last.update((last.to_pydatetime(),))
        self.handle.registerTimer(_millis(last) + self.seconds * 1000)
        yield pd.DataFrame(gaps, columns=["source", "start", "end"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"source": [key[0]], "start": [pd.Timestamp(self.last.get()[0])], "end": pd.Series([pd.NaT], dtype="datetime64[ns]")})

    def close(self) -> None:
        pass


def gap_stream(arrivals: DataFrame, seconds: int, delay: str) -> DataFrame:
    """Gaps of at least so many seconds between a source's rows (source, ts): a row with its end when the next row comes,
    and before that one without end as soon as the watermark shows the source to be silent."""
    rows = arrivals.select("source", "ts").withWatermark("ts", delay)
    return rows.groupBy("source").transformWithStateInPandas(_Gaps(seconds), _GAP, "append", "EventTime")


def gaps(arrivals: DataFrame, seconds: int, delay_seconds: int) -> DataFrame:
    """The same of a whole table: the last gap of a source is open if the others' rows went on for longer than the delay."""
    rows = with_previous(arrivals.select("source", "ts", F.col("ts").alias("value")), ["source"], name="start")
    closed = rows.where(F.col("ts") >= F.col("start") + F.make_dt_interval(secs=F.lit(seconds))).select("source", "start", F.col("ts").alias("end"))
    last = arrivals.groupBy("source").agg(F.max("ts").alias("start"))
    until = arrivals.agg((F.max("ts") - F.make_dt_interval(secs=F.lit(delay_seconds))).alias("_until"))
    silent = last.crossJoin(until).where(F.col("start") + F.make_dt_interval(secs=F.lit(seconds)) <= F.col("_until"))  # one row
    return closed.unionByName(silent.select("source", "start", F.lit(None).cast("timestamp").alias("end")))


def gap_writer(store: Store, name: str) -> Callable[[DataFrame, int], None]:
    """Gap rows into the bookkeeping table ``gaps``: an open one gets its end when it comes."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.groupBy("source", "start").agg(F.max("end").alias("end"))
        store.commit(name, number, [store.put("gaps", rows)])

    return write


def open_gaps(store: Store) -> DataFrame:
    """(source, start) of the gaps that nothing has ended: while one is there, no frontier may move."""
    return store.read("gaps").where("end is null").select("source", "start")


# --- conditions that hold ------------------------------------------------------------------------

_HELD = "series string, ts timestamp, held_seconds long, first boolean, silent boolean"


class _Held(StatefulProcessor):
    """Remembers since when each series' condition has been on, and whether that was told."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "began timestamp, last timestamp, told boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        began, last, told = self.run.get() if self.run.exists() else (None, None, False)
        began, last = (None if x is None else pd.Timestamp(x) for x in (began, last))
        out = []
        frame = _times(rows)
        for ts, on in zip(frame["ts"], frame["on"], strict=True):
            if last is not None and ts < last:
                continue
            last = ts
            if not on:
                began, told = None, False
                continue
            began = ts if began is None else began
            held = int(ts.timestamp()) - int(began.timestamp())
            if held >= self.seconds:
                out.append((key[0], ts, held, not told, False))
                told = True
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        plain = lambda x: None if x is None else x.to_pydatetime()
        self.run.update((plain(began), plain(last), told))
        if began is not None and not told:
            self.handle.registerTimer(_millis(began) + self.seconds * 1000)
        yield pd.DataFrame(out, columns=["series", "ts", "held_seconds", "first", "silent"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        began, last, told = self.run.get()
        self.run.update((began, last, True))
        yield pd.DataFrame([(key[0], pd.Timestamp(began) + pd.Timedelta(seconds=self.seconds), self.seconds, True, True)], columns=["series", "ts", "held_seconds", "first", "silent"])

    def close(self) -> None:
        pass


def held_stream(conditions: DataFrame, seconds: int, delay: str) -> DataFrame:
    """The rows of (series, ts, on) at which the condition has held for so long, as ``metrics.held_for`` finds them; ``first``
    tells the one that fires. If no row comes in time, the timer fires (``silent``)."""
    rows = conditions.select(F.col("series").cast("string").alias("series"), "ts", F.coalesce("on", F.lit(False)).alias("on")).withWatermark("ts", delay)
    return rows.groupBy("series").transformWithStateInPandas(_Held(seconds), _HELD, "append", "EventTime")


# --- repeated rows -------------------------------------------------------------------------------


def deduplicated(rows: DataFrame, key: list[str], arrival: str, delay: str) -> DataFrame:
    """Without rows that repeat one of the same key that arrived up to ``delay`` before; the state is bounded by it.

    ``arrival`` is when a row came, not what it tells of: so no row is ever too late for it, and a first arrival of
    something old stays. Repeats after the delay go through; the store, which keeps first arrivals, is their judge.
    """
    return rows.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(key)
