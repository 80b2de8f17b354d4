"""Window queries over metric samples: rates, changes, quantiles, alert conditions.

Samples are (ts, metric, series, value), where ``series`` stands for the labels. Windows are fixed;
nothing is extrapolated to their edges, so an increase is the sum of the steps that end in the window.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: seconds of a series' time that one task orders
SPAN = 86_400


def with_previous(samples: DataFrame, series: list[str], column: str = "value", name: str = "before") -> DataFrame:
    """Each sample with its series' value before it, in order of (ts, value).

    Samples are ordered within spans of a series' time; the last sample of the span before, one small row a
    span, is joined on. So a series of any length is spread over its spans.
    """
    rows = samples.withColumn("_span", _span())
    within = F.lag(F.struct(column)).over(Window.partitionBy(*series, "_span").orderBy("ts", column))
    ends = rows.groupBy(*series, "_span").agg(F.max_by(F.struct(column), F.struct("ts", column)).alias("_end"))
    carried = ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy(*series).orderBy("_span"))).drop("_end")
    rows = join_same(rows.withColumn("_within", within), carried, _same(series), "left")
    return rows.withColumn(name, F.coalesce("_within", "_carry")[column]).drop("_within", "_carry", "_span")


def _span() -> Column:
    return F.floor(F.unix_timestamp("ts") / SPAN)


def _same(series: list[str]) -> list[str]:
    return [*series, "_span"]


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """An equi-join whose keys may be NULL: a series without a label is a series like any other."""
    there = {k: f"_same_{n}" for n, k in enumerate(keys)}
    right = right.select(*[F.col(k).alias(there[k]) for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(v)) for k, v in there.items()])
    return left.join(right, same, how).drop(*there.values())


def as_of(left: DataFrame, right: DataFrame, by: list[str], values: list[str], span: int = SPAN, shares: int = 1, with_equal: bool = True) -> DataFrame:
    """Each row of ``left`` with the ``values`` of the last row of ``right`` before its ``ts`` (or at it); NULLs if there is none.

    Both have ``ts`` and the columns ``by``, which may be NULL; of rows of ``right`` at one time the largest
    values count. Rows meet within spans of seconds; a span's last row of ``right`` is carried to later ones by one small row a
    span. Where ``by`` leaves large groups, ``left`` is dealt into ``shares`` and ``right`` copied to each.
    """
    names = left.columns
    kept = F.struct(*names)
    last = F.struct(F.col("ts").alias("_at"), *values)
    deal = F.pmod(F.xxhash64(*names), F.lit(shares)).cast("int") if shares > 1 else F.lit(0)
    asks = left.select(*by, "ts", deal.alias("_share"), kept.alias("_left"), F.lit(None).cast(_type_of(right, values)).alias("_right"), F.lit(1 if with_equal else -1).alias("_turn"))
    gives = right.select(*by, "ts", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"), F.lit(None).cast(left.select(kept.alias("x")).schema["x"].dataType).alias("_left"), last.alias("_right"), F.lit(0).alias("_turn"))
    rows = asks.unionByName(gives).withColumn("_span", F.floor(F.unix_timestamp("ts") / span))
    own = Window.partitionBy(*by, "_span", "_share").orderBy("ts", "_turn", "_right").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_within", F.last("_right", ignorenulls=True).over(own))
    ends = rows.groupBy(*by, "_span").agg(F.max("_right").alias("_end"))
    earlier = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    out = join_same(rows.where(F.col("_left").isNotNull()), carried, [*by, "_span"], "left")
    found = F.coalesce("_within", "_carry")
    return out.select("_left.*", *[found[v].alias(v) for v in values])


def _type_of(right: DataFrame, values: list[str]):
    return right.select(F.struct(F.col("ts").alias("_at"), *values).alias("x")).schema["x"].dataType


def steps(samples: DataFrame, series: list[str]) -> DataFrame:
    """Each sample with its counter's step since the one before; a fall is a reset, and counts from 0."""
    before = F.col("_before")
    step = F.when(before.isNull(), F.lit(0.0)).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return with_previous(samples, series, name="_before").withColumn("step", step).drop("_before")


def increase(samples: DataFrame, series: list[str], window: str) -> DataFrame:
    """Counter growth of each series by window."""
    return steps(samples, series).groupBy(*series, F.window("ts", window).alias("w")).agg(F.sum("step").alias("increase")).select(*series, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "increase")


def rate(samples: DataFrame, series: list[str], window: str) -> DataFrame:
    """Growth a second."""
    seconds = F.unix_timestamp("end") - F.unix_timestamp("start")
    return increase(samples, series, window).select(*series, "start", "end", (F.col("increase") / seconds).alias("rate"))


def changes(samples: DataFrame, series: list[str], window: str) -> DataFrame:
    """How often a gauge's value changed by window."""
    changed = F.coalesce(F.col("value") != F.col("_before"), F.lit(False))
    rows = with_previous(samples, series, name="_before").withColumn("c", changed.cast("long"))
    out = rows.groupBy(*series, F.window("ts", window).alias("w")).agg(F.sum("c").alias("changes"))
    return out.select(*series, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "changes")


def lag_per_program(frontiers: DataFrame, tips: DataFrame, window: str, shares: int = 1) -> DataFrame:
    """The tip as of each window's end less each program's last frontier in the window; no row before the first tip."""
    w = F.window("ts", window)
    last = frontiers.groupBy("program", w.alias("w")).agg(F.max_by("value", F.struct("ts", "value")).alias("value"))
    rows = last.select("program", F.col("w.start").alias("start"), F.col("w.end").alias("ts"), "value")
    tip = tips.groupBy("ts").agg(F.max("value").alias("tip"))
    out = as_of(rows, tip, [], ["tip"], shares=shares, with_equal=False).where(F.col("tip").isNotNull())
    return out.select("program", "start", (F.col("tip") - F.col("value")).alias("lag"))


def held_for(conditions: DataFrame, series: list[str], seconds: int, flag: str = "on") -> DataFrame:
    """Rows at which the condition has held without interruption for this long.

    Runs are found within spans of a series' time. A run that is open at a span's end goes on in the next
    ones; what it began with is carried over by the spans' summaries, one small row a span.
    """
    on = F.col(flag)
    rows = conditions.withColumn("_span", _span())
    rows = rows.withColumn("_run", F.sum((~on).cast("long")).over(Window.partitionBy(*series, "_span").orderBy("ts")))
    rows = rows.withColumn("_began", F.min(F.when(on, F.col("ts"))).over(Window.partitionBy(*series, "_span", "_run")))
    off = F.max("_run").alias("_off")  # how often the condition failed in the span
    ends = rows.groupBy(*series, "_span").agg(off, F.max_by("_began", F.struct("_run", on.alias("on"))).alias("_open"))
    by_span = Window.partitionBy(*series).orderBy("_span")
    ends = ends.withColumn("_group", F.sum((F.col("_off") > 0).cast("long")).over(by_span))
    ends = ends.withColumn("_out", F.min("_open").over(Window.partitionBy(*series, "_group").orderBy("_span")))
    ends = ends.select(*_same(series), F.lag("_out").over(by_span).alias("_carry"))
    began = F.when(F.col("_run") == 0, F.coalesce("_carry", "_began")).otherwise(F.col("_began"))
    out = join_same(rows, ends, _same(series), "left").withColumn("_held", F.unix_timestamp("ts") - F.unix_timestamp(began))
    return out.where(on & (F.col("_held") >= seconds)).drop("_run", "_began", "_carry", "_span").withColumnRenamed("_held", "held_seconds")


def either(a: DataFrame, b: DataFrame, labels: list[str]) -> DataFrame:
    """``a or b``: all of a, and of b what a has no equal labels for."""
    return a.unionByName(join_same(b, a.select(*labels), labels, "left_anti").select(*a.columns))


def both(a: DataFrame, b: DataFrame, labels: list[str]) -> DataFrame:
    """``a and b``: the rows of a whose labels b has."""
    return join_same(a, b.select(*labels), labels, "left_semi").select(*a.columns)


def bucketize(observations: DataFrame, by: list[str], bounds: list[float]) -> DataFrame:
    """Cumulative histogram counts: observations up to each bound, and all (infinity). One pass."""
    counts = [F.count_if(F.col("value") <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = observations.groupBy(*by).agg(*counts, F.count("value").alias("b_all"))
    pairs = ", ".join([f"{b!r}D, b{i}" for i, b in enumerate(bounds)] + ["double('inf'), b_all"])
    return wide.select(*by, F.expr(f"stack({len(bounds) + 1}, {pairs}) as (le, n)"))


def bucket_increases(samples: DataFrame, series: list[str], by: list[str], window: str) -> DataFrame:
    """Growth of a histogram's cumulative bucket counters by window, resets included, summed over all series: by, start, le, n.

    ``samples`` has the bucket's bound ``le`` beside the series.
    """
    grown = increase(samples, [*series, "le"], window)
    return grown.groupBy(*by, "start", "le").agg(F.sum("increase").alias("n"))


def histogram_quantiles(buckets: DataFrame, by: list[str], qs: tuple[float, ...]) -> DataFrame:
    """The quantiles by linear interpolation within the bucket that holds them: by, q, value.

    ``buckets``: by, le, n cumulative (where n falls, the larger count before holds). In the last bucket the answer is
    its lower bound; without any observation it is NULL. All quantiles come from one sorted array a group, as
    long as there are bounds.
    """
    rows = buckets.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("le", F.col("n").cast("double").alias("n")))).alias("b"))
    most = lambda i: F.array_max(F.transform(F.slice("b", F.lit(1), i), lambda x: x["n"]))

    def bucket(x: Column, i: Column) -> Column:
        before = F.get("b", i - 1)
        return F.struct(x["le"].alias("le"), most(i + 1).alias("n"), F.coalesce(before["le"], F.lit(0.0)).alias("low"), F.when(i > 0, most(i)).otherwise(0.0).alias("below"))

    rows = rows.withColumn("b", F.transform("b", bucket)).withColumn("_total", F.element_at("b", -1)["n"])

    def value(q: float) -> Column:
        rank = F.lit(q) * F.col("_total")
        h = F.get(F.filter("b", lambda x: (x["n"] >= rank) & (x["n"] > x["below"])), F.lit(0))
        inside = h["low"] + (h["le"] - h["low"]) * (rank - h["below"]) / (h["n"] - h["below"])
        return F.when(F.col("_total") != 0, F.when(h["le"] == float("inf"), h["low"]).otherwise(inside))

    each = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), value(q).alias("value")) for q in qs]))
    return rows.select(*by, each.alias("_e")).select(*by, "_e.q", "_e.value")


def histogram_quantile(buckets: DataFrame, by: list[str], q: float) -> DataFrame:
    """One quantile; see ``histogram_quantiles``."""
    return histogram_quantiles(buckets, by, (q,)).drop("q")


def mean_of(sums: DataFrame, counts: DataFrame, series: list[str], window: str) -> DataFrame:
    """Average by window of a histogram's sum and count counters; NULL where nothing was counted."""
    s = increase(sums, series, window).withColumnRenamed("increase", "s")
    c = increase(counts, series, window).withColumnRenamed("increase", "c")
    return join_same(s, c, [*series, "start", "end"], "inner").select(*series, "start", (F.col("s") / F.when(F.col("c") != 0, F.col("c"))).alias("mean"))


def sum_by(rates: DataFrame, labels: list[str], column: str = "rate") -> DataFrame:
    return rates.groupBy(*labels, "start").agg(F.sum(column).alias(column))


def lowest(samples: DataFrame, by: list[str], window: str) -> DataFrame:
    """The least value by window: 0 of ``up`` means down."""
    return samples.groupBy(*by, F.window("ts", window)["start"].alias("start")).agg(F.min("value").alias("lowest"))


def when_above(rows: DataFrame, column: str, threshold: float, alert: str, labels: list[Column]) -> DataFrame:
    """Alert rows (alert, labels..., start) where a window's value is above the threshold."""
    return rows.where(F.col(column) > threshold).select(F.lit(alert).alias("alert"), *labels, "start")


# --- the alerts ----------------------------------------------------------------------------------

LAG_SLOTS, LAG_SECONDS = 3000, 300
DOWN_SECONDS = 120
RECONNECTS = 5
STALLED_SECONDS = 300


def lag_is_high(frontiers: DataFrame, tips: DataFrame) -> DataFrame:
    """(program, ts, on) by minute: what ``slot_lag_high`` judges, in batch and as a stream."""
    return lag_per_program(frontiers, tips, "1 minute").select("program", F.col("start").alias("ts"), (F.col("lag") > LAG_SLOTS).alias("on"))


def slot_lag_high(frontiers: DataFrame, tips: DataFrame) -> DataFrame:
    lag = lag_is_high(frontiers, tips)
    return held_for(lag, ["program"], LAG_SECONDS).select(F.lit("SlotLagHigh").alias("alert"), "program", "ts")


def decode_failures(failed: DataFrame, skipped: DataFrame, series: list[str]) -> DataFrame:
    grown = lambda df: increase(df, series, "10 minutes").where("increase > 0").select(*series, "start")
    return either(grown(failed), grown(skipped), [*series, "start"]).select(F.lit("DecodeFailures").alias("alert"), *series, "start")


def target_down(up: DataFrame, job: str, alert: str) -> DataFrame:
    """A target that has been down for two minutes: FeedDown and ApiDown."""
    on = up.where(F.col("job") == job).select("job", "ts", (F.col("value") == 0).alias("on"))
    return held_for(on, ["job"], DOWN_SECONDS).select(F.lit(alert).alias("alert"), "job", "ts")


def reconnect_storm(reconnects: DataFrame, series: list[str]) -> DataFrame:
    return when_above(increase(reconnects, series, "15 minutes"), "increase", RECONNECTS, "ReconnectStorm", [F.col(s) for s in series])


def backfill_stalled(frontiers: DataFrame, tips: DataFrame, progress: DataFrame) -> DataFrame:
    """No progress while the lag is high, for five minutes; judged every 15 minutes, so in two windows in a row."""
    lag = lag_per_program(frontiers, tips, "15 minutes")
    still = changes(progress, ["program"], "15 minutes").where("changes = 0").select("program", "start", F.lit(True).alias("still"))
    on = (F.col("lag") > LAG_SLOTS) & F.coalesce("still", F.lit(False))
    rows = join_same(lag, still, ["program", "start"], "left").select("program", F.col("start").alias("ts"), on.alias("on"))
    return held_for(rows, ["program"], STALLED_SECONDS).select(F.lit("BackfillStalled").alias("alert"), "program", "ts")
