"""The canonical order of events and comparisons in it.

Events are ordered by (slot, block_time, tx_signature, path as integers), everywhere the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import path_key


def event_order(prefix: str = "") -> Column:
    """The canonical position of an event as one comparable struct."""
    c = lambda n: F.col(f"{prefix}{n}")
    return F.struct(c("slot").alias("slot"), c("block_time").alias("block_time"), c("tx_signature").alias("tx_signature"), path_key(c("instruction_index")).alias("path"))


def latest_per_key(events: DataFrame, key: list[str], order: Column | None = None) -> DataFrame:
    """The last row of each key in canonical order, by one aggregation with partial results.

    Rows that tie in the whole order are told apart by their id, if they have one.
    """
    order = event_order() if order is None else order
    if "id" in events.columns and "id" not in key:
        order = F.struct(order.alias("o"), F.col("id"))
    rest = [c for c in events.columns if c not in key]
    row = events.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return row.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def events_after(base: DataFrame, events: DataFrame, key: list[str]) -> DataFrame:
    """Each base event with the events of its key that come strictly after it."""
    a = base.select(*key, event_order().alias("base_order"), F.col("id").alias("base_id"))
    b = events.withColumn("event_order", event_order())
    return b.join(a, key).where("event_order > base_order").drop("event_order", "base_order")
