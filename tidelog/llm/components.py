"""Connected components of a link table, as windows over links dealt out by node (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import _text as t


def _least(links: DataFrame) -> DataFrame:
    """The distinct links (u, v, moved), once dealt out by u, with the smallest v of each u as m."""
    dealt = links.repartition("u").groupBy("u", "v").agg(F.bool_or("moved").alias("moved"))
    return dealt.withColumn("m", F.min("v").over(Window.partitionBy("u")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) links; a component's name is its smallest node.

    Each round points all larger neighbours of a node, then all its smaller ones, to the smallest of
    them, which ends in stars after about log(n) rounds. A link becomes one link, so none are added; a
    round deals the links out twice, is cut by a reliable checkpoint, and the driver sees only whether a
    link moved in it. Loops and repeated links don't matter.
    """
    now = t.checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    moved = True
    while moved:
        both = now.select("u", "v", F.lit(False).alias("moved"))
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"), "moved"))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"), (F.col("m") < F.col("u")).alias("moved"))
        apart = F.col("v") != F.col("m")
        small = _least(large).select(F.when(apart, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), (F.col("moved") | apart).alias("moved"))
        now = t.checkpoint(small)
        moved = not now.where("moved").isEmpty()
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
