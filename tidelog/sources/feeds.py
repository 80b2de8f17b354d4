"""Sources of the change feed: live stream, bounded history, snapshot, slot times, metric samples.

All give the same normalized schemas, so one set of transformations serves batch and stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.core.schemas import table_schema


def read_changes(spark: SparkSession, path: str, table: str, format: str = "parquet", files_per_trigger: int | None = 100, glob: str | None = None) -> DataFrame:
    """The live feed of one kind of change, from a folder of files; the schema is given, never inferred."""
    r = spark.readStream.schema(table_schema(table)).format(format)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_changes_kafka(spark: SparkSession, servers: str, topic: str, table: str, offsets_per_trigger: int | None = None) -> DataFrame:
    """The live feed as JSON messages of a topic (needs Spark's Kafka package on the class path)."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return r.load().select(F.from_json(F.col("value").cast("string"), table_schema(table)).alias("v")).select("v.*")


def read_history(changes: DataFrame, low: int, high: int, program_id: bytes | None = None) -> DataFrame:
    """A bounded range of the feed, newest first in meaning: both bounds reach the scan as filters."""
    out = changes.where(F.col("slot").between(low, high))
    return out if program_id is None else out.where(F.col("program_id") == F.lit(bytes(program_id)))


def read_snapshot(rows: DataFrame, snapshot_slot: int) -> DataFrame:
    """Full current rows with the slot that was taken before the read."""
    return rows.withColumn("slot", F.lit(snapshot_slot).cast("long"))


def slot_times(transactions: DataFrame) -> DataFrame:
    """The known time of each slot, from the feed's own hints."""
    return transactions.where("block_time is not null").groupBy("slot").agg(F.max("block_time").alias("block_time"))


def time_dimension(transactions: DataFrame, looked_up: DataFrame) -> DataFrame:
    """(slot, block_time, origin): a slot's time from the feed's own hints (``cached``), else the one that was looked up
    (``looked_up``: slot, block_time). A slot that neither knows has no row."""
    rank = F.when(F.col("origin") == "cached", 1).otherwise(0)
    known = slot_times(transactions).withColumn("origin", F.lit("cached")).unionByName(slot_times(looked_up).withColumn("origin", F.lit("looked_up")))
    best = F.max_by(F.struct("block_time", "origin"), rank).alias("t")
    return known.groupBy("slot").agg(best).select("slot", "t.block_time", "t.origin")


def _labels(labels: list[str], *more: Column) -> Column:
    return F.create_map(*[x for c in labels for x in (F.lit(c), F.col(c).cast("string"))], *more)


def _samples(rows: DataFrame, metric: Column | str, ts: str, labels: Column, value: Column) -> DataFrame:
    metric = F.lit(metric) if isinstance(metric, str) else metric
    return rows.select(F.col(ts).cast("timestamp").alias("ts"), metric.alias("metric"), labels.alias("labels"), value.cast("double").alias("value"))


def counter_samples(events: DataFrame, metric: str, ts: str, labels: list[str]) -> DataFrame:
    """Events as counter steps: (ts, metric, labels, value) with value 1."""
    return _samples(events, metric, ts, _labels(labels), F.lit(1.0))


def gauge_samples(rows: DataFrame, metric: str, ts: str, value: str, labels: list[str]) -> DataFrame:
    """Readings as they are."""
    return _samples(rows, metric, ts, _labels(labels), F.col(value))


def bucket_samples(observations: DataFrame, metric: str, ts: str, value: str, labels: list[str], bounds: list[float]) -> DataFrame:
    """Observations as steps of a histogram's series: a bucket for each bound that holds it and for infinity, the sum and the count."""
    none = F.lit(None).cast("string")
    bucket = [F.when(F.col(value) <= b, F.struct(F.lit(f"{metric}_bucket").alias("metric"), F.lit(f"{b:g}").alias("le"), F.lit(1.0).alias("step"))) for b in bounds]
    rest = [("_bucket", F.lit("+Inf"), F.lit(1.0)), ("_sum", none, F.col(value).cast("double")), ("_count", none, F.lit(1.0))]
    steps = F.array_compact(F.array(*bucket, *[F.struct(F.lit(metric + m).alias("metric"), le.alias("le"), v.alias("step")) for m, le, v in rest]))
    rows = observations.where(F.col(value).isNotNull()).withColumn("_s", F.explode(steps))
    own = F.when(F.col("_s.le").isNull(), _labels(labels)).otherwise(_labels(labels, F.lit("le"), F.col("_s.le")))
    return _samples(rows, F.col("_s.metric"), ts, own, F.col("_s.step"))
