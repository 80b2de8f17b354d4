"""Validation and quarantine: bad rows leave with a reason, good rows go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASONS = ("missing_account", "empty_absolute_path", "serialize")


def split_rejects(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with ``reason``): the reason is NULL for good rows."""
    tagged = rows.withColumn("reason", reason)
    return tagged.where("reason is null").drop("reason"), tagged.where("reason is not null")


def instruction_reason(path: Column, accounts: Column, needed: Column, args: Column) -> Column:
    """Why an instruction can't be mapped, or NULL; ``needed`` is the highest account position used.

    A NULL path is as bad as an empty one, a NULL account list has no accounts, and NULL arguments are no arguments.
    """
    return (
        F.when(F.coalesce(F.size(path), F.lit(0)) <= 0, F.lit("empty_absolute_path"))
        .when(F.greatest(F.coalesce(F.size(accounts), F.lit(0)), F.lit(0)) <= needed, F.lit("missing_account"))
        .when(args.isNotNull() & F.try_parse_json(args).isNull(), F.lit("serialize"))
    )


def rejected_counts(rejected: DataFrame, programs: DataFrame, reasons: tuple[str, ...] = REASONS) -> DataFrame:
    """Counts by (program, reason), with zeros; programs and reasons are a handful each."""
    all_pairs = programs.select("program").crossJoin(programs.sparkSession.createDataFrame([(r,) for r in reasons], "reason string"))
    counted = rejected.groupBy("program", "reason").agg(F.count("*").alias("n"))
    return all_pairs.join(counted, ["program", "reason"], "left").select("program", "reason", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def before_first_bad(rows: DataFrame, transaction: list[str], position: Column | str, reason: str = "reason") -> DataFrame:
    """The rows of each transaction before its first bad one; one exchange by transaction, no join."""
    return with_first_bad(rows, transaction, position, reason).where("_bad is null or _at < _bad").drop("_at", "_bad")


def with_first_bad(rows: DataFrame, transaction: list[str], position: Column | str, reason: str = "reason") -> DataFrame:
    """The rows with their position ``_at`` and that of their transaction's first bad row, ``_bad``."""
    at = F.col(position) if isinstance(position, str) else position
    bad = F.min(F.when(F.col(reason).isNotNull(), F.col("_at"))).over(Window.partitionBy(*transaction))
    return rows.withColumn("_at", at).withColumn("_bad", bad)


def check_constraints(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): NULL doesn't violate a rule, as in SQL's CHECK. One pass for all rules."""
    counts = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(True))).alias(n) for n, c in rules.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {pairs}) as (rule, violations)"))


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
