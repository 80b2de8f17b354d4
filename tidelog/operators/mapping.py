"""From the change feed to history rows, actions, closes and typed state rows; rules are data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.core import enums
from tidelog.functions.columns import account_at, dotted, lower_hex, path_indexes, spelled
from tidelog.operators.payloads import judged_documents
from tidelog.operators.validate import instruction_reason, split_rejects, with_first_bad

SYNTHETIC = "cpi_event"


def succeeded(transactions: DataFrame) -> DataFrame:
    """Without failed transactions and votes."""
    return transactions.where(~F.col("failed") & ~F.col("vote"))


def touching(transactions: DataFrame, program_ids: list[bytes]) -> DataFrame:
    """Transactions with an instruction of any of the programs."""
    wanted = F.array(*[F.lit(bytes(p)) for p in program_ids])
    return transactions.where(F.exists("instructions", lambda x: F.array_contains(wanted, x["program_id"])))


def owned_by(accounts: DataFrame, programs: DataFrame) -> DataFrame:
    """Account rows whose owner is one of the programs (a handful of rows, so a broadcast)."""
    return accounts.join(F.broadcast(programs.select(F.col("program_id").alias("owner"))), "owner", "left_semi").select(*accounts.columns)


def instructions(transactions: DataFrame, programs: DataFrame | None = None) -> DataFrame:
    """One row an instruction, with its path; of the configured programs only, without synthetic rows.

    Arguments that come as a struct become their JSON document.
    """
    rows = transactions.select(*[c for c in transactions.columns if c in ("slot", "signature", "block_time")], F.explode("instructions").alias("i"))
    rows = rows.select(*[c for c in rows.columns if c != "i"], "i.*").where(F.col("ix_name") != SYNTHETIC)
    if isinstance(rows.schema["args"].dataType, T.StructType):
        rows = rows.withColumn("args", F.to_json("args", {"ignoreNullFields": "false"}))
    if programs is not None:
        rows = rows.join(F.broadcast(programs.select("program_id")), "program_id", "left_semi")
    return rows


def history_rows(rows: DataFrame) -> DataFrame:
    """The event history's columns; the path collapses to two indexes."""
    outer, inner = path_indexes(F.col("path"))
    return rows.select("program_id", "signature", outer.alias("ix_index"), inner.alias("inner_index"), "slot", "block_time", "ix_name", "accounts", F.coalesce("args", F.lit("{}")).alias("data"))


def with_block_time(rows: DataFrame, times: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a time, rows rejected): a hint wins, else the slot's known time; it is never invented.

    Where the times have an ``origin``, rows get ``time_origin``: that, or ``hint``; NULL where there is no time.
    """
    traced = "origin" in times.columns
    value = F.struct("block_time", "origin") if traced else F.struct("block_time")
    known = times.groupBy("slot").agg(F.max(value).alias("_known"))
    rows = rows.join(known, "slot", "left")
    if traced:
        rows = rows.withColumn("time_origin", F.when(F.col("block_time").isNotNull(), F.lit("hint")).otherwise(F.col("_known.origin")))
    rows = rows.withColumn("block_time", F.coalesce("block_time", "_known.block_time")).drop("_known")
    return split_rejects(rows, F.when(F.col("block_time").isNull(), F.lit("no_block_time")))


def actions(rows: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(action rows, rejected rows) by the action rules, which are a few rows and broadcast.

    Role and permission arguments are enum indexes or spellings in the args document.
    """
    joined = rows.join(F.broadcast(rules), ["program_id", "ix_name"])
    needed = F.greatest("actor_pos", F.coalesce("subject_pos", F.lit(0)))
    good, bad = split_rejects(joined, instruction_reason(F.col("path"), F.col("accounts"), needed, F.col("args")))
    args = F.col("args")

    def enum_arg(name: str, spellings: tuple[str, ...]) -> Column:
        raw = F.get_json_object(args, f"$.{name}")
        return F.coalesce(spelled(raw.try_cast("int"), spellings), raw)

    subject = F.coalesce(lower_hex(account_at(F.col("accounts"), F.col("subject_pos"))), _argument(args))
    signature = lower_hex(F.col("signature"))
    path = dotted(F.col("path"))
    out = good.select(
        F.concat_ws("-", signature, path).alias("id"), "type", subject.alias("subject"),
        F.when(F.col("with_role"), enum_arg("role", enums.ROLE)).alias("role"),
        F.when(F.col("with_permission"), enum_arg("permission", enums.ACCESS_PERMISSION)).alias("permission"),
        lower_hex(account_at(F.col("accounts"), F.col("actor_pos"))).alias("actor"), "slot", "block_time", signature.alias("tx_signature"), path.alias("instruction_index"),
    )
    return out, bad


def _argument(args: Column) -> Column:
    """The argument that names the subject, where a rule has one."""
    found = F.from_json(args, "map<string,string>")
    return F.when(F.col("subject_arg").isNotNull(), F.try_element_at(found, F.col("subject_arg")))


def closes(rows: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(close rows, rejected rows) by the close rules: table, key, slot, and for conditional ones the removed item."""
    joined = rows.join(F.broadcast(rules), ["program_id", "ix_name"])
    good, bad = split_rejects(joined, instruction_reason(F.col("path"), F.col("accounts"), F.col("pos"), F.col("args")))
    item = F.when(F.col("conditional"), F.get_json_object("args", "$.postcode"))
    return good.select("table", account_at(F.col("accounts"), F.col("pos")).alias("pubkey"), "slot", item.alias("postcode")), bad


@dataclass(frozen=True)
class Mapped:
    """What a batch of transactions comes to."""

    history: DataFrame
    actions: DataFrame
    closes: DataFrame
    rejected: DataFrame


def rule_positions(action_rules: DataFrame, close_rules: DataFrame) -> DataFrame:
    """The highest account position that any rule of an instruction uses; as many rows as rules at most."""
    acts = action_rules.select("program_id", "ix_name", F.greatest("actor_pos", F.coalesce("subject_pos", F.lit(0))).alias("pos"))
    return acts.unionByName(close_rules.select("program_id", "ix_name", "pos")).groupBy("program_id", "ix_name").agg(F.max("pos").alias("_needed"))


def judged_instructions(transactions: DataFrame, programs: DataFrame, action_rules: DataFrame, close_rules: DataFrame, times: DataFrame) -> DataFrame:
    """Each instruction with the reason why it can't be mapped, if any, its place ``_at``, and the place ``_bad``
    of its transaction's first bad one."""
    rows = instructions(succeeded(transactions), programs)
    known = times.groupBy("slot").agg(F.max("block_time").alias("_known"))
    rows = rows.join(known, "slot", "left").withColumn("block_time", F.timestamp_seconds(F.coalesce("block_time", "_known"))).drop("_known")
    rows = rows.join(F.broadcast(rule_positions(action_rules, close_rules)), ["program_id", "ix_name"], "left")
    untimed = F.when(F.col("block_time").isNull(), F.lit("no_block_time"))
    rows = rows.withColumn("reason", F.coalesce(untimed, instruction_reason(F.col("path"), F.col("accounts"), F.coalesce("_needed", F.lit(-1)), F.col("args")))).drop("_needed")
    return with_first_bad(rows, ["signature"], F.coalesce("path", F.array().cast("array<int>")))


def mapped(judged: DataFrame, action_rules: DataFrame, close_rules: DataFrame) -> Mapped:
    """What judged instructions come to: the first bad one of a transaction is rejected, what comes after it is left out."""
    good = judged.where("_bad is null or _at < _bad").drop("_at", "_bad", "reason")
    bad = judged.where("_at = _bad and reason is not null")
    rejected = bad.select("program_id", "signature", F.coalesce(dotted(F.col("path")), F.lit("")).alias("instruction_index"), "ix_name", "slot", "reason")
    return Mapped(history_rows(good), actions(good, action_rules)[0], closes(good, close_rules)[0], rejected)


def map_transactions(transactions: DataFrame, programs: DataFrame, action_rules: DataFrame, close_rules: DataFrame, times: DataFrame) -> Mapped:
    """History, actions, closes and rejects of a batch of transactions, as they are to be committed together."""
    return mapped(judged_instructions(transactions, programs, action_rules, close_rules, times), action_rules, close_rules)


def classify(payloads: DataFrame, kinds: DataFrame, data: str = "data", header: int = 8) -> tuple[DataFrame, DataFrame]:
    """(payloads with their kind, unknown ones) by program and leading bytes; kinds are a small rule table."""
    tagged = payloads.withColumn("header", F.substring(data, 1, header)).join(F.broadcast(kinds), ["program_id", "header"], "left")
    return tagged.where("kind is not null"), tagged.where("kind is null").withColumn("reason", F.lit("undecodable"))


def state_rows(updates: DataFrame, table: str) -> DataFrame:
    """Account updates of one kind as typed rows of its table, from their JSON payload; for batch and stream.

    Payloads that can't be decoded give no row; see ``payloads.judged_documents`` for why.
    """
    return judged_documents(updates, table).where("reason is null").drop("reason")


# --- predicates of the read queries -------------------------------------------------------------


def given(**values: object) -> Column | None:
    """AND of equalities for the arguments that are given; absent ones put nothing into the plan."""
    parts = [F.col(c) == F.lit(v) for c, v in values.items() if v is not None]
    return reduce(and_, parts) if parts else None


def is_active(active: bool | None) -> Column | None:
    """The open-row filter, only if asked for: soft-deleted rows stay visible otherwise."""
    return None if active is None else F.col("closed_at_slot").isNull() == F.lit(active)


def any_of(column: str, values: list) -> Column:
    return reduce(or_, [F.col(column) == F.lit(v) for v in values]) if values else F.lit(False)


def current_version(rows: DataFrame, upper: str = "valid_to") -> DataFrame:
    """Rows of a version-ranged table whose range is open above; other tables as they are."""
    return rows.where(F.col(upper).isNull()) if upper in rows.columns else rows
