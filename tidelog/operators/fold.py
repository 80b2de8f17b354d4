"""Folds of an action log into current views, in any order of arrival.

Each fold is one aggregation by key: per-type maxima in canonical order, from which the view follows.
Maxima are associative and commutative, so partial results combine before the shuffle, replays do no
harm, and the same code serves batch and streaming aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.core.enums import ROLE
from tidelog.core.order import event_order
from tidelog.functions.columns import indexed

ROLE_TYPES = ("ROLE_ASSIGNED", "ROLE_REMOVED", "ROLE_RENOUNCED", "PERMISSION_UPDATED")
ADMIN_TYPES = ("ADMIN_ADDED", "ADMIN_REMOVED")
CONFIG_TYPES = ("CONFIG_INITIALIZED", "AUTHORITY_UPDATE_PROPOSED", "AUTHORITY_UPDATED")


def _last(name: str, types: tuple[str, ...], *carry: str) -> Column:
    """The last event of the given types: its position, then what it carries."""
    return F.max(F.when(F.col("type").isin(*types), F.struct(F.col("_o").alias("o"), *[F.col(c) for c in carry]))).alias(name)


def _after(event: str, base: str) -> Column:
    return F.when(F.col(f"{event}.o") > F.col(f"{base}.o"), F.col(event))


def admin_state(actions: DataFrame) -> DataFrame:
    """The aggregation below ``admins_fold``: streams as it is."""
    events = actions.where(F.col("type").isin(*ADMIN_TYPES) & F.col("subject").isNotNull())
    return events.withColumn("_o", event_order()).groupBy("subject").agg(_last("a", ("ADMIN_ADDED",), "actor"), _last("r", ("ADMIN_REMOVED",)))


def admins_of(state: DataFrame) -> DataFrame:
    s = state.where(F.col("a").isNotNull()).withColumn("rm", _after("r", "a"))
    return s.select(
        F.col("subject").alias("id"), F.col("rm").isNull().alias("active"), F.col("a.actor").alias("added_by"),
        F.col("a.o.slot").alias("added_at_slot"), F.col("a.o.block_time").alias("added_at"), F.col("a.o.tx_signature").alias("added_in_tx"),
        F.col("rm.o.slot").alias("removed_at_slot"), F.col("rm.o.block_time").alias("removed_at"), F.col("rm.o.tx_signature").alias("removed_in_tx"),
    )


def admins_fold(actions: DataFrame) -> DataFrame:
    """One row per subject ever added: the latest add wins, and a removal counts only after it."""
    return admins_of(admin_state(actions))


def role_state(actions: DataFrame) -> DataFrame:
    """The aggregation below ``role_assignments_fold``: streams as it is."""
    events = actions.where(F.col("type").isin(*ROLE_TYPES) & F.col("subject").isNotNull() & F.col("role").isNotNull())
    return events.withColumn("_o", event_order()).groupBy("subject", "role").agg(
        _last("a", ("ROLE_ASSIGNED",), "actor"), _last("p", ("PERMISSION_UPDATED",), "permission"), _last("r", ("ROLE_REMOVED", "ROLE_RENOUNCED"), "type", "actor")
    )


def role_assignments_of(state: DataFrame) -> DataFrame:
    s = state.where(F.col("a").isNotNull()).withColumn("pm", _after("p", "a")).withColumn("rm", _after("r", "a"))
    last = F.greatest("a.o", "pm.o", "rm.o")
    kind = F.when(F.col("rm.type") == "ROLE_REMOVED", "REMOVED").when(F.col("rm.type") == "ROLE_RENOUNCED", "RENOUNCED")
    return s.select(
        F.concat("subject", F.lit("-"), indexed(F.col("role"), ROLE).cast("string")).alias("id"), F.col("subject").alias("user_pubkey"), "role",
        F.col("rm").isNull().alias("active"), F.coalesce("pm.permission", F.lit("COMPLIANT")).alias("permission"),
        F.col("a.actor").alias("rent_payer"), F.col("a.actor").alias("assigned_by"),
        F.col("a.o.slot").alias("assigned_at_slot"), F.col("a.o.block_time").alias("assigned_at"), F.col("a.o.tx_signature").alias("assigned_in_tx"),
        last["slot"].alias("updated_at_slot"), last["block_time"].alias("updated_at"),
        F.col("rm.o.slot").alias("removed_at_slot"), F.col("rm.o.block_time").alias("removed_at"), F.col("rm.o.tx_signature").alias("removed_in_tx"),
        F.col("rm.actor").alias("removed_by"), kind.alias("removal_kind"),
    )


def role_assignments_fold(actions: DataFrame) -> DataFrame:
    """One row per (subject, role) ever assigned, with its last permission and removal after that."""
    return role_assignments_of(role_state(actions))


def latest_activity(candidates: DataFrame, key: list[str]) -> DataFrame:
    """Slot and time of the latest of several candidate events of a key."""
    return candidates.groupBy(*key).agg(F.max(event_order()).alias("o")).select(*key, F.col("o.slot").alias("updated_at_slot"), F.col("o.block_time").alias("updated_at"))


def config_fold(config: DataFrame, actions: DataFrame) -> DataFrame:
    """The config row with the latest config action, if any; not filtered on closed rows.

    Both sides have one row, so the broadcast is of one row.
    """
    last = actions.where(F.col("type").isin(*CONFIG_TYPES)).agg(F.max(event_order()).alias("o"))
    one = config.select("authority", "pending_authority").limit(1)
    return one.crossJoin(F.broadcast(last)).select("authority", "pending_authority", F.col("o.slot").alias("updated_at_slot"), F.col("o.block_time").alias("updated_at"), F.col("o.tx_signature").alias("updated_in_tx"))


def fold_violations(actions: DataFrame) -> DataFrame:
    """Events that an in-order fold would refuse: removals and updates of what was never there before.

    (id, violation), by the first add of the key against the event's own position.
    """
    e = actions.withColumn("_o", event_order()).where("subject is not null")
    unknown = actions.where(F.col("role").isNotNull() & ~F.col("role").isin(*ROLE)).select("id", F.lit("unknown_role").alias("violation"))

    def orphans(types: tuple[str, ...], start: str, key: list[str], name: str) -> DataFrame:
        first = e.where(F.col("type") == start).groupBy(*key).agg(F.min("_o").alias("_first"))
        late = e.where(F.col("type").isin(*types)).join(first, key, "left").where(F.col("_first").isNull() | (F.col("_first") > F.col("_o")))
        return late.select("id", F.lit(name).alias("violation"))

    config = e.where(F.col("type") == "CONFIG_INITIALIZED").agg(F.min("_o").alias("_first"))
    changes = e.where(F.col("type").isin("AUTHORITY_UPDATE_PROPOSED", "AUTHORITY_UPDATED")).crossJoin(F.broadcast(config)).where(F.col("_first").isNull() | (F.col("_first") > F.col("_o")))
    return (
        orphans(("ADMIN_REMOVED",), "ADMIN_ADDED", ["subject"], "admin_not_added")
        .unionByName(orphans(("ROLE_REMOVED", "ROLE_RENOUNCED", "PERMISSION_UPDATED"), "ROLE_ASSIGNED", ["subject", "role"], "role_not_assigned"))
        .unionByName(changes.select("id", F.lit("no_config").alias("violation")))
        .unionByName(unknown)
    )
