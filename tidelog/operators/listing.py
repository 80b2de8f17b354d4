"""Filtered, ordered and paged listings, and the read queries as data over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import path_key, public_name, saturated_int
from tidelog.operators.mapping import any_of, current_version, given, is_active

DEFAULT_PAGE, LARGEST_PAGE, LARGEST_OFFSET = 20, 100, 10_000
NUMBERED_PAGE, LARGEST_NUMBERED_PAGE = 50, 500


def clamp_page(first: int | None, offset: int | None) -> tuple[int, int]:
    """(limit, offset) within bounds: 20 by default, 0 to 100, and an offset of 0 to 10 000."""
    limit = DEFAULT_PAGE if first is None else min(max(first, 0), LARGEST_PAGE)
    return limit, min(max(offset or 0, 0), LARGEST_OFFSET)


def numbered_page(page: int | None, size: int | None) -> tuple[int, int]:
    """(limit, offset) of a page by number: 50 rows by default, 500 at most."""
    size = NUMBERED_PAGE if not size or size < 0 else min(size, LARGEST_NUMBERED_PAGE)
    return size, max(page or 0, 0) * size


def by_slot(key: str = "pubkey") -> list[Column]:
    return [F.desc("slot"), F.asc(key)]


def by_event_time(column: str) -> list[Column]:
    return [F.desc(column), F.asc("id")]


def by_action() -> list[Column]:
    return [F.desc("slot"), F.asc("tx_signature"), path_key(F.col("instruction_index")).asc(), F.asc("id")]


def by_instruction() -> list[Column]:
    return [F.desc("slot"), F.asc("signature"), F.asc("ix_index"), F.asc("inner_index")]


def list_rows(rows: DataFrame, filters: list[Column | None], order: list[Column], first: int | None = None, offset: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(page, total): the page is one top-k, the total one count, both under the same pushed-down filters."""
    for f in filters:
        rows = rows if f is None else rows.where(f)
    limit, skip = clamp_page(first, offset)
    return rows.orderBy(*order).offset(skip).limit(limit), rows.agg(saturated_int(F.count("*")).alias("total_count"))


def top_one(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The singleton of a config table: its newest row."""
    return rows.orderBy(*order).limit(1)


@dataclass(frozen=True)
class Listing:
    """A read query: the table or view, what may be filtered by equality, and its order."""

    table: str
    filters: tuple[str, ...]
    order: str = "slot"
    single: bool = False


#: the read queries by name; ``active`` can be asked of every table with soft deletes
LISTINGS = {
    "admins": Listing("admins_view", (), "added"),
    "role_assignments": Listing("role_assignments_view", ("user_pubkey", "role", "permission"), "assigned"),
    "whitelist_actions": Listing("whitelist_actions", ("subject", "actor", "type", "tx_signature"), "action"),
    "program_instructions": Listing("program_instructions", ("program_id", "ix_name", "signature"), "instruction"),
    "marketplace_config": Listing("marketplace_config", (), single=True),
    "listings": Listing("marketplace_listing", ("listing_id", "developer", "status")),
    "investor_positions": Listing("marketplace_investor_position", ("listing_id", "investor", "cancelled")),
    "lawyers": Listing("marketplace_lawyer", ("lawyer",)),
    "lawyer_candidacies": Listing("marketplace_lawyer_candidacy", ("listing_id", "lawyer")),
    "lawyer_votes": Listing("marketplace_lawyer_vote", ("listing_id", "voter")),
    "property_assets": Listing("marketplace_property_asset", ("asset_id", "region_id")),
    "reservations": Listing("marketplace_reservation", ("token_account",)),
    "share_holdings": Listing("marketplace_share_holding", ("asset_id", "owner")),
    "property_config": Listing("property_config", (), single=True),
    "agent_candidacies": Listing("property_agent_candidacy", ("asset_id", "agent")),
    "agent_votes": Listing("property_agent_vote", ("asset_id", "voter")),
    "letting_agents": Listing("property_letting_agent", ("wallet", "region_id")),
    "property_lettings": Listing("property_letting", ("asset_id", "agent")),
    "resignation_notices": Listing("property_resignation_notice", ("asset_id", "agent")),
    "regions_config": Listing("regions_config", (), single=True),
    "regions": Listing("regions_region", ("region_id", "owner")),
    "locations": Listing("regions_location", ("region_id",)),
    "region_proposals": Listing("regions_region_proposal", ("region_id", "proposal_id", "proposer")),
    "region_states": Listing("regions_region_state", ("region_id", "status")),
    "vote_records": Listing("regions_vote_record", ("proposal_id", "voter")),
}
_ORDERS = {"slot": by_slot, "added": lambda: by_event_time("added_at_slot"), "assigned": lambda: by_event_time("assigned_at_slot"), "action": by_action, "instruction": by_instruction}


def query(name: str, rows: DataFrame, first: int | None = None, offset: int | None = None, active: bool | None = None, **filters: object) -> tuple[DataFrame, DataFrame]:
    """(page, total) of a named read query over its table's rows."""
    spec = LISTINGS[name]
    if unknown := set(filters) - set(spec.filters):
        raise ValueError(f"{name} has no filter {sorted(unknown)}")
    if spec.single:
        page = top_one(rows, by_slot())
        return page, page.agg(F.count("*").cast("int").alias("total_count"))
    on = is_active(active) if "closed_at_slot" in rows.columns else given(active=active)
    return list_rows(rows, [given(**filters), on], _ORDERS[spec.order](), first, offset)


def query_numbered(name: str, rows: DataFrame, page: int | None = None, size: int | None = None, active: bool | None = None, **filters: object) -> DataFrame:
    """The older form of a read query: pages by number, and of a versioned table only current rows."""
    spec = LISTINGS[name]
    rows = current_version(rows)
    on = is_active(active) if "closed_at_slot" in rows.columns else given(active=active)
    for f in (given(**filters), on):
        rows = rows if f is None else rows.where(f)
    limit, skip = numbered_page(page, size)
    return rows.orderBy(*_ORDERS[spec.order]()).offset(skip).limit(limit)


def required(**arguments: str | None) -> None:
    """Point queries refuse empty arguments."""
    if empty := [k for k, v in arguments.items() if not v]:
        raise ValueError(f"missing argument: {', '.join(sorted(empty))}")


def public(rows: DataFrame) -> DataFrame:
    """Rows under their public field names."""
    return rows.toDF(*[public_name(c) for c in rows.columns])


# --- point queries and status -------------------------------------------------------------------


def role_assignment(assignments: DataFrame, user: str, role: str) -> DataFrame:
    """One assignment, active or not; the filter is on the fold's key, so it goes below the aggregation."""
    required(user=user, role=role)
    return assignments.where((F.col("user_pubkey") == user) & (F.col("role") == role))


def check_access(assignments: DataFrame, user: str, role: str) -> DataFrame:
    """One row: has_role if active, compliant if active and COMPLIANT; both false if never assigned."""
    found = role_assignment(assignments, user, role)
    return found.agg(F.coalesce(F.bool_or("active"), F.lit(False)).alias("has_role"), F.coalesce(F.bool_or(F.col("active") & (F.col("permission") == "COMPLIANT")), F.lit(False)).alias("compliant"))


def config_view(folded: DataFrame) -> DataFrame:
    """The config with its last action; a config without any action is an error."""
    bad = F.raise_error(F.lit("config has no action"))
    return folded.withColumn("updated_at_slot", F.when(F.col("updated_at_slot").isNull(), bad).otherwise(F.col("updated_at_slot")))


def of_programs(sync: DataFrame, program_ids: list | None) -> DataFrame:
    """The rows of the configured programs; all of them if none are given."""
    return sync if program_ids is None else sync.where(any_of("program_id", program_ids))


def sync_status(sync: DataFrame, tip: int, program_ids: list | None = None) -> DataFrame:
    """The status of the fleet, or of some of its programs, in one row; an error if there is no program at all."""
    none = F.raise_error(F.lit("no sync state"))
    return of_programs(sync, program_ids).agg(
        F.when(F.count("*") == 0, none).otherwise(F.min("last_contiguous_slot")).alias("last_contiguous_slot"),
        F.bool_and("backfill_complete").alias("backfill_complete"),
        F.when(F.count("*") == F.count("snapshot_slot"), F.min("snapshot_slot")).alias("snapshot_slot"),
        F.lit(tip).cast("long").alias("chain_tip_slot"),
        F.greatest(F.lit(tip) - F.greatest(F.min("last_contiguous_slot"), F.lit(0)), F.lit(0)).cast("long").alias("slot_lag"),
    )


def sync_programs(sync: DataFrame, programs: DataFrame, program_ids: list | None = None) -> DataFrame:
    """The status' row of each program by its name; a row of an unknown program is an error.

    ``programs``: program_id and program, a handful of rows.
    """
    rows = of_programs(sync, program_ids).join(F.broadcast(programs.select("program_id", "program")), "program_id", "left")
    name = F.coalesce("program", F.raise_error(F.concat(F.lit("sync state of an unknown program: "), F.col("program_id").cast("string"))))
    return rows.select(name.alias("program"), "last_contiguous_slot", "backfill_complete", "backfill_floor_slot", "snapshot_slot")


def health(sync: DataFrame, tip: int | None) -> DataFrame:
    """Like the status, but an empty table gives NULLs and false."""
    low = F.min("last_contiguous_slot")
    lag = F.lit(tip).cast("long") - low
    return sync.agg(low.alias("last_contiguous_slot"), F.coalesce(F.bool_and("backfill_complete"), F.lit(False)).alias("backfill_complete"), F.lit(tip).cast("long").alias("chain_tip_slot"), F.when(lag.isNotNull(), F.greatest(lag, F.lit(0))).cast("long").alias("slot_lag"))


def metadata_row(pairs: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """A key and value table as one wide row; values that don't parse are NULL."""
    return pairs.agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).try_cast(t).alias(k) for k, t in kinds.items()])


def height_status(pairs: DataFrame) -> DataFrame:
    """Height reached and lag behind the chain's head, from the metadata."""
    row = metadata_row(pairs, {"lastProcessedHeight": "long", "targetHeight": "long"})
    return row.select(F.col("lastProcessedHeight").alias("last_height"), F.col("targetHeight").alias("head_height"), F.greatest(F.col("targetHeight") - F.col("lastProcessedHeight"), F.lit(0)).alias("lag"))
