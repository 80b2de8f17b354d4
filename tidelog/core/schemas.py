"""Schemas of the tables: event history, action log, bookkeeping and the keyed state tables.

State tables share four leading columns; the rest is each table's payload. Types are Spark's; lists
are arrays, nested fixed structs are flattened with a prefix.
"""

from __future__ import annotations

from pyspark.sql import types as T

STATE_COLUMNS = "pubkey binary, slot bigint, lamports bigint, closed_at_slot bigint"

#: payload columns (fixed values)
STATE_PAYLOAD = {
    "config": "authority binary, pending_authority binary, bump smallint",
    "admin": "admin binary, bump smallint",
    "role_account": "user_pubkey binary, role string, permission string, rent_payer binary, bump smallint",
    "regions_config": "authority binary, pending_authority binary, token_mint binary, minimum_voting_amount bigint, voting_period bigint, owner_change_period bigint, threshold_bps int, quorum bigint, notice_period bigint, min_vote_hold bigint, max_listing_duration bigint, max_tax_bps int, location_deposit bigint, proposal_counter bigint, bump smallint",
    "regions_location": "region_id int, postcode binary, deposit bigint, bump smallint",
    "regions_region": "region_id int, owner binary, collateral bigint, location_collateral bigint, next_owner_change bigint, listing_duration bigint, tax_bps int, location_count bigint, bump smallint",
    "regions_region_proposal": "proposal_id bigint, proposer binary, region_id int, created_at bigint, expiry bigint, vote_cutoff bigint, yes_power bigint, no_power bigint, abstain_power bigint, bump smallint",
    "regions_region_state": "region_id int, status string, proposal_id bigint, proposer binary, deposit bigint, claim_deadline bigint, bump smallint",
    "regions_vote_record": "proposal_id bigint, voter binary, region_id int, vote string, power bigint, expiry bigint, bump smallint",
    "marketplace_config": "authority binary, pending_authority binary, token_mint binary, treasury binary, rent_collector binary, accepted_payment_mints array<string>, listing_deposit bigint, lawyer_deposit bigint, min_property_shares bigint, max_property_shares bigint, marketplace_fee_bps int, investor_fee_bps int, max_ownership_bps int, claiming_time bigint, legal_process_time bigint, lawyer_voting_time bigint, min_voting_quorum_bps int, next_listing_id bigint, bump smallint",
    "marketplace_investor_position": "listing_id bigint, investor binary, payment_mint binary, payment_account binary, share_amount bigint, reserved_share_amount bigint, paid_funds bigint, paid_tax bigint, paid_fee bigint, reserved_funds bigint, reserved_tax bigint, reserved_fee bigint, cancelled boolean, bump smallint",
    "marketplace_lawyer": "lawyer binary, region_id int, deposit bigint, active_cases bigint, bump smallint",
    "marketplace_lawyer_candidacy": "listing_id bigint, round bigint, lawyer binary, costs bigint, vote_power bigint, rent_payer binary, bump smallint",
    "marketplace_lawyer_vote": "listing_id bigint, round bigint, voter binary, choice binary, power bigint, rent_payer binary, bump smallint",
    "marketplace_listing": "listing_id bigint, developer binary, asset_id bigint, share_price bigint, listed_share_amount bigint, sold_share_amount bigint, reserved_share_amount bigint, tax_paid_by_developer boolean, tax_bps int, marketplace_fee_bps int, investor_fee_bps int, max_ownership_bps int, listing_expiry bigint, claiming_time bigint, claim_deadline bigint, legal_process_time bigint, lawyer_voting_time bigint, min_voting_quorum_bps int, position_count bigint, legal_deadline bigint, deposit bigint, developer_lawyer binary, developer_lawyer_costs bigint, developer_lawyer_doc_status string, developer_lawyer_documents_hash binary, spv_lawyer binary, spv_lawyer_costs bigint, spv_lawyer_doc_status string, spv_lawyer_documents_hash binary, second_attempt boolean, developer_engaged boolean, spv_costs_due bigint, spv_costs_payee binary, collected array<struct<mint:string,funds:bigint,fee:bigint,tax:bigint>>, spv_election_expiry bigint, spv_election_candidate_count bigint, spv_election_round bigint, status string, bump smallint",
    "marketplace_property_asset": "asset_id bigint, core_asset binary, share_mint binary, region_id int, location binary, share_amount bigint, spv_created boolean, finalized boolean, holder_count bigint, bump smallint",
    "marketplace_reservation": "token_account binary, amount bigint, bump smallint",
    "marketplace_share_holding": "asset_id bigint, owner binary, amount bigint, locked_amount bigint, bump smallint",
    "property_config": "authority binary, pending_authority binary, token_mint binary, treasury binary, rent_collector binary, agent_deposit bigint, agent_voting_time bigint, min_voting_quorum_bps int, agent_notice_period bigint, bump smallint",
    "property_agent_candidacy": "asset_id bigint, round bigint, agent binary, vote_power bigint, rent_payer binary, bump smallint",
    "property_agent_vote": "asset_id bigint, round bigint, voter binary, choice binary, power bigint, rent_payer binary, bump smallint",
    "property_letting_agent": "wallet binary, region_id int, locations array<struct<postcode:string,assigned_count:bigint,deposit:bigint>>, rent_payer binary, bump smallint",
    "property_letting": "asset_id bigint, agent binary, election_expiry bigint, election_candidate_count bigint, election_round bigint, election_quorum_bps int, rent_payer binary, bump smallint",
    "property_resignation_notice": "asset_id bigint, agent binary, due_ts bigint, rent_payer binary, bump smallint",
}

#: nested structs of the input that become prefixed columns
NESTED = {
    "marketplace_listing": {"developer_lawyer": {"": "lawyer", "_costs": "costs", "_doc_status": "doc_status", "_documents_hash": "documents_hash"}, "spv_lawyer": {"": "lawyer", "_costs": "costs", "_doc_status": "doc_status", "_documents_hash": "documents_hash"}, "spv_election": {"_expiry": "expiry", "_candidate_count": "candidate_count", "_round": "round"}},
    "property_letting": {"election": {"_expiry": "expiry", "_candidate_count": "candidate_count", "_round": "round", "_quorum_bps": "quorum_bps"}},
}

NULLABLE = frozenset({"closed_at_slot", "pending_authority"})

#: append-only: the first row of a key stays
LOG_TABLES = {
    "program_instructions": "program_id binary, signature binary, ix_index smallint, inner_index smallint, slot bigint, block_time timestamp, ix_name string, accounts array<binary>, data string",
    "whitelist_actions": "id string, type string, subject string, role string, permission string, actor string, slot bigint, block_time timestamp, tx_signature string, instruction_index string",
    "rejects": "program_id binary, signature binary, instruction_index string, ix_name string, slot bigint, reason string",
    "account_rejects": "pubkey binary, slot bigint, kind string, reason string",
}

#: bookkeeping: the last row of a key stays
BOOK_TABLES = {
    "sync_state": "program_id binary, last_contiguous_slot bigint, backfill_complete boolean, backfill_floor_slot bigint, snapshot_slot bigint, updated_at timestamp",
    "backfill_cursor": "program_id binary, signature string, slot bigint, updated_at timestamp",
    "gaps": "source string, start timestamp, end timestamp",
}

#: the change feed, normalized
FEED_TABLES = {
    "transactions": "slot bigint, signature binary, block_time bigint, failed boolean, vote boolean, instructions array<struct<path:array<int>,program_id:binary,ix_name:string,accounts:array<binary>,args:string,data:binary>>",
    "account_updates": "pubkey binary, owner binary, slot bigint, lamports bigint, kind string, payload string, arrival bigint",
    "account_deletions": "pubkey binary, slot bigint",
    "signatures": "program_id binary, signature binary, slot bigint, failed boolean",
    "metric_samples": "ts timestamp, metric string, labels map<string,string>, value double",
}

KEYS = {"gaps": ["source", "start"], "account_rejects": ["pubkey", "slot", "kind", "reason"], "rejects": ["signature", "instruction_index"], "program_instructions": ["signature", "ix_index", "inner_index"], "whitelist_actions": ["id"], "sync_state": ["program_id"], "backfill_cursor": ["program_id"]}

#: allowed spellings by column: (table, column) to the enum's name in ``enums``
CHECKS = {
    ("role_account", "role"): "ROLE",
    ("role_account", "permission"): "ACCESS_PERMISSION",
    ("regions_region_state", "status"): "REGION_STATUS",
    ("regions_vote_record", "vote"): "VOTE",
    ("marketplace_listing", "status"): "LISTING_STATUS",
    ("marketplace_listing", "developer_lawyer_doc_status"): "DOCUMENT_STATUS",
    ("marketplace_listing", "spv_lawyer_doc_status"): "DOCUMENT_STATUS",
    ("whitelist_actions", "type"): "ACTION_TYPE",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def state_schema(table: str) -> T.StructType:
    return struct(f"{STATE_COLUMNS}, {STATE_PAYLOAD[table]}")


def table_schema(table: str) -> T.StructType:
    """The schema of any table by name."""
    if table in STATE_PAYLOAD:
        return state_schema(table)
    return struct((LOG_TABLES | BOOK_TABLES | FEED_TABLES)[table])


def key_of(table: str) -> list[str]:
    return KEYS.get(table, ["pubkey"])
