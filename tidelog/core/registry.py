"""Programs as plain data: schemas, action rules and close rules; more can be registered."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidelog.core.schemas import STATE_PAYLOAD


@dataclass(frozen=True)
class Program:
    """A source of events. ``action_rules``: (instruction, type, actor position, subject position or None,
    subject argument or None, with role, with permission); ``close_rules``: (instruction, table, position,
    conditional)."""

    name: str
    id: bytes
    floor: int
    tables: tuple[str, ...]
    action_rules: tuple[tuple, ...] = ()
    close_rules: tuple[tuple, ...] = ()
    schemas: dict[str, str] = field(default_factory=dict)


_programs: dict[str, Program] = {}


def register_program(name: str, id: bytes, floor: int, table_schemas: dict[str, str], action_rules: tuple = (), close_rules: tuple = ()) -> Program:
    """Adds a program, or replaces the one of that name; its id and tables must be its own."""
    others = [p for p in _programs.values() if p.name != name]
    if any(p.id == id for p in others):
        raise ValueError(f"{name}: another program has this id")
    if taken := {t for p in others for t in p.tables} & set(table_schemas):
        raise ValueError(f"{name}: tables of another program: {sorted(taken)}")
    if unknown := {r[1] for r in close_rules} - set(table_schemas):
        raise ValueError(f"{name}: close rules for unknown tables: {sorted(unknown)}")
    _programs[name] = Program(name, bytes(id), floor, tuple(table_schemas), tuple(action_rules), tuple(close_rules), dict(table_schemas))
    return _programs[name]


@contextmanager
def registered(name: str, *args, **kwargs) -> Iterator[Program]:
    """A program that is registered for the length of a block; what the name stood for before comes back."""
    before = _programs.get(name)
    try:
        yield register_program(name, *args, **kwargs)
    finally:
        _programs.pop(name, None)
        if before is not None:
            _programs[name] = before


def programs() -> list[Program]:
    return list(_programs.values())


def program(name: str) -> Program:
    return _programs[name]


def all_tables() -> list[str]:
    return [t for p in _programs.values() for t in p.tables]


def program_dimension(spark: SparkSession) -> DataFrame:
    """One row a program: a handful, so it may be broadcast."""
    return spark.createDataFrame([(p.name, bytearray(p.id), p.floor, list(p.tables)) for p in programs()], "program string, program_id binary, floor_slot bigint, tables array<string>")


def action_rule_table(spark: SparkSession) -> DataFrame:
    rows = [(bytearray(p.id), *r) for p in programs() for r in p.action_rules]
    return spark.createDataFrame(rows, "program_id binary, ix_name string, type string, actor_pos int, subject_pos int, subject_arg string, with_role boolean, with_permission boolean")


def close_rule_table(spark: SparkSession) -> DataFrame:
    rows = [(bytearray(p.id), *r) for p in programs() for r in p.close_rules]
    return spark.createDataFrame(rows, "program_id binary, ix_name string, table string, pos int, conditional boolean")


def _own(prefix: str) -> dict[str, str]:
    return {t: s for t, s in STATE_PAYLOAD.items() if t.startswith(prefix)}


def _closes(**rules: tuple[tuple[str, int], ...]) -> tuple[tuple[str, str, int, bool], ...]:
    return tuple((ix, table, pos, False) for ix, places in rules.items() for table, pos in places)


#: fixed values; the ids stand in until ``register_program`` gives the real ones
ACTION_RULES = (
    ("initialize_config", "CONFIG_INITIALIZED", 0, 0, None, False, False),
    ("update_authority", "AUTHORITY_UPDATE_PROPOSED", 0, None, "new_authority", False, False),
    ("accept_authority", "AUTHORITY_UPDATED", 0, 0, None, False, False),
    ("add_admin", "ADMIN_ADDED", 0, 2, None, False, False),
    ("remove_admin", "ADMIN_REMOVED", 0, None, "admin_key", False, False),
    ("assign_role", "ROLE_ASSIGNED", 0, 2, None, True, False),
    ("remove_role", "ROLE_REMOVED", 0, 2, None, True, False),
    ("renounce_role", "ROLE_RENOUNCED", 0, 0, None, True, False),
    ("set_permission", "PERMISSION_UPDATED", 0, 2, None, True, True),
)
_WITHDRAWN = (("marketplace_investor_position", 5), ("marketplace_share_holding", 6))
CLOSE_RULES = {
    "whitelist": _closes(remove_admin=(("admin", 2),), remove_role=(("role_account", 4),), renounce_role=(("role_account", 2),)),
    "regions": _closes(
        create_region=(("regions_region_state", 3),),
        clear_region_state=(("regions_region_state", 4),),
        finalize_region_proposal=(("regions_region_proposal", 5),),
        remove_location=(("regions_location", 7),),
        unlock_voting_token=(("regions_vote_record", 5),),
    ),
    "marketplace": _closes(
        unregister_lawyer=(("marketplace_lawyer", 3),),
        release_reservation=(("marketplace_investor_position", 4),),
        close_reservation=(("marketplace_reservation", 3),),
        close_cancelled_position=(("marketplace_investor_position", 4),),
        close_candidacy=(("marketplace_lawyer_candidacy", 3),),
        unlock_voting_shares=(("marketplace_lawyer_vote", 4),),
        close_dead_listing=(("marketplace_listing", 4), ("marketplace_property_asset", 5)),
        withdraw_expired=_WITHDRAWN,
        withdraw_legal_process_expired=_WITHDRAWN,
        withdraw_cancelled=_WITHDRAWN,
    ),
    "property": (
        *_closes(close_agent_candidacy=(("property_agent_candidacy", 3),), unlock_agent_votes=(("property_agent_vote", 4),), finalize_resignation=(("property_resignation_notice", 5),)),
        ("remove_letting_agent", "property_letting_agent", 2, True),
    ),
}
_TABLES = {"whitelist": {t: STATE_PAYLOAD[t] for t in ("config", "admin", "role_account")}, "regions": _own("regions_"), "marketplace": _own("marketplace_"), "property": _own("property_")}
for _name, _floor in (("whitelist", 483_386_556), ("regions", 483_386_626), ("marketplace", 483_386_726), ("property", 483_386_809)):
    register_program(_name, hashlib.sha256(_name.encode()).digest(), _floor, _TABLES[_name], ACTION_RULES if _name == "whitelist" else (), CLOSE_RULES[_name])
