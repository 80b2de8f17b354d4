"""Account payloads: which kind they are, whether they can be decoded, and the typed state rows they hold.

What a payload looks like is data: the state tables' columns in order, each with a type of fixed or prefixed
width. From these a projection over the bytes is built for each table, of built-in functions alone. Rows that
can't be decoded leave with a reason and are never turned into rows of NULLs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.core import enums, registry
from tidelog.core.schemas import CHECKS, NESTED, STATE_PAYLOAD, state_schema
from tidelog.functions.columns import spelled, worked_out

HEADER = 8
#: bytes of the types of fixed width; a key is 32 bytes, a flag and an enum one
WIDTH = {"u8": 1, "u16": 2, "u32": 4, "u64": 8, "key": 32, "flag": 1, "enum": 1}
#: bytes that a type of prefixed width has at least: a tag before a key that may lack, a length before bytes
PREFIX = {"key?": 1, "bytes": 4}

#: columns of four bytes; other bigints have eight (fixed values)
FOUR_BYTES = frozenset({
    ("regions_region", "location_count"), ("marketplace_lawyer", "active_cases"), ("marketplace_lawyer_candidacy", "vote_power"), ("marketplace_lawyer_vote", "power"),
    ("marketplace_investor_position", "share_amount"), ("marketplace_investor_position", "reserved_share_amount"), ("marketplace_property_asset", "share_amount"), ("marketplace_property_asset", "holder_count"),
    ("marketplace_share_holding", "amount"), ("marketplace_share_holding", "locked_amount"), ("property_agent_candidacy", "vote_power"), ("property_agent_vote", "power"), ("property_letting", "election_candidate_count"),
})
#: binary columns that aren't keys, and keys that may lack (fixed values)
RAW_BYTES = frozenset({("regions_location", "postcode"), ("marketplace_property_asset", "location")})
OPTIONAL = frozenset({"pending_authority"})
#: tables whose name isn't made of their program's and their account's
ACCOUNT_NAMES = {"property_letting": "PropertyLetting"}

REASONS = ("missing_key", "unknown_kind", "too_short", "bad_tag", "unknown_enum", "broken_payload", "missing_field")


@dataclass(frozen=True)
class Layout:
    """A table's payload: the header that names it, and (column, type) in order."""

    table: str
    header: bytes
    fields: tuple[tuple[str, str], ...]

    @property
    def least(self) -> int:
        """The length that no whole payload is below."""
        return HEADER + sum(WIDTH.get(t, 0) + PREFIX.get(t, 0) for _, t in self.fields)


def account_name(table: str) -> str:
    if table in ACCOUNT_NAMES:
        return ACCOUNT_NAMES[table]
    prefix = next((p.name + "_" for p in registry.programs() if table.startswith(p.name + "_")), "")
    return "".join(x.capitalize() for x in table.removeprefix(prefix).split("_"))


def _field_type(table: str, column: str, kind: str) -> str:
    if (table, column) in CHECKS:
        return "enum"
    if kind == "binary":
        return "bytes" if (table, column) in RAW_BYTES else "key?" if column in OPTIONAL else "key"
    return {"smallint": "u8", "int": "u16", "boolean": "flag", "bigint": "u32" if (table, column) in FOUR_BYTES else "u64"}[kind]


def layout_of(table: str) -> Layout:
    """The layout of a table without lists; its header is the hash of its account's name."""
    fields = [f.split(" ") for f in STATE_PAYLOAD[table].split(", ")]
    return Layout(table, hashlib.sha256(f"account:{account_name(table)}".encode()).digest()[:HEADER], tuple((c, _field_type(table, c, k)) for c, k in fields))


#: nested choices and lists of structs stay with decoders that send JSON
JSON_ONLY = frozenset({"marketplace_config", "marketplace_listing", "property_letting_agent"})


def layouts() -> dict[str, Layout]:
    """Of every registered table that has one."""
    return {t: layout_of(t) for t in registry.all_tables() if t in STATE_PAYLOAD and t not in JSON_ONLY}


def layout_table(spark: SparkSession) -> DataFrame:
    """(table, header, field, type, position, width, least_length): the layouts as rows."""
    rows = [(x.table, bytearray(x.header), c, k, n, WIDTH.get(k), x.least) for x in layouts().values() for n, (c, k) in enumerate(x.fields)]
    return spark.createDataFrame(rows, "table string, header binary, field string, type string, position int, width int, least_length int")


def kind_table(spark: SparkSession) -> DataFrame:
    """(program_id, header, kind) of every layout: a few rows, fixed by the registry."""
    known = layouts()
    rows = [(bytearray(p.id), bytearray(known[t].header), t) for p in registry.programs() for t in p.tables if t in known]
    return spark.createDataFrame(rows, "program_id binary, header binary, kind string")


def _number(digits: Column, at: int, width: int) -> Column:
    """A little-endian number that starts at a byte, from the payload's hex digits; 8 bytes wrap."""
    turned = [F.substring(digits, (at + k) * 2 + 1, 2) for k in reversed(range(width))]
    return F.conv(F.concat(*turned), 16, -10).cast("bigint")


@dataclass(frozen=True)
class _Projection:
    """``steps``: columns to add first, one after the other; then the typed columns, and the reason why there are none."""

    steps: list[tuple[str, Column]]
    columns: list[Column]
    reason: Column


def _projection(layout: Layout, data: str, digits: str, when: Column | None = None) -> _Projection:
    """Fields are taken in order from the payload's bytes, numbers from its digits. What is left behind a field of prefixed
    width are columns of their own, so each field is at a fixed place of some column."""
    schema = {f.name: f.dataType for f in state_schema(layout.table).fields}
    d, w, at = F.col(data), F.col(digits), HEADER
    steps, out, bad, short = [], [], [], []

    def go_on(size: Column) -> None:
        nonlocal d, w, at
        short.append(F.octet_length(d) < size)
        rest = F.substring(d, size + 1, F.lit(1 << 30)), F.substring(w, size * 2 + 1, F.lit(1 << 30))
        names = [f"{c}_{layout.table}_{len(steps)}" for c in (data, digits)]
        steps.extend((n, r if when is None else F.when(when, r)) for n, r in zip(names, rest, strict=True))
        d, w, at = F.col(names[0]), F.col(names[1]), 0

    for column, kind in layout.fields:
        if kind in WIDTH:
            value = F.substring(d, at + 1, 32) if kind == "key" else _number(w, at, WIDTH[kind])
            if kind == "flag":
                bad.append(F.when(~value.isin(0, 1), F.lit("bad_tag")))
                value = value == 1
            elif kind == "enum":
                value = spelled(value, getattr(enums, CHECKS[layout.table, column]))
                bad.append(F.when(value.isNull(), F.lit("unknown_enum")))
            at += WIDTH[kind]
        elif kind == "key?":
            tag = _number(w, at, 1)
            bad.append(F.when(~tag.isin(0, 1), F.lit("bad_tag")))
            value = F.when(tag == 1, F.substring(d, at + 2, 32))
            go_on(F.when(tag == 1, at + 33).otherwise(at + 1))
        else:
            # a length beyond the payload makes it too short, whatever follows
            size = F.least(_number(w, at, 4), F.octet_length(d)).cast("int")
            value = F.substring(d, F.lit(at + 5), size)
            go_on(F.coalesce(size, F.lit(0)) + at + 4)
        out.append(value.cast(schema[column]).alias(column))
    short.append(F.octet_length(d) < at)
    too_short = F.when(F.coalesce(reduce(lambda a, b: a | b, short), F.lit(True)), F.lit("too_short"))
    return _Projection(steps, out, F.coalesce(too_short, *bad))


_COMMON = ("pubkey", "slot", "lamports")


def _tagged(updates: DataFrame, columns: list[Column], reason: Column) -> DataFrame:
    extra = ["arrival"] if "arrival" in updates.columns else []
    reason = F.coalesce(F.when(F.col("pubkey").isNull(), F.lit("missing_key")), reason)
    return worked_out(updates.select(*_COMMON, F.lit(None).cast("long").alias("closed_at_slot"), *columns, *extra, reason.alias("reason")))


def judged_payloads(updates: DataFrame, table: str, data: str = "data") -> DataFrame:
    """Account updates of one table as typed rows from their bytes, with the reason why a row is none (NULL: it is one)."""
    layout = layouts()[table]
    owner = next(p.id for p in registry.programs() if table in p.tables)  # programs share the names of some accounts
    rows = updates.where((F.col("owner") == F.lit(bytes(owner))) & (F.substring(data, 1, HEADER) == F.lit(layout.header))).withColumn("_digits", F.hex(data))
    p = _projection(layout, data, "_digits")
    for name, step in p.steps:
        rows = rows.withColumn(name, step)
    return _tagged(rows, p.columns, p.reason)


def payload_rows(updates: DataFrame, table: str, data: str = "data") -> DataFrame:
    """Those that can be decoded."""
    return judged_payloads(updates, table, data).where("reason is null").drop("reason")


def payload_rejects(updates: DataFrame, data: str = "data") -> DataFrame:
    """(pubkey, slot, kind, reason) of the updates with ``owner`` that none of its program's layouts decodes; in one pass."""
    kinds = kind_table(updates.sparkSession).withColumnRenamed("program_id", "owner")
    rows = updates.withColumn("header", F.substring(data, 1, HEADER)).drop("kind").join(F.broadcast(kinds), ["owner", "header"], "left").withColumn("_digits", F.hex(data))
    reason = F.when(F.col("kind").isNull(), F.lit("unknown_kind"))
    for table, layout in layouts().items():
        p = _projection(layout, data, "_digits", F.col("kind") == table)
        for name, step in p.steps:
            rows = rows.withColumn(name, step)
        reason = reason.when(F.col("kind") == table, p.reason)
    reason = F.coalesce(F.when(F.col("pubkey").isNull(), F.lit("missing_key")), reason)
    return worked_out(rows.select("pubkey", "slot", "kind", reason.alias("reason"))).where("reason is not null")


# --- payloads that come decoded, as JSON ---------------------------------------------------------

_CORRUPT = "_corrupt"


def judged_documents(updates: DataFrame, table: str) -> DataFrame:
    """Account updates of one kind as typed rows from their JSON payload, with the reason why a row is none.

    Nested structs become prefixed columns, enum indexes become spellings. A payload that isn't a document or has
    a value of a wrong type is broken; one without any of the table's fields is missing them.
    """
    schema = state_schema(table)
    nested = NESTED.get(table, {})
    kinds = {f.name: "int" if (table, f.name) in CHECKS else f.dataType.simpleString() for f in schema.fields[4:]}
    flat = {f"{p}{suffix}": (p, name) for p, parts in nested.items() for suffix, name in parts.items()}
    fields = [f"{c} {k}" for c, k in kinds.items() if c not in flat]
    fields += [f"{p} struct<{','.join(f'{name}:{kinds[p + suffix]}' for suffix, name in parts.items())}>" for p, parts in nested.items()]
    rows = updates.where(F.col("kind") == table).withColumn("p", F.from_json("payload", ", ".join([*fields, f"{_CORRUPT} string"]), {"columnNameOfCorruptRecord": _CORRUPT}))
    out, bad = [], []
    for f in schema.fields[4:]:
        p, name = flat.get(f.name, (None, None))
        c = F.col(f"p.{p}.{name}") if p else F.col(f"p.{f.name}")
        if (table, f.name) in CHECKS:
            value = spelled(c, getattr(enums, CHECKS[table, f.name]))
            bad.append(F.when(c.isNotNull() & value.isNull(), F.lit("unknown_enum")))
            c = value
        out.append(c.cast(f.dataType).alias(f.name))
    broken = F.when(F.col("p").isNull() | F.col(f"p.{_CORRUPT}").isNotNull(), F.lit("broken_payload"))
    none = F.when(reduce(lambda a, b: a & b, [F.col(f"p.{f.split(' ')[0]}").isNull() for f in fields]), F.lit("missing_field"))
    return _tagged(rows, out, F.coalesce(broken, none, *bad))


def document_rejects(updates: DataFrame, tables: list[str]) -> DataFrame:
    """(pubkey, slot, kind, reason) of the updates with a payload that none of these tables takes: what can't be decoded, and
    kinds that no registered table has."""
    known = registry.all_tables()
    parts = [judged_documents(updates, t).select("pubkey", "slot", F.lit(t).alias("kind"), "reason").where("reason is not null") for t in tables]
    strange = updates.where(F.col("kind").isNull() | ~F.col("kind").isin(*known)).select("pubkey", "slot", "kind", F.lit("unknown_kind").alias("reason"))
    return reduce(DataFrame.unionByName, [strange, *parts])
