"""The given tables in the shapes of the change feed, for Spark and for DuckDB.

Ties are heavy on purpose. Each bridge is a function of the session and folder, with its SQL twin.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.core import enums, registry
from tidelog.core.enums import ROLE
from tidelog.core.schemas import CHECKS, NESTED, STATE_PAYLOAD
from tidelog.functions.columns import key_argument, lower_hex, worked_out
from tidelog.operators.payloads import WIDTH as FIELD_WIDTH
from tidelog.operators.payloads import layouts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROLE_CASE = "CASE event_id % 6 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(ROLE)) + " END"
_TYPE_CASE = """CASE WHEN event_id % 97 = 0 THEN 'AUTHORITY_UPDATED' WHEN event_type = 'signup' THEN 'ROLE_ASSIGNED' WHEN event_type = 'click' THEN 'PERMISSION_UPDATED'
 WHEN event_type = 'error' THEN 'ROLE_REMOVED' WHEN event_type = 'view' THEN 'ROLE_RENOUNCED' WHEN event_id % 2 = 0 THEN 'ADMIN_ADDED' ELSE 'ADMIN_REMOVED' END"""


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as actions: type by event type, a day as slot, four events a transaction."""
    return actions_of(table(spark, sf_dir, "events"))


def actions_of(events: DataFrame) -> DataFrame:
    day = F.unix_date(F.to_date("ts")).cast("long")
    return events.select(
        F.col("event_id").cast("string").alias("id"), F.expr(_TYPE_CASE).alias("type"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("subject"),
        F.expr(_ROLE_CASE).alias("role"), F.when(F.col("event_id") % 2 == 0, "COMPLIANT").otherwise("REVOKED").alias("permission"), F.concat(F.lit("a"), (F.col("event_id") % 7).cast("string")).alias("actor"),
        day.alias("slot"), F.to_date("ts").cast("timestamp_ntz").alias("block_time"), F.md5(F.floor(F.col("event_id") / 4).cast("string")).alias("tx_signature"),
        F.concat_ws(".", (F.col("event_id") % 4).cast("string"), (F.col("event_id") % 12).cast("string")).alias("instruction_index"),
    )


ACTIONS = f"""actions AS (SELECT CAST(event_id AS VARCHAR) AS id, {_TYPE_CASE} AS type, 'u' || user_id AS subject, {_ROLE_CASE} AS role,
 CASE WHEN event_id % 2 = 0 THEN 'COMPLIANT' ELSE 'REVOKED' END AS permission, 'a' || (event_id % 7) AS actor, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS slot,
 CAST(CAST(ts AS DATE) AS TIMESTAMP) AS block_time, md5(CAST(event_id // 4 AS VARCHAR)) AS tx_signature, (event_id % 4) || '.' || (event_id % 12) AS instruction_index,
 [event_id % 4, event_id % 12] AS path FROM events)"""


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as account updates: the customer is the key, the day the slot."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("key"), F.unix_date(F.to_date("o_orderdate")).cast("long").alias("slot"), F.col("o_orderkey").alias("arrival"), F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("table"),
    )


UPDATES = """updates AS (SELECT o_custkey AS key, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS slot, o_orderkey AS arrival, o_totalprice AS price,
 o_orderstatus AS status, o_orderpriority AS "table" FROM orders)"""

#: the middle of the orders' days
MID = 11_400


def split_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored state, updates, closes) from the updates: P is stored, O an update, F a close."""
    u = updates(spark, sf_dir)
    stored = u.where("status = 'P'").groupBy("key").agg(F.max_by(F.struct("slot", "price"), F.struct(F.col("slot"), -F.col("arrival"))).alias("r"))
    stored = stored.select("key", "r.slot", "r.price", F.lit(None).cast("long").alias("closed_at_slot"))
    return stored, u.where("status = 'O'").select("key", "slot", "price", "arrival"), u.where("status = 'F'").select("key", "slot")


STATE = f"""{UPDATES}, stored AS (SELECT key, slot, price, CAST(NULL AS BIGINT) AS closed_at_slot FROM updates WHERE status = 'P' QUALIFY row_number() OVER (PARTITION BY key ORDER BY slot DESC, arrival) = 1),
 ups AS (SELECT key, slot, price, arrival FROM updates WHERE status = 'O'), closes AS (SELECT key, slot FROM updates WHERE status = 'F'),
 upserted AS (SELECT key, slot, price, closed_at_slot FROM (SELECT key, slot, price, closed_at_slot, -1 AS arrival FROM stored UNION ALL SELECT key, slot, price, CAST(NULL AS BIGINT), arrival FROM ups)
 QUALIFY row_number() OVER (PARTITION BY key ORDER BY slot DESC, arrival) = 1),
 last_close AS (SELECT key, max(slot) AS c FROM closes GROUP BY key)"""


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 4).alias("program_id"), F.md5(F.col("o_orderkey").cast("string")).alias("signature"), F.unix_date(F.to_date("o_orderdate")).cast("long").alias("slot"), (F.col("o_orderstatus") == "P").alias("failed"))


SIGNATURES = """signatures AS (SELECT o_custkey % 4 AS program_id, md5(CAST(o_orderkey AS VARCHAR)) AS signature, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS slot, o_orderstatus = 'P' AS failed FROM orders)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as samples: a counter that falls now and then, by series of user and type."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 10).alias("series"), F.col("event_type").alias("reason"), (F.col("event_id") % 50).cast("double").alias("value"), F.col("value").alias("gauge"), F.col("event_id"))


SAMPLES = """samples AS (SELECT ts, user_id % 10 AS series, event_type AS reason, CAST(event_id % 50 AS DOUBLE) AS value, value AS gauge, event_id FROM events)"""


def lineitem_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as instructions of four programs, with accounts and a path."""
    li = table(spark, sf_dir, "lineitem")
    key = lambda c: F.unhex(F.md5(F.col(c).cast("string")))
    return li.select(
        (F.col("l_suppkey") % 4).alias("program"), F.md5(F.col("l_orderkey").cast("string")).alias("signature"), F.array(F.col("l_linenumber"), (F.col("l_partkey") % 3).cast("int")).alias("path"),
        F.unix_date(F.to_date("l_shipdate")).cast("long").alias("slot"), F.concat("l_returnflag", "l_linestatus").alias("ix_name"), F.array(key("l_orderkey"), key("l_partkey"), key("l_suppkey")).alias("accounts"),
        F.to_json(F.struct(F.col("l_quantity").cast("int").alias("qty"))).alias("args"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("qty"),
    )


INSTRUCTIONS = """instructions AS (SELECT l_suppkey % 4 AS program, md5(CAST(l_orderkey AS VARCHAR)) AS signature, [l_linenumber, CAST(l_partkey % 3 AS INTEGER)] AS path,
 CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS slot, l_returnflag || l_linestatus AS ix_name,
 [md5(CAST(l_orderkey AS VARCHAR)), md5(CAST(l_partkey AS VARCHAR)), md5(CAST(l_suppkey AS VARCHAR))] AS accounts, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS qty FROM lineitem)"""


def sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a program of the signatures: the frontier, whether complete, the floor and the snapshot."""
    s = signatures(spark, sf_dir).groupBy("program_id").agg(F.expr("percentile_disc(0.5) within group (order by slot)").cast("long").alias("last_contiguous_slot"), F.min("slot").alias("backfill_floor_slot"))
    return s.select("program_id", "last_contiguous_slot", (F.col("program_id") != 3).alias("backfill_complete"), "backfill_floor_slot", F.when(F.col("program_id") != 2, F.lit(MID).cast("long")).alias("snapshot_slot"))


SYNC = f"""{SIGNATURES}, sync AS (SELECT program_id, quantile_disc(slot, 0.5) AS last_contiguous_slot, program_id <> 3 AS backfill_complete, min(slot) AS backfill_floor_slot,
 CASE WHEN program_id <> 2 THEN CAST({MID} AS BIGINT) END AS snapshot_slot FROM signatures GROUP BY program_id)"""


# --- the feed of the registered programs ---------------------------------------------------------

PROGRAMS = ("whitelist", "regions", "marketplace", "property")
_IX = {p: tuple(dict.fromkeys([r[0] for r in registry.program(p).action_rules] + [r[0] for r in registry.program(p).close_rules])) + ("update_config",) for p in PROGRAMS}
#: how many different accounts the feed has
KEYS = 60
WIDTH = 8


def feed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as transactions of the registered programs, their lines as instructions; some are broken.

    Columns of the feed's transactions, and ``o_orderkey`` and ``o_custkey``. Lines are told apart and brought to their
    order by the few numbers that their instruction is made of; the wide instruction is made where its transaction is.
    """
    li = table(spark, sf_dir, "lineitem")
    program = F.pmod(F.col("l_suppkey"), F.lit(4)).cast("int")
    at = F.col("l_partkey") + F.col("l_linenumber")
    name = F.when(F.lit(False), F.lit(0))
    for k, p in enumerate(PROGRAMS):
        name = name.when(program == k, F.pmod(at, F.lit(len(_IX[p]))).cast("int"))
    qty = F.col("l_quantity").cast("int")
    own = F.col("l_partkey") % 31 != 0
    few = F.struct(
        program.alias("program"), name.alias("name"), F.when(own, F.col("l_linenumber").cast("int")).alias("outer"), F.when(own, ((F.col("l_partkey") * 51 + qty) % 30000).cast("int")).alias("inner"), own.alias("placed"),
        F.when(F.col("l_partkey") % 29 != 0, F.when(F.col("l_partkey") >= 0, F.col("l_partkey") % KEYS).otherwise(F.col("l_partkey"))).alias("account"), F.when(F.col("l_partkey") % 37 != 0, qty).alias("qty"), (F.col("l_partkey") % 37 != 0).alias("whole"),
    )
    lines = li.select(F.col("l_orderkey").alias("o_orderkey"), few.alias("i")).groupBy("o_orderkey").agg(F.collect_set("i").alias("lines"))
    slot = F.unix_date(F.to_date("o_orderdate")).cast("long")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", slot.alias("slot"), F.when(F.col("o_orderkey") % 50 != 0, slot * 86400).alias("block_time"), (F.col("o_orderstatus") == "P").alias("failed"), (F.col("o_orderpriority") == "5-LOW").alias("vote")
    )
    rows = o.join(lines, "o_orderkey").withColumn("signature", F.unhex(F.md5(F.col("o_orderkey").cast("string")))).withColumn("instructions", F.transform("lines", _instruction))
    return rows.select("slot", "signature", "block_time", "failed", "vote", "instructions", "o_orderkey", "o_custkey")


def _instruction(x: Column) -> Column:
    """A line's instruction, from its numbers."""
    ids = F.array(*[F.lit(registry.program(p).id) for p in PROGRAMS])
    names = F.array(*[F.array(*[F.lit(n) for n in _IX[p]]) for p in PROGRAMS])
    # the accounts' keys go round, so a list is a run of them; below 0 they don't
    keys = F.array(*[F.lit(hashlib.md5(f"k{k % KEYS}".encode()).digest()) for k in range(KEYS + WIDTH)])
    below = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda k: F.unhex(F.md5(F.concat(F.lit("k"), ((x["account"] + k) % KEYS).cast("string")))))
    qty = x["qty"]
    args = F.to_json(F.struct((qty % 6).alias("role"), (qty % 2).alias("permission"), F.concat(F.lit("P"), (qty % 3).cast("string")).alias("postcode"), F.concat(F.lit("n"), qty.cast("string")).alias("new_authority"), F.concat(F.lit("x"), qty.cast("string")).alias("admin_key")))
    return F.struct(
        F.when(x["placed"], F.array(x["outer"], x["inner"])).alias("path"), F.get(ids, x["program"]).alias("program_id"), F.get(F.get(names, x["program"]), x["name"]).alias("ix_name"),
        F.when(x["account"] >= 0, F.slice(keys, x["account"].cast("int") + 1, F.lit(WIDTH))).when(x["account"] < 0, below).alias("accounts"), F.when(x["whole"], args).otherwise(F.lit('{"broken')).alias("args"), F.lit(None).cast("binary").alias("data"),
    )


def _rows(rows: list[tuple], columns: str) -> str:
    one = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) v({columns}))"


_NAMES = "CASE l_suppkey % 4 " + " ".join(f"WHEN {k} THEN list_extract([{', '.join(repr(n) for n in _IX[p])}], CAST(1 + (l_partkey + l_linenumber) % {len(_IX[p])} AS BIGINT))" for k, p in enumerate(PROGRAMS)) + " END"
_ARGS = """'{"role":' || qty % 6 || ',"permission":' || qty % 2 || ',"postcode":"P' || qty % 3 || '","new_authority":"n' || qty || '","admin_key":"x' || qty || '"}'"""
_ACTS = [(p, *r) for p in PROGRAMS for r in registry.program(p).action_rules]
_SHUTS = [(p, *r) for p in PROGRAMS for r in registry.program(p).close_rules]
_IDS = "CASE l_suppkey % 4 " + " ".join(f"WHEN {k} THEN '{registry.program(p).id.hex()}'" for k, p in enumerate(PROGRAMS)) + " END"
_PROGRAM = "CASE l_suppkey % 4 " + " ".join(f"WHEN {k} THEN '{p}'" for k, p in enumerate(PROGRAMS)) + " END"

#: feed: all instructions; good and bad: those that can be mapped, and the first bad one of each transaction
FEED = f"""feed AS (SELECT DISTINCT o_orderkey, o_custkey, {_PROGRAM} AS program, {_IDS} AS program_id, {_NAMES} AS ix_name, md5(CAST(o_orderkey AS VARCHAR)) AS signature,
 CASE WHEN l_partkey % 31 <> 0 THEN [CAST(l_linenumber AS INTEGER), CAST((l_partkey * 51 + qty) % 30000 AS INTEGER)] ELSE CAST([] AS INTEGER[]) END AS path,
 CASE WHEN l_partkey % 29 <> 0 THEN list_transform(range(0, {WIDTH}), lambda k: md5('k' || ((l_partkey + k) % {KEYS}))) END AS accounts, CASE WHEN l_partkey % 37 <> 0 THEN {_ARGS} ELSE '{{"broken' END AS args, qty,
 CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS slot, o_orderkey % 50 <> 0 AS timed
 FROM (SELECT *, CAST(l_quantity AS INTEGER) AS qty FROM lineitem) JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'),
 acts AS {_rows(_ACTS, "program, ix_name, type, actor_pos, subject_pos, subject_arg, with_role, with_permission")}, shuts AS {_rows(_SHUTS, 'program, ix_name, "table", pos, conditional')},
 needed AS (SELECT program, ix_name, max(pos) AS pos FROM (SELECT program, ix_name, greatest(actor_pos, coalesce(subject_pos, 0)) AS pos FROM acts UNION ALL SELECT program, ix_name, pos FROM shuts) GROUP BY ALL),
 judged AS (SELECT f.*, CASE WHEN NOT timed THEN 'no_block_time' WHEN len(path) = 0 THEN 'empty_absolute_path' WHEN coalesce(len(accounts), 0) <= coalesce(n.pos, -1) THEN 'missing_account' WHEN args = '{{"broken' THEN 'serialize' END AS reason FROM feed f LEFT JOIN needed n USING (program, ix_name)),
 first_bad AS (SELECT signature, min(path) AS worst FROM judged WHERE reason IS NOT NULL GROUP BY signature),
 good AS (SELECT j.* FROM judged j LEFT JOIN first_bad USING (signature) WHERE worst IS NULL OR path < worst), bad AS (SELECT j.* FROM judged j JOIN first_bad USING (signature) WHERE path = worst AND reason IS NOT NULL)"""


# --- account updates of every state table --------------------------------------------------------

def _json_field(n: int, kind: str, names: tuple[str, ...] | None) -> Column:
    """A payload field, made from an order."""
    key = F.col("o_orderkey")
    if names:
        return ((key + n) % len(names)).cast("int")
    if kind == "binary":
        return F.base64(F.unhex(F.md5(((key + n) % KEYS).cast("string"))))
    if kind == "boolean":
        return (key + n) % 2 == 0
    if kind == "array<string>":
        return F.array(F.concat(F.lit("m"), (key % 5).cast("string")), F.lit("m"))
    if kind.startswith("array<struct<"):
        one = F.struct(*[(F.concat(F.lit("P"), (key % 4).cast("string")) if t == "string" else key + i).alias(p) for i, (p, t) in enumerate(_parts(kind))])
        return F.when(key % 3 == 0, F.array(one, one)).otherwise(F.array(one))
    return (key + n) % _LIMITS[kind]


def _sql_field(n: int, kind: str, names: tuple[str, ...] | None) -> str:
    """What the typed row holds of the field; lists as JSON."""
    if names:
        return f"CASE (o_orderkey + {n}) % {len(names)} " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(names)) + " END"
    if kind == "binary":
        return f"md5(CAST((o_orderkey + {n}) % {KEYS} AS VARCHAR))"
    if kind == "boolean":
        return f"(o_orderkey + {n}) % 2 = 0"
    if kind == "array<string>":
        return "'[\"m' || o_orderkey % 5 || '\",\"m\"]'"
    if kind.startswith("array<struct<"):
        text = ",".join(f'"{p}":' + ("\"P' || o_orderkey % 4 || '\"" if t == "string" else f"' || (o_orderkey + {i}) || '") for i, (p, t) in enumerate(_parts(kind)))
        return f"CASE WHEN o_orderkey % 3 = 0 THEN '[{{{text}}},{{{text}}}]' ELSE '[{{{text}}}]' END"
    return f"CAST((o_orderkey + {n}) % {_LIMITS[kind]} AS {'INTEGER' if kind == 'int' else kind.upper()})"


_LIMITS = {"smallint": 200, "int": 50, "bigint": 97}


def _parts(kind: str) -> list[list[str]]:
    return [p.split(":") for p in kind.removeprefix("array<struct<").removesuffix(">>").split(",")]


def _fields(name: str) -> list[tuple[int, str, str, tuple[str, ...] | None]]:
    """(number, name, type, spellings) of a state table's payload."""
    fields = [f.split(" ") for f in STATE_PAYLOAD[name].split(", ")]
    return [(n, column, kind, getattr(enums, CHECKS[name, column]) if (name, column) in CHECKS else None) for n, (column, kind) in enumerate(fields)]


def _payload(name: str) -> Column:
    """The JSON payload of a table's updates."""
    fields, nested = [], {}
    flat = {f"{p}{suffix}": (p, inner) for p, parts in NESTED.get(name, {}).items() for suffix, inner in parts.items()}
    for n, column, kind, names in _fields(name):
        c = _json_field(n, kind, names)
        if column in flat:
            nested.setdefault(flat[column][0], []).append(c.alias(flat[column][1]))
        else:
            fields.append(c.alias(column))
    return F.to_json(F.struct(*fields, *[F.struct(*v).alias(p) for p, v in nested.items()]))


def account_updates(spark: SparkSession, sf_dir: str, name: str, few: bool = True) -> DataFrame:
    """orders as account updates of one state table, of a few keys or each of its own."""
    o = table(spark, sf_dir, "orders")
    number = F.col("o_custkey") % KEYS if few else F.col("o_orderkey")
    return o.select(
        F.unhex(F.md5(F.concat(F.lit("k"), number.cast("string")))).alias("pubkey"), F.unhex(F.md5(F.lit(name))).alias("owner"), (F.unix_date(F.to_date("o_orderdate")) - F.col("o_orderkey") % 2000).cast("long").alias("slot"),
        (F.col("o_orderkey") % 1000).alias("lamports"), F.lit(name).alias("kind"), _payload(name).alias("payload"), F.col("o_orderkey").alias("arrival"),
    )


def account_rows_sql(name: str, few: bool = True) -> str:
    """All typed rows of a table's updates, binary columns as hex and lists as JSON."""
    columns = ", ".join(f"{_sql_field(n, kind, names)} AS {c}" for n, c, kind, names in _fields(name))
    number = f"o_custkey % {KEYS}" if few else "o_orderkey"
    return f"""SELECT md5('k' || {number}) AS pubkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) - o_orderkey % 2000 AS BIGINT) AS slot, o_orderkey % 1000 AS lamports,
 CAST(NULL AS BIGINT) AS closed_at_slot, {columns}, o_orderkey AS arrival FROM orders"""


def field_value(name: str, column: str, order: int) -> tuple[object, str]:
    """What the order of this number has in a state table's column, for a filter: as Spark's argument and in SQL."""
    n, _, kind, names = next(f for f in _fields(name) if f[1] == column)
    if names:
        v = names[(order + n) % len(names)]
        return v, f"'{v}'"
    if kind == "binary":
        v = hashlib.md5(str((order + n) % KEYS).encode()).hexdigest()
        return key_argument(v, 16), f"'{v}'"
    v = (order + n) % 2 == 0 if kind == "boolean" else (order + n) % _LIMITS[kind]
    return v, str(v).lower()


def plain(rows: DataFrame) -> DataFrame:
    """Binary columns as hex, lists as JSON, so that any engine compares them."""
    one = lambda f: lower_hex(F.col(f.name)) if f.dataType.simpleString() == "binary" else F.to_json(f.name) if f.dataType.simpleString().startswith("array") else F.col(f.name)
    return rows.select(*[one(f).alias(f.name) for f in rows.schema.fields])


# --- account updates as bytes --------------------------------------------------------------------

#: what the orders of these remainders break: the last byte is cut off, the header is another's, an enum is unknown
_CUT, _STRANGE, _ENUM = "o_orderkey % 11 = 0", "o_orderkey % 13 = 0", "o_orderkey % 17 = 0"


def _little(value: Column, width: int) -> Column:
    """A number below 256 as little-endian bytes, in hex."""
    return F.concat(F.lpad(F.hex(value), 2, "0"), F.lit("00" * (width - 1)))


def _bytes_field(n: int, kind: str, names: tuple[str, ...] | None) -> Column:
    """A payload field of an order in hex; see ``_json_field``."""
    key = F.col("o_orderkey")
    own = F.md5(((key + n) % KEYS).cast("string"))
    if kind == "key":
        return F.concat(own, own)
    if kind == "key?":
        return F.when(key % 2 == 0, F.concat(F.lit("01"), own, own)).otherwise("00")
    if kind == "bytes":
        return F.concat(_little(F.lit(16), 4), own)
    if kind == "flag":
        return F.when((key + n) % 2 == 0, "01").otherwise("00")
    if kind == "enum":
        return F.when(F.expr(_ENUM), "fa").otherwise(_little((key + n) % len(names), 1))
    limit = {"u8": 200, "u16": 50}.get(kind, 97)
    return _little((key + n) % limit, FIELD_WIDTH[kind])


def binary_updates(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """orders as account updates of one state table in bytes; some are broken."""
    layout = layouts()[name]
    owner = next(p.id for p in registry.programs() if name in p.tables)
    fields = {c: (n, names) for n, c, _, names in _fields(name)}
    body = F.concat(*[_bytes_field(fields[c][0], kind, fields[c][1]) for c, kind in layout.fields])
    header = F.when(F.expr(_STRANGE), "00" * 8).otherwise(layout.header.hex())
    whole = F.concat(header, body)
    data = F.unhex(F.when(F.expr(_CUT), F.expr("substring(w, 1, length(w) - 2)")).otherwise(F.col("w")))
    rows = account_updates(spark, sf_dir, name).drop("payload", "kind", "owner").withColumnRenamed("arrival", "o_orderkey")
    return worked_out(rows.withColumn("w", whole).select("pubkey", F.lit(owner).alias("owner"), "slot", "lamports", data.alias("data"), F.col("o_orderkey").alias("arrival")))


def _has_enum(name: str) -> bool:
    return any(k == "enum" for _, k in layouts()[name].fields)


def binary_reason_sql(name: str) -> str:
    """Why an order's bytes can't be decoded, or NULL."""
    return f"CASE WHEN {_STRANGE} THEN 'unknown_kind' WHEN {_CUT} THEN 'too_short' {f"WHEN {_ENUM} THEN 'unknown_enum'" if _has_enum(name) else ''} END".replace("o_orderkey", "arrival")


def binary_rows_sql(name: str) -> str:
    """All typed rows of a table's updates in bytes, binary columns as hex, with the reason that some are none."""
    one = []
    kinds = dict(layouts()[name].fields)
    for n, c, kind, names in _fields(name):
        key = f"md5(CAST((o_orderkey + {n}) % {KEYS} AS VARCHAR))"
        sql = {"key": f"{key} || {key}", "key?": f"CASE WHEN o_orderkey % 2 = 0 THEN {key} || {key} END", "bytes": key}.get(kinds[c], _sql_field(n, kind, names))
        one.append(f"{sql} AS {c}")
    rows = f"""SELECT md5('k' || o_custkey % {KEYS}) AS pubkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) - o_orderkey % 2000 AS BIGINT) AS slot, o_orderkey % 1000 AS lamports,
 CAST(NULL AS BIGINT) AS closed_at_slot, {", ".join(one)}, o_orderkey AS arrival FROM orders"""
    return f"SELECT *, {binary_reason_sql(name)} AS reason FROM ({rows})"


def broken_updates(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Account updates in JSON of which some can't be decoded: cut off, without fields, of unknown kind, without key."""
    u = account_updates(spark, sf_dir, name)
    a = F.col("arrival")
    payload = F.when(a % 7 == 0, "{broken").when(a % 7 == 1, "{}").when(a % 7 == 2, F.lit("")).otherwise(F.col("payload"))
    return u.withColumns({"payload": payload, "kind": F.when(a % 7 == 3, "strange").otherwise(F.col("kind")), "pubkey": F.when(a % 7 != 4, F.col("pubkey"))})


#: reason by order, as ``broken_updates`` makes them
BROKEN = "CASE arrival % 7 WHEN 0 THEN 'broken_payload' WHEN 1 THEN 'missing_field' WHEN 2 THEN 'broken_payload' WHEN 3 THEN 'unknown_kind' WHEN 4 THEN 'missing_key' END"
