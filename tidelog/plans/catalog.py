"""Every registered query of the library, and its SQL twin for DuckDB.

Each entry applies one operator to whole tables through a bridge; a page or a top row is cut only where
the operator itself is one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.core import enums, registry, schemas
from tidelog.core.order import events_after, latest_per_key
from tidelog.functions import columns as c
from tidelog.operators import completeness, fold, keyed, listing, mapping, metrics, payloads, validate
from tidelog.plans import bridges as b
from tidelog.sources import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- folds ---------------------------------------------------------------------------------------

_ADMINS = f"""{b.ACTIONS}, ev AS (SELECT *, row(slot, block_time, tx_signature, path) AS o FROM actions WHERE type IN ('ADMIN_ADDED', 'ADMIN_REMOVED')),
 a AS (SELECT * FROM ev WHERE type = 'ADMIN_ADDED' QUALIFY row_number() OVER (PARTITION BY subject ORDER BY slot DESC, block_time DESC, tx_signature DESC, path DESC) = 1),
 r AS (SELECT ev.* FROM ev JOIN a USING (subject) WHERE ev.type = 'ADMIN_REMOVED' AND ev.o > a.o QUALIFY row_number() OVER (PARTITION BY ev.subject ORDER BY ev.slot DESC, ev.block_time DESC, ev.tx_signature DESC, ev.path DESC) = 1),
 admins AS (SELECT a.subject AS id, r.subject IS NULL AS active, a.actor AS added_by, a.slot AS added_at_slot, a.block_time AS added_at, a.tx_signature AS added_in_tx, r.slot AS removed_at_slot, r.block_time AS removed_at, r.tx_signature AS removed_in_tx FROM a LEFT JOIN r USING (subject))"""

_INDEX = "CASE a.role " + " ".join(f"WHEN '{r}' THEN '{i}'" for i, r in enumerate(enums.ROLE)) + " END"
_DESC = "slot DESC, block_time DESC, tx_signature DESC, path DESC"
_DESC_EV = "ev.slot DESC, ev.block_time DESC, ev.tx_signature DESC, ev.path DESC"
_ROLES = f"""{b.ACTIONS}, ev AS (SELECT *, row(slot, block_time, tx_signature, path) AS o FROM actions WHERE type IN ('ROLE_ASSIGNED', 'ROLE_REMOVED', 'ROLE_RENOUNCED', 'PERMISSION_UPDATED')),
 a AS (SELECT * FROM ev WHERE type = 'ROLE_ASSIGNED' QUALIFY row_number() OVER (PARTITION BY subject, role ORDER BY {_DESC}) = 1),
 p AS (SELECT ev.* FROM ev JOIN a USING (subject, role) WHERE ev.type = 'PERMISSION_UPDATED' AND ev.o > a.o QUALIFY row_number() OVER (PARTITION BY ev.subject, ev.role ORDER BY {_DESC_EV}) = 1),
 r AS (SELECT ev.* FROM ev JOIN a USING (subject, role) WHERE ev.type IN ('ROLE_REMOVED', 'ROLE_RENOUNCED') AND ev.o > a.o QUALIFY row_number() OVER (PARTITION BY ev.subject, ev.role ORDER BY {_DESC_EV}) = 1),
 act AS (SELECT subject, role, slot AS updated_at_slot, block_time AS updated_at FROM (SELECT * FROM a UNION ALL SELECT * FROM p UNION ALL SELECT * FROM r) QUALIFY row_number() OVER (PARTITION BY subject, role ORDER BY {_DESC}) = 1),
 assignments AS (SELECT a.subject || '-' || {_INDEX} AS id, a.subject AS user_pubkey, a.role AS role, r.subject IS NULL AS active, coalesce(p.permission, 'COMPLIANT') AS permission, a.actor AS rent_payer, a.actor AS assigned_by,
 a.slot AS assigned_at_slot, a.block_time AS assigned_at, a.tx_signature AS assigned_in_tx, act.updated_at_slot, act.updated_at, r.slot AS removed_at_slot, r.block_time AS removed_at, r.tx_signature AS removed_in_tx, r.actor AS removed_by,
 CASE r.type WHEN 'ROLE_REMOVED' THEN 'REMOVED' WHEN 'ROLE_RENOUNCED' THEN 'RENOUNCED' END AS removal_kind
 FROM a LEFT JOIN p ON p.subject = a.subject AND p.role = a.role LEFT JOIN r ON r.subject = a.subject AND r.role = a.role LEFT JOIN act ON act.subject = a.subject AND act.role = a.role)"""


@register(f"WITH {_ROLES} SELECT * FROM assignments")
def role_assignments_fold(spark, d):
    return fold.role_assignments_fold(b.actions(spark, d))


@register(f"WITH {_ADMINS} SELECT * FROM admins")
def admins_fold(spark, d):
    return fold.admins_fold(b.actions(spark, d))


@register(f"""WITH {b.ACTIONS}, last AS (SELECT slot, block_time, tx_signature FROM actions WHERE type = 'AUTHORITY_UPDATED' ORDER BY {_DESC} LIMIT 1)
 SELECT s.s_name AS authority, CAST(NULL AS VARCHAR) AS pending_authority, slot AS updated_at_slot, block_time AS updated_at, tx_signature AS updated_in_tx FROM (SELECT s_name FROM supplier WHERE s_suppkey = (SELECT min(s_suppkey) FROM supplier)) s LEFT JOIN last ON true""")
def config_fold(spark, d):
    config = b.table(spark, d, "supplier").agg(F.min_by("s_name", "s_suppkey").alias("authority")).withColumn("pending_authority", F.lit(None).cast("string"))
    return fold.config_fold(config, b.actions(spark, d))


@register(f"WITH {b.ACTIONS} SELECT subject, type, id, role, permission, actor, slot, block_time, tx_signature, instruction_index FROM actions QUALIFY row_number() OVER (PARTITION BY subject, type ORDER BY {_DESC}, id DESC) = 1")
def latest_action_per_key(spark, d):
    return latest_per_key(b.actions(spark, d), ["subject", "type"])


@register(f"""WITH {b.ACTIONS}, a AS (SELECT * FROM actions WHERE type = 'ROLE_ASSIGNED' QUALIFY row_number() OVER (PARTITION BY subject, role ORDER BY {_DESC}, id DESC) = 1)
 SELECT e.subject, e.role, e.id, e.type, a.id AS base_id FROM actions e JOIN a USING (subject, role) WHERE row(e.slot, e.block_time, e.tx_signature, e.path) > row(a.slot, a.block_time, a.tx_signature, a.path)""")
def events_after_assignment(spark, d):
    e = b.actions(spark, d)
    base = latest_per_key(e.where("type = 'ROLE_ASSIGNED'"), ["subject", "role"])
    return events_after(base, e, ["subject", "role"]).select("subject", "role", "id", "type", "base_id")


@register(f"WITH {b.ACTIONS} SELECT subject, role, slot AS updated_at_slot, block_time AS updated_at FROM actions QUALIFY row_number() OVER (PARTITION BY subject, role ORDER BY {_DESC}) = 1")
def latest_activity(spark, d):
    return fold.latest_activity(b.actions(spark, d), ["subject", "role"])


@register(f"""WITH {b.ACTIONS}, e AS (SELECT *, row(slot, block_time, tx_signature, path) AS o FROM actions), fa AS (SELECT subject, min(o) AS f FROM e WHERE type = 'ADMIN_ADDED' GROUP BY subject), fr AS (SELECT subject, role, min(o) AS f FROM e WHERE type = 'ROLE_ASSIGNED' GROUP BY ALL)
 SELECT id, 'admin_not_added' AS violation FROM e LEFT JOIN fa USING (subject) WHERE type = 'ADMIN_REMOVED' AND (f IS NULL OR f > o)
 UNION ALL SELECT id, 'role_not_assigned' FROM e LEFT JOIN fr USING (subject, role) WHERE type IN ('ROLE_REMOVED', 'ROLE_RENOUNCED', 'PERMISSION_UPDATED') AND (f IS NULL OR f > o)
 UNION ALL SELECT id, 'no_config' FROM e WHERE type = 'AUTHORITY_UPDATED'""")
def fold_violations(spark, d):
    return fold.fold_violations(b.actions(spark, d))


# --- keyed state ---------------------------------------------------------------------------------


@register("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def append_dedup(spark, d):
    rows = b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return keyed.append_dedup(rows, ["l_orderkey", "l_linenumber"], "l_shipdate").drop("l_shipdate")


@register("""SELECT l_orderkey, l_linenumber, min(l_shipdate) AS first_ship FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL""")
def append_new_keys(spark, d):
    li = b.table(spark, d, "lineitem")
    stored = li.join(b.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")
    rows = li.select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("first_ship"))
    return keyed.append_new(stored, rows, ["l_orderkey", "l_linenumber"], "first_ship")


@register(f"WITH {b.STATE} SELECT key, slot, price, closed_at_slot FROM upserted")
def slot_guarded_upsert(spark, d):
    state, ups, _ = b.split_state(spark, d)
    return keyed.slot_guarded_upsert(state, ups, ["key"])


@register(f"WITH {b.STATE} SELECT key, CASE WHEN c > slot THEN c ELSE slot END AS slot, price, CASE WHEN c > slot THEN c ELSE closed_at_slot END AS closed_at_slot FROM stored LEFT JOIN last_close USING (key)")
def soft_close(spark, d):
    state, _, closes = b.split_state(spark, d)
    return keyed.soft_close(state, closes, ["key"])


_BATCH = f"{b.STATE}, applied AS (SELECT key, CASE WHEN c > slot THEN c ELSE slot END AS slot, price, CASE WHEN c > slot THEN c ELSE closed_at_slot END AS closed_at_slot FROM upserted LEFT JOIN last_close USING (key))"


@register(f"WITH {_BATCH} SELECT * FROM applied")
def apply_batch(spark, d):
    return keyed.apply_batch(*b.split_state(spark, d), ["key"])


def _tagged(spark, d):
    u = b.updates(spark, d)
    rows = u.where("status <> 'F'").groupBy("table", "key").agg(F.max("slot").alias("slot")).withColumn("closed_at_slot", F.lit(None).cast("long"))
    return rows, u.where("status = 'F'").select("table", "key", "slot")


_TAGGED = f"""{b.UPDATES}, rows AS (SELECT "table", key, max(slot) AS slot FROM updates WHERE status <> 'F' GROUP BY ALL), closes AS (SELECT "table", key, slot FROM updates WHERE status = 'F')"""


@register(f"""WITH {_TAGGED}, l AS (SELECT "table", key, max(slot) AS c FROM closes GROUP BY ALL) SELECT "table", key, CASE WHEN c > slot THEN c ELSE slot END AS slot, CASE WHEN c > slot THEN c END AS closed_at_slot FROM rows LEFT JOIN l USING ("table", key)""")
def close_routed(spark, d):
    rows, closes = _tagged(spark, d)
    return keyed.close_routed(rows, closes, ["key"])


@register(f"""WITH {_TAGGED}, l AS (SELECT key, max(slot) AS c FROM closes GROUP BY ALL) SELECT "table", key, CASE WHEN c > slot THEN c ELSE slot END AS slot, CASE WHEN c > slot THEN c END AS closed_at_slot FROM rows LEFT JOIN l USING (key)""")
def close_everywhere(spark, d):
    rows, closes = _tagged(spark, d)
    return keyed.close_everywhere(rows, closes, ["key"])


@register("""WITH st AS (SELECT conv_id, count(*) AS n, max(turn) AS slot, min(role) AS only FROM conversations GROUP BY conv_id), rm AS (SELECT conv_id, role, turn + 1 AS slot FROM conversations)
 , hit AS (SELECT st.conv_id, max(rm.slot) AS c FROM st JOIN rm ON rm.conv_id = st.conv_id AND rm.role = st.only WHERE st.n = 1 GROUP BY ALL) SELECT conv_id, CASE WHEN c > slot THEN c ELSE slot END AS slot, CASE WHEN c > slot THEN c END AS closed_at_slot, n AS n_locations FROM st LEFT JOIN hit USING (conv_id)""")
def close_if_last(spark, d):
    t = b.table(spark, d, "conversations")
    state = t.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("role").alias("postcode"), "turn")).alias("locations"), F.max("turn").alias("slot")).withColumn("closed_at_slot", F.lit(None).cast("long"))
    removals = t.select("conv_id", F.col("role").alias("postcode"), (F.col("turn") + 1).alias("slot"))
    return keyed.close_if_last(state, removals, ["conv_id"]).select("conv_id", "slot", "closed_at_slot", F.size("locations").cast("long").alias("n_locations"))


@register(f"WITH {_BATCH} SELECT 'applied' AS \"table\", key FROM applied WHERE closed_at_slot IS NULL UNION ALL SELECT 'stored', key FROM stored")
def open_keys(spark, d):
    state, ups, closes = b.split_state(spark, d)
    return keyed.open_keys({"applied": keyed.apply_batch(state, ups, closes, ["key"]), "stored": state}, ["key"])


_LIVE = "live AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 0)"
_GONE = f"closed_at_slot IS NULL AND slot < {b.MID} AND key NOT IN (SELECT key FROM live)"


def _live(spark, d):
    return b.table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))


@register(f"WITH {_BATCH}, {_LIVE} SELECT key, CASE WHEN {_GONE} THEN {b.MID} ELSE slot END AS slot, price, CASE WHEN {_GONE} THEN {b.MID} ELSE closed_at_slot END AS closed_at_slot FROM applied")
def close_missing(spark, d):
    return keyed.close_missing(keyed.apply_batch(*b.split_state(spark, d), ["key"]), _live(spark, d), b.MID, ["key"])


@register(f"WITH {_BATCH}, {_LIVE} SELECT * FROM applied WHERE {_GONE}")
def missing_keys(spark, d):
    return keyed.missing_keys(keyed.apply_batch(*b.split_state(spark, d), ["key"]), _live(spark, d), b.MID, ["key"])


@register(f"WITH {_BATCH}, {_LIVE} SELECT (SELECT count(*) FROM live) AS loaded, (SELECT count(*) FROM customer WHERE c_acctbal <= 0) AS undecodable, (SELECT count(*) FROM applied WHERE {_GONE}) AS closed_missing")
def snapshot_summary(spark, d):
    rejected = b.table(spark, d, "customer").where("c_acctbal <= 0")
    return keyed.snapshot_summary(keyed.apply_batch(*b.split_state(spark, d), ["key"]), _live(spark, d), rejected, b.MID, ["key"])


@register("""SELECT n_nationkey AS program_id, CAST(CASE WHEN n_nationkey < 10 THEN 7 ELSE n_nationkey * 100 END AS BIGINT) AS last_contiguous_slot, n_nationkey < 10 AS backfill_complete, CAST(CASE WHEN n_nationkey < 10 THEN 1 ELSE n_nationkey * 100 END AS BIGINT) AS backfill_floor_slot, CAST(CASE WHEN n_nationkey < 10 THEN 5 END AS BIGINT) AS snapshot_slot FROM nation""")
def seed_if_absent(spark, d):
    n = b.table(spark, d, "nation")
    one = lambda v: F.lit(v).cast("long")
    have = n.where("n_nationkey < 10").select(F.col("n_nationkey").alias("program_id"), one(7).alias("last_contiguous_slot"), F.lit(True).alias("backfill_complete"), one(1).alias("backfill_floor_slot"), one(5).alias("snapshot_slot"))
    return keyed.seed_if_absent(have, n.select(F.col("n_nationkey").alias("program_id"), (F.col("n_nationkey") * 100).cast("long").alias("floor_slot")))


@register(f"WITH {b.SYNC}, m AS (SELECT program_id, max(slot) AS s FROM signatures WHERE failed GROUP BY ALL) SELECT program_id, greatest(last_contiguous_slot, s) AS last_contiguous_slot, backfill_complete, backfill_floor_slot, snapshot_slot FROM sync LEFT JOIN m USING (program_id)")
def advance_monotonic(spark, d):
    return keyed.advance_monotonic(b.sync(spark, d), b.signatures(spark, d).where("failed"), ["program_id"])


@register(f"WITH {b.SYNC} SELECT program_id, last_contiguous_slot, backfill_complete, backfill_floor_slot, CASE WHEN program_id = 1 THEN NULL WHEN program_id = 2 THEN last_contiguous_slot ELSE snapshot_slot END AS snapshot_slot FROM sync")
def set_field(spark, d):
    s = b.sync(spark, d)
    values = s.where("program_id in (1, 2)").select("program_id", F.when(F.col("program_id") == 2, F.col("last_contiguous_slot")).alias("value"))
    return keyed.set_field(s, values, ["program_id"], "snapshot_slot")


_CURSOR = f"cur AS (SELECT program_id, signature, slot FROM signatures QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY abs(slot - {b.MID}), signature) = 1)"


def _cursors(spark, d):
    s = b.signatures(spark, d)
    return s.groupBy("program_id").agg(F.min_by(F.struct("signature", "slot"), F.struct(F.abs(F.col("slot") - b.MID), F.col("signature"))).alias("r")).select("program_id", "r.signature", "r.slot")


@register(f"WITH {b.SIGNATURES}, {_CURSOR} SELECT program_id, CASE WHEN program_id = 1 THEN 'new' ELSE signature END AS signature, CASE WHEN program_id = 1 THEN CAST(1 AS BIGINT) ELSE slot END AS slot FROM cur WHERE program_id <> 2")
def cursors(spark, d):
    have = _cursors(spark, d)
    new = have.where("program_id = 1").select("program_id", F.lit("new").alias("signature"), F.lit(1).cast("long").alias("slot"))
    return keyed.clear_cursor(keyed.set_cursor(have, new), have.where("program_id = 2").select("program_id"))


# --- mapping and functions -----------------------------------------------------------------------


def _transactions(spark, d):
    """Orders as transactions: their lines as instructions, failed ones by status."""
    i = b.lineitem_instructions(spark, d).groupBy("l_orderkey", "signature").agg(F.collect_list(F.struct("path", F.col("program").alias("program_id"), F.when(F.col("ix_name") == "NO", mapping.SYNTHETIC).otherwise(F.col("ix_name")).alias("ix_name"), F.struct("qty").alias("args"))).alias("instructions"))
    o = b.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderstatus") == "P").alias("failed"), (F.col("o_orderpriority") == "5-LOW").alias("vote"))
    return i.join(o, "l_orderkey")


@register(f"""WITH {b.INSTRUCTIONS} SELECT signature, program AS program_id, ix_name, path[1] || '.' || path[2] AS path, CAST(path[1] AS SMALLINT) AS ix_index, CAST(path[2] AS SMALLINT) AS inner_index, signature || '-' || path[1] || '.' || path[2] AS row_id
 FROM instructions JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND ix_name <> 'NO'""")
def explode_instructions(spark, d):
    t = mapping.succeeded(_transactions(spark, d))
    outer, inner = c.path_indexes(F.col("path"))
    rows = mapping.instructions(t).withColumn("path_text", c.dotted(F.col("path")))
    return rows.select("signature", "program_id", "ix_name", F.col("path_text").alias("path"), outer.alias("ix_index"), inner.alias("inner_index"), c.row_id(F.col("signature"), outer, inner).alias("row_id"))


@register("SELECT DISTINCT md5(CAST(o_orderkey AS VARCHAR)) AS signature FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey % 4 IN (1, 2)")
def touching_programs(spark, d):
    wanted = [registry.program(p).id for p in ("regions", "marketplace")]
    return mapping.touching(b.feed_transactions(spark, d), wanted).select(c.lower_hex(F.col("signature")).alias("signature"))


@register(f"WITH {b.FEED} SELECT program_id, signature, ix_name FROM feed WHERE program IN ('whitelist', 'property')")
def configured_instructions(spark, d):
    some = registry.program_dimension(spark).where("program in ('whitelist', 'property')")
    rows = mapping.instructions(mapping.succeeded(b.feed_transactions(spark, d)), some)
    return rows.select(c.lower_hex(F.col("program_id")).alias("program_id"), c.lower_hex(F.col("signature")).alias("signature"), "ix_name")


@register(f"WITH {b.FEED}, p AS {b._rows([(p, registry.program(p).floor) for p in b.PROGRAMS], 'program, floor_slot')} SELECT program, floor_slot, len(ix) AS n_instructions, ix AS ix_names FROM (SELECT program, any_value(floor_slot) AS floor_slot, list_sort(list(DISTINCT ix_name)) AS ix FROM p JOIN feed USING (program) GROUP BY program)".replace("len(ix) AS n_instructions, ix AS ix_names", "CAST(len(ix) AS BIGINT) AS n_names, array_to_string(ix, ',') AS names"))
def program_rows(spark, d):
    rows = mapping.instructions(mapping.succeeded(b.feed_transactions(spark, d)))
    names = F.sort_array(F.collect_set("ix_name"))
    return registry.program_dimension(spark).join(rows, "program_id").groupBy("program", "floor_slot").agg(F.size(names).cast("long").alias("n_names"), F.array_join(names, ",").alias("names"))


def _mapped(spark, d):
    t = b.feed_transactions(spark, d)
    return mapping.map_transactions(t, registry.program_dimension(spark), registry.action_rule_table(spark), registry.close_rule_table(spark), spark.createDataFrame([], "slot long, block_time long"))


@register(f"WITH {b.FEED} SELECT program_id, signature, CAST(path[1] AS SMALLINT) AS ix_index, CAST(path[2] AS SMALLINT) AS inner_index, slot, slot * 86400 AS block_time, ix_name, len(accounts) AS n_accounts, args AS data FROM good")
def mapped_history(spark, d):
    h = _mapped(spark, d).history
    return h.select(c.lower_hex(F.col("program_id")).alias("program_id"), c.lower_hex(F.col("signature")).alias("signature"), "ix_index", "inner_index", "slot", F.unix_timestamp("block_time").alias("block_time"), "ix_name", F.when(F.col("accounts").isNotNull(), F.size("accounts")).cast("long").alias("n_accounts"), "data")


_ENUM = lambda names, n: "CASE qty % " + str(n) + " " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(names)) + " END"


@register(f"""WITH {b.FEED} SELECT signature || '-' || path[1] || '.' || path[2] AS id, type, CASE subject_arg WHEN 'new_authority' THEN 'n' || qty WHEN 'admin_key' THEN 'x' || qty ELSE accounts[subject_pos + 1] END AS subject,
 CASE WHEN with_role THEN {_ENUM(enums.ROLE, 6)} END AS role, CASE WHEN with_permission THEN {_ENUM(enums.ACCESS_PERMISSION, 2)} END AS permission, accounts[actor_pos + 1] AS actor, slot, signature AS tx_signature, path[1] || '.' || path[2] AS instruction_index FROM good JOIN acts USING (program, ix_name)""")
def mapped_actions(spark, d):
    return _mapped(spark, d).actions.drop("block_time")


_CLOSES = """closes AS (SELECT "table", accounts[pos + 1] AS pubkey, slot, CASE WHEN conditional THEN 'P' || qty % 3 END AS postcode FROM good JOIN shuts USING (program, ix_name))"""


@register(f"WITH {b.FEED}, {_CLOSES} SELECT * FROM closes")
def mapped_closes(spark, d):
    return _mapped(spark, d).closes.withColumn("pubkey", c.lower_hex(F.col("pubkey")))


@register(f"WITH {b.FEED} SELECT program_id, signature, array_to_string(path, '.') AS instruction_index, ix_name, slot, reason FROM bad")
def mapped_rejects(spark, d):
    r = _mapped(spark, d).rejected
    return r.withColumn("program_id", c.lower_hex(F.col("program_id"))).withColumn("signature", c.lower_hex(F.col("signature")))


@register("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def owner_filter(spark, d):
    accounts = b.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("owner"))
    return mapping.owned_by(accounts, b.table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("program_id"))).select("c_custkey", F.col("owner").alias("c_nationkey"))


@register("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 12 AS VARCHAR) ELSE (event_id % 12) || '.' || (event_id % 4) END AS path, 'x-' || CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 12 AS VARCHAR) ELSE (event_id % 12) || '.' || (event_id % 4) END AS row_id,
 row_number() OVER (ORDER BY CASE WHEN event_id % 3 = 0 THEN [event_id % 12] ELSE [event_id % 12, event_id % 4] END, event_id) AS place FROM events""")
def path_order(spark, d):
    e = b.table(spark, d, "events")
    path = F.when(F.col("event_id") % 3 == 0, F.array((F.col("event_id") % 12).cast("int"))).otherwise(F.array((F.col("event_id") % 12).cast("int"), (F.col("event_id") % 4).cast("int")))
    outer, inner = c.path_indexes(path)
    rows = e.select("event_id", c.dotted(path).alias("path"), c.row_id(F.lit("x"), outer, inner).alias("row_id")).withColumn("key", c.path_key(F.col("path")))
    # places by prefix sums over the few distinct paths, then within a path
    ranked = completeness.ranked(rows.withColumn("whole", F.lit(0)).withColumn("neg", -F.element_at("key", 1)), ["whole"], "neg", ["key", "event_id"], width=1)
    return ranked.select("event_id", "path", "row_id", F.col("rank").alias("place"))


@register(f"WITH {b.INSTRUCTIONS} SELECT l_orderkey, l_linenumber, l_partkey, accounts[1 + qty % 4] AS account, '{{\"qty\":' || qty || '}}' AS args FROM instructions")
def account_at(spark, d):
    i = b.lineitem_instructions(spark, d)
    return i.select("l_orderkey", "l_linenumber", "l_partkey", c.lower_hex(c.account_at(F.col("accounts"), F.col("qty") % 4)).alias("account"), "args")


_STATUS = "CASE p_size % 9 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(enums.LISTING_STATUS)) + " END"


@register(f"SELECT p_partkey, {_STATUS} AS status, CASE WHEN p_size % 9 < 8 THEN CAST(p_size % 9 AS SMALLINT) END AS idx FROM part")
def enum_spellings(spark, d):
    p = b.table(spark, d, "part").select("p_partkey", c.spelled(F.col("p_size") % 9, enums.LISTING_STATUS).alias("status"))
    return p.withColumn("idx", c.indexed(F.col("status"), enums.LISTING_STATUS))


@register("""SELECT conv_id, min(struct_pack(turn := turn, role := role)).role AS first_role, min(struct_pack(turn := turn, role := role)).turn AS first_turn, CAST(to_json(list(struct_pack(role := role, turn := turn) ORDER BY turn, role)) AS VARCHAR) AS turns FROM conversations GROUP BY conv_id""")
def nested_lists(spark, d):
    t = b.table(spark, d, "conversations").groupBy("conv_id").agg(F.min(F.struct("turn", "role")).alias("first"), F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text")))).alias("turns"))
    return t.select("conv_id", *c.flattened("first", ["role", "turn"]), c.json_list(F.col("turns"), ["role", "turn"]).alias("turns"))


@register("SELECT doc_id, lower(hex(encode(source))) AS source_hex, source AS source_text, octet_length(encode(source)) AS n FROM documents")
def bytes_as_text(spark, d):
    raw = F.col("source").cast("binary")
    return b.table(spark, d, "documents").select("doc_id", c.lower_hex(raw).alias("source_hex"), c.lossy_text(raw).alias("source_text"), F.octet_length(raw).cast("long").alias("n"))


_HEX = "md5(CAST(o_orderkey AS VARCHAR))"
_le = lambda at, n: " || ".join(f"substr(h, {2 * (at + k) + 1}, 2)" for k in reversed(range(n)))


@register(f"""WITH x AS (SELECT o_orderkey, {_HEX} AS h FROM orders), y AS (SELECT o_orderkey, CAST('0x' || {_le(0, 1)} AS UBIGINT) AS u8, CAST('0x' || {_le(1, 2)} AS UBIGINT) AS u16, CAST('0x' || {_le(3, 4)} AS UBIGINT) AS u32, CAST('0x' || {_le(7, 8)} AS UBIGINT) AS u64, substr(h, 17, 16) AS be FROM x)
 SELECT o_orderkey, CAST(u8 AS SMALLINT) AS u8, CAST(u16 AS INTEGER) AS u16, CAST(u32 AS BIGINT) AS u32, CAST(CASE WHEN u64 >= 9223372036854775808 THEN CAST(u64 AS HUGEINT) - 18446744073709551616 ELSE u64 END AS BIGINT) AS u64,
 CAST(CASE WHEN CAST('0x' || be AS UBIGINT) >= 9223372036854775808 THEN CAST(CAST('0x' || be AS UBIGINT) AS HUGEINT) - 18446744073709551616 ELSE CAST('0x' || be AS UBIGINT) END AS BIGINT) AS wrapped FROM y""")
def payload_fields(spark, d):
    o = b.table(spark, d, "orders").withColumn("data", F.unhex(F.md5(F.col("o_orderkey").cast("string"))))
    x = F.col("data")
    return o.select("o_orderkey", c.little_endian(x, 0, 1).alias("u8"), c.little_endian(x, 1, 2).alias("u16"), c.little_endian(x, 3, 4).alias("u32"), c.little_endian(x, 7, 8).alias("u64"), c.wrapped_u64(F.hex(c.payload_bytes(x, 8, 8))).alias("wrapped"))


@register(f"""WITH {b.UPDATES}, times AS (SELECT DISTINCT slot, slot * 86400 AS known FROM updates WHERE slot % 3 = 0), x AS (SELECT arrival, coalesce(CASE WHEN arrival % 2 = 0 THEN slot END, known) AS block_time FROM updates LEFT JOIN times USING (slot)) SELECT arrival, block_time, block_time IS NULL AS rejected FROM x""")
def block_times(spark, d):
    u = b.updates(spark, d)
    times = u.where("slot % 3 = 0").select("slot", (F.col("slot") * 86400).alias("block_time")).distinct()
    good, bad = mapping.with_block_time(u.select("arrival", "slot", F.when(F.col("arrival") % 2 == 0, F.col("slot")).alias("block_time")), times)
    return good.select("arrival", "block_time", F.lit(False).alias("rejected")).unionByName(bad.select("arrival", "block_time", F.lit(True).alias("rejected")))


@register(f"""WITH {b.UPDATES}, h AS (SELECT slot, max(slot * 86400 + arrival % 60) AS t FROM updates WHERE arrival % 7 = 0 GROUP BY slot), l AS (SELECT DISTINCT slot, slot * 86400 + 100 AS t FROM updates WHERE slot % 3 = 0)
 SELECT arrival, CASE WHEN arrival % 7 = 0 THEN slot * 86400 + arrival % 60 ELSE coalesce(h.t, l.t) END AS block_time, CASE WHEN arrival % 7 = 0 THEN 'hint' WHEN h.t IS NOT NULL THEN 'cached' WHEN l.t IS NOT NULL THEN 'looked_up' END AS time_origin,
 CASE WHEN arrival % 7 <> 0 AND h.t IS NULL AND l.t IS NULL THEN 'no_block_time' END AS reason FROM updates LEFT JOIN h USING (slot) LEFT JOIN l USING (slot)""")
def time_origins(spark, d):
    """Each row's time and where it came from: its own hint, the hint of another row of its slot, a lookup, or nowhere."""
    u = b.updates(spark, d)
    rows = u.select("arrival", "slot", F.when(F.col("arrival") % 7 == 0, F.col("slot") * 86400 + F.col("arrival") % 60).alias("block_time"))
    looked_up = u.where("slot % 3 = 0").select("slot", (F.col("slot") * 86400 + 100).alias("block_time")).distinct()
    good, bad = mapping.with_block_time(rows, feeds.time_dimension(rows, looked_up))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad).select("arrival", "block_time", "time_origin", "reason")


@register("SELECT doc_id, source || chr(65533) || 'é' || chr(65533) || 'x' || chr(65533) || source AS shown FROM documents")
def lossy_bytes(spark, d):
    """A byte that no text has, a whole sequence, and two that break off, between good bytes."""
    raw = F.col("source").cast("binary")
    bad = F.concat(raw, F.lit(b"\xff"), F.lit("é".encode()), F.lit(b"\xc3"), F.lit(b"x"), F.lit(b"\xe2\x82"), raw)
    return b.table(spark, d, "documents").select("doc_id", c.lossy_text(bad).alias("shown"))


@register(f"""WITH {b.FEED} SELECT 'fifth_item' AS what, accounts[pos + 1] AS pubkey, slot, CAST(2 AS BIGINT) AS refused FROM good JOIN shuts USING (program, ix_name) WHERE program = 'property'
 UNION ALL SELECT 'ROLE_RENOUNCED', accounts[1], slot, 2 FROM good WHERE program = 'property' AND ix_name = 'finalize_resignation'""")
def registered_program(spark, d):
    """A fifth program with rules of its own maps its part of the feed; one with another's id or table is refused."""
    old, id = registry.program("property"), hashlib.sha256(b"fifth").digest()
    closes = tuple((ix, "fifth_item", pos, conditional) for ix, _, pos, conditional in old.close_rules)
    own = lambda x: x.withField("program_id", F.when(x["program_id"] == F.lit(old.id), F.lit(id)).otherwise(x["program_id"]))
    t = b.feed_transactions(spark, d).withColumn("instructions", F.transform("instructions", own))
    refused = 0
    with registry.registered("fifth", id, 0, {"fifth_item": "value int"}, (("finalize_resignation", "ROLE_RENOUNCED", 0, 0, None, False, False),), closes):
        for i, table in ((id, "sixth_item"), (hashlib.sha256(b"sixth").digest(), "fifth_item")):
            try:
                registry.register_program("sixth", i, 0, {table: "value int"})
            except ValueError:
                refused += 1
        m = mapping.map_transactions(t, registry.program_dimension(spark), registry.action_rule_table(spark), registry.close_rule_table(spark), spark.createDataFrame([], "slot long, block_time long"))
    gone = m.closes.where("table = 'fifth_item'").select(F.col("table").alias("what"), c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot")
    done = m.actions.where("type = 'ROLE_RENOUNCED' and id is not null").join(m.history.where(F.col("program_id") == F.lit(id)).select(c.lower_hex(F.col("signature")).alias("tx_signature"), F.concat_ws(".", "ix_index", "inner_index").alias("instruction_index")), ["tx_signature", "instruction_index"], "left_semi")
    return gone.unionByName(done.select(F.col("type").alias("what"), F.col("actor").alias("pubkey"), "slot")).withColumn("refused", F.lit(refused).cast("long"))


#: stand-ins of the rule tables for lineitem's instruction names
_RULES = [("AF", "ROLE_ASSIGNED", 0, 2, None, True, False), ("NF", "ADMIN_REMOVED", 0, None, "qty", False, False), ("RF", "PERMISSION_UPDATED", 1, 3, None, True, True)]


def _role_args(i):
    return i.withColumn("args", F.to_json(F.struct("qty", (F.col("qty") % 6).alias("role"), (F.col("qty") % 2).alias("permission"))))


_ARG_ROLE = "CASE qty % 6 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(enums.ROLE)) + " END"


@register(f"""WITH {b.INSTRUCTIONS} SELECT signature || '-' || path[1] || '.' || path[2] AS id, CASE ix_name WHEN 'AF' THEN 'ROLE_ASSIGNED' ELSE 'ADMIN_REMOVED' END AS type, CASE ix_name WHEN 'AF' THEN accounts[3] ELSE CAST(qty AS VARCHAR) END AS subject,
 CASE WHEN ix_name = 'AF' THEN {_ARG_ROLE} END AS role, CAST(NULL AS VARCHAR) AS permission, accounts[1] AS actor, slot, signature AS tx_signature, path[1] || '.' || path[2] AS instruction_index FROM instructions WHERE ix_name IN ('AF', 'NF')""")
def action_rules(spark, d):
    i = _role_args(b.lineitem_instructions(spark, d)).withColumn("program_id", F.lit(1)).withColumn("signature", F.unhex("signature")).withColumn("block_time", F.lit(None).cast("timestamp_ntz"))
    rules = spark.createDataFrame([(1, *r) for r in _RULES], "program_id int, ix_name string, type string, actor_pos int, subject_pos int, subject_arg string, with_role boolean, with_permission boolean")
    return mapping.actions(i, rules)[0].drop("block_time")


@register(f"""WITH {b.INSTRUCTIONS} SELECT ix_name, 'missing_account' AS reason, count(*) AS n FROM instructions WHERE ix_name = 'RF' GROUP BY ALL""")
def action_rejects(spark, d):
    i = _role_args(b.lineitem_instructions(spark, d)).withColumn("program_id", F.lit(1)).withColumn("signature", F.unhex("signature")).withColumn("block_time", F.lit(None).cast("timestamp_ntz"))
    rules = spark.createDataFrame([(1, *r) for r in _RULES], "program_id int, ix_name string, type string, actor_pos int, subject_pos int, subject_arg string, with_role boolean, with_permission boolean")
    return mapping.actions(i, rules)[1].groupBy("ix_name", "reason").agg(F.count("*").alias("n"))


@register(f"""WITH {b.INSTRUCTIONS}, rules AS (SELECT * FROM (VALUES ('AF', 'admin', 2, false), ('NF', 'position', 1, false), ('NF', 'holding', 2, false), ('RF', 'agent', 0, true)) r(ix_name, "table", pos, conditional))
 SELECT "table", accounts[pos + 1] AS pubkey, slot, CASE WHEN conditional THEN CAST(qty AS VARCHAR) END AS postcode FROM instructions JOIN rules USING (ix_name)""")
def close_rules(spark, d):
    i = b.lineitem_instructions(spark, d).withColumn("program_id", F.lit(1)).withColumn("args", F.to_json(F.struct(F.col("qty").alias("postcode"))))
    rules = spark.createDataFrame([(1, "AF", "admin", 2, False), (1, "NF", "position", 1, False), (1, "NF", "holding", 2, False), (1, "RF", "agent", 0, True)], "program_id int, ix_name string, table string, pos int, conditional boolean")
    out, _ = mapping.closes(i, rules)
    return out.select("table", c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", "postcode")


@register("""WITH x AS (SELECT o_orderkey, md5(CAST(o_orderkey % 10 AS VARCHAR)) AS h FROM orders) SELECT o_orderkey, CASE h WHEN md5('1') THEN 'one' WHEN md5('2') THEN 'two' WHEN md5('7') THEN 'seven' END AS kind FROM x""")
def classify_payloads(spark, d):
    o = b.table(spark, d, "orders").select("o_orderkey", F.lit(1).alias("program_id"), F.unhex(F.md5((F.col("o_orderkey") % 10).cast("string"))).alias("data"))
    kinds = spark.createDataFrame([(1, k, n) for k, n in (("1", "one"), ("2", "two"), ("7", "seven"))], "program_id int, k string, kind string").select("program_id", F.substring(F.unhex(F.md5("k")), 1, 8).alias("header"), "kind")
    known, unknown = mapping.classify(o, kinds)
    return known.select("o_orderkey", "kind").unionByName(unknown.select("o_orderkey", "kind"))


@register("""SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL""")
def current_version(spark, d):
    from pyspark.sql import Window

    o = b.table(spark, d, "orders")
    versions = o.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("valid_from"), F.lead("o_orderdate").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("valid_to"))
    return mapping.current_version(versions).select("o_custkey", "o_orderkey", "o_orderstatus")


# --- validation ----------------------------------------------------------------------------------


def _checked(spark, d):
    i = b.lineitem_instructions(spark, d)
    path = F.when(F.col("qty") % 10 == 0, F.array().cast("array<int>")).otherwise(F.col("path"))
    args = F.when(F.col("qty") % 7 == 0, F.lit("{broken")).otherwise(F.col("args"))
    return i.withColumn("reason", validate.instruction_reason(path, F.col("accounts"), F.col("qty") % 4, args))


_REASON = "CASE WHEN qty % 10 = 0 THEN 'empty_absolute_path' WHEN qty % 4 = 3 THEN 'missing_account' WHEN qty % 7 = 0 THEN 'serialize' END"


@register(f"WITH {b.INSTRUCTIONS}, p AS (SELECT DISTINCT program FROM instructions), r AS (SELECT unnest(['missing_account', 'empty_absolute_path', 'serialize', 'never']) AS reason), n AS (SELECT program, {_REASON} AS reason, count(*) AS n FROM instructions GROUP BY ALL) SELECT program, reason, coalesce(n, 0) AS n FROM p CROSS JOIN r LEFT JOIN n USING (program, reason)")
def rejected_counts(spark, d):
    rows = _checked(spark, d)
    return validate.rejected_counts(rows.where("reason is not null"), rows.select("program").distinct(), (*validate.REASONS, "never"))


@register(f"WITH {b.INSTRUCTIONS}, x AS (SELECT *, {_REASON} AS reason FROM instructions), bad AS (SELECT signature, min(l_linenumber) AS f FROM x WHERE reason IS NOT NULL GROUP BY ALL) SELECT signature, l_linenumber, l_partkey FROM x LEFT JOIN bad USING (signature) WHERE f IS NULL OR l_linenumber < f")
def before_first_bad(spark, d):
    return validate.before_first_bad(_checked(spark, d), ["signature"], "l_linenumber").select("signature", "l_linenumber", "l_partkey")


@register("SELECT 'known_status' AS rule, count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS violations FROM orders UNION ALL SELECT 'price_above', count(*) FILTER (o_totalprice <= 1000) FROM orders")
def check_constraints(spark, d):
    return validate.check_constraints(b.table(spark, d, "orders"), {"known_status": F.col("o_orderstatus").isin("O", "F"), "price_above": F.col("o_totalprice") > 1000})


@register("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return validate.duplicate_keys(b.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- listings and status -------------------------------------------------------------------------


def _accounts(spark, d):
    return keyed.apply_batch(*b.split_state(spark, d), ["key"]).withColumnRenamed("key", "pubkey")


@register(f"WITH {_BATCH} SELECT key AS pubkey, slot, price, closed_at_slot FROM applied WHERE closed_at_slot IS NULL ORDER BY slot DESC, key LIMIT 30 OFFSET 10")
def list_open_rows(spark, d):
    return listing.list_rows(_accounts(spark, d), [mapping.is_active(True)], listing.by_slot(), 30, 10)[0].select("pubkey", "slot", "price", "closed_at_slot")


@register(f"WITH {_BATCH} SELECT CAST(count(*) AS INTEGER) AS total_count FROM applied WHERE closed_at_slot IS NULL")
def list_open_total(spark, d):
    return listing.list_rows(_accounts(spark, d), [mapping.is_active(True)], listing.by_slot())[1]


@register(f"WITH {_ROLES} SELECT * FROM assignments WHERE role = 'LAWYER' AND permission = 'COMPLIANT' ORDER BY assigned_at_slot DESC, id LIMIT 20")
def list_role_assignments(spark, d):
    return listing.query("role_assignments", fold.role_assignments_fold(b.actions(spark, d)), role="LAWYER", permission="COMPLIANT")[0]


@register(f"WITH {_ADMINS} SELECT * FROM admins WHERE active ORDER BY added_at_slot DESC, id LIMIT 20")
def list_admins(spark, d):
    return listing.query("admins", fold.admins_fold(b.actions(spark, d)), active=True)[0]


@register(f"WITH {b.ACTIONS} SELECT id, type, subject, role, permission, actor, slot, block_time, tx_signature, instruction_index FROM actions WHERE type = 'ROLE_ASSIGNED' ORDER BY slot DESC, tx_signature, path, id LIMIT 100 OFFSET 5")
def list_actions(spark, d):
    return listing.query("whitelist_actions", b.actions(spark, d), first=1000, offset=5, type="ROLE_ASSIGNED")[0]


@register(f"WITH {b.INSTRUCTIONS} SELECT signature, ix_index, inner_index, slot, ix_name FROM (SELECT DISTINCT signature, CAST(path[1] AS SMALLINT) AS ix_index, CAST(path[2] AS SMALLINT) AS inner_index, slot, ix_name FROM instructions WHERE ix_name = 'RF') ORDER BY slot DESC, signature, ix_index, inner_index LIMIT 40")
def list_instructions(spark, d):
    outer, inner = c.path_indexes(F.col("path"))
    rows = b.lineitem_instructions(spark, d).select("signature", outer.alias("ix_index"), inner.alias("inner_index"), "slot", "ix_name").distinct()
    return listing.query("program_instructions", rows, first=40, ix_name="RF")[0]


@register("SELECT s_suppkey AS pubkey, CAST(s_nationkey AS BIGINT) AS slot, s_name FROM supplier ORDER BY s_nationkey DESC, s_suppkey LIMIT 1")
def newest_config(spark, d):
    rows = b.table(spark, d, "supplier").select(F.col("s_suppkey").alias("pubkey"), F.col("s_nationkey").cast("long").alias("slot"), "s_name")
    return listing.query("regions_config", rows)[0]


@register(f"WITH {b.UPDATES} SELECT arrival, slot, price FROM updates ORDER BY slot DESC, arrival LIMIT 500 OFFSET 1000")
def numbered_page(spark, d):
    size, skip = listing.numbered_page(2, 9999)
    return b.updates(spark, d).orderBy(F.desc("slot"), "arrival").offset(skip).limit(size).select("arrival", "slot", "price")


@register(f"WITH {_ROLES} SELECT coalesce(bool_or(active), false) AS has_role, coalesce(bool_or(active AND permission = 'COMPLIANT'), false) AS compliant FROM assignments WHERE user_pubkey = 'u3' AND role = 'LAWYER'")
def check_access(spark, d):
    return listing.check_access(fold.role_assignments_fold(b.actions(spark, d)), "u3", "LAWYER")


@register(f"WITH {_ROLES} SELECT * FROM assignments WHERE user_pubkey = 'u3' AND role = 'LAWYER'")
def role_assignment(spark, d):
    return listing.role_assignment(fold.role_assignments_fold(b.actions(spark, d)), "u3", "LAWYER")


_TIP = 11_500


@register(f"WITH {b.SYNC} SELECT min(last_contiguous_slot) AS last_contiguous_slot, bool_and(backfill_complete) AS backfill_complete, CASE WHEN count(*) = count(snapshot_slot) THEN min(snapshot_slot) END AS snapshot_slot, CAST({_TIP} AS BIGINT) AS chain_tip_slot, greatest({_TIP} - greatest(min(last_contiguous_slot), 0), 0) AS slot_lag FROM sync")
def sync_status(spark, d):
    return listing.sync_status(b.sync(spark, d), _TIP)


@register(f"WITH {b.SYNC} SELECT min(last_contiguous_slot) AS last_contiguous_slot, coalesce(bool_and(backfill_complete), false) AS backfill_complete, CAST({_TIP} AS BIGINT) AS chain_tip_slot, greatest({_TIP} - min(last_contiguous_slot), 0) AS slot_lag FROM sync WHERE program_id IN (0, 1)")
def health(spark, d):
    return listing.health(b.sync(spark, d).where(mapping.any_of("program_id", [0, 1])), _TIP)


@register("SELECT (SELECT max(o_orderkey) FROM orders) AS last_height, (SELECT max(l_orderkey) + 5 FROM lineitem) AS head_height, greatest((SELECT max(l_orderkey) + 5 FROM lineitem) - (SELECT max(o_orderkey) FROM orders), 0) AS lag")
def height_status(spark, d):
    last = b.table(spark, d, "orders").agg(F.lit("lastProcessedHeight").alias("key"), F.max("o_orderkey").cast("string").alias("value"))
    head = b.table(spark, d, "lineitem").agg(F.lit("targetHeight").alias("key"), (F.max("l_orderkey") + 5).cast("string").alias("value"))
    return listing.height_status(last.unionByName(head))


# --- completeness --------------------------------------------------------------------------------

_FLOOR, _PAGE = 9800, 100
_PAGES = f"""{b.SIGNATURES}, r AS (SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY slot DESC, signature) AS rk FROM signatures), f AS (SELECT program_id, min(rk) FILTER (slot < {_FLOOR}) AS fr, count(*) AS total FROM r GROUP BY program_id),
 pg AS (SELECT program_id, fr, total, unnest(range(0, CAST(ceil((CASE WHEN fr IS NULL THEN total ELSE fr END) / {_PAGE}.0) AS BIGINT))) AS page FROM f),
 pages0 AS (SELECT program_id, page, fr, total, page * {_PAGE} AS lo, (page + 1) * {_PAGE} AS hi FROM pg WHERE page = 0 OR fr IS NULL OR fr > page * {_PAGE} + 1),
 pages AS (SELECT p.program_id, page, count(*) FILTER (NOT failed AND (fr IS NULL OR rk < fr)) AS n_expected, count(*) FILTER (failed AND (fr IS NULL OR rk < fr)) AS n_failed, max(slot) FILTER (fr IS NULL OR rk < fr) AS newest_slot, min(slot) FILTER (fr IS NULL OR rk < fr) AS oldest_slot,
 CASE WHEN any_value(fr) <= any_value(hi) + 1 THEN (SELECT signature FROM r q WHERE q.program_id = p.program_id AND q.rk = any_value(p.fr)) ELSE (SELECT signature FROM r q WHERE q.program_id = p.program_id AND q.rk = any_value(p.hi) + 1) END AS until,
 CASE WHEN NOT coalesce(any_value(fr) <= any_value(hi) + 1, false) AND any_value(total) > any_value(hi) THEN (SELECT signature FROM r q WHERE q.program_id = p.program_id AND q.rk = any_value(p.hi)) END AS next_cursor,
 CASE WHEN any_value(fr) <= any_value(hi) + 1 THEN 'ReachedFloor' WHEN any_value(total) <= any_value(hi) THEN 'HistoryExhausted' END AS stop
 FROM pages0 p JOIN r ON r.program_id = p.program_id AND r.rk > lo AND r.rk <= hi GROUP BY p.program_id, page)"""


@register(f"WITH {_PAGES} SELECT * FROM pages")
def plan_pages(spark, d):
    return completeness.plan_pages(b.signatures(spark, d), _FLOOR, _PAGE, width=64)


@register(f"WITH {_PAGES} SELECT program_id, count(*) AS windows, CAST(sum(n_expected) AS BIGINT) AS expected, CAST(sum(n_failed) AS BIGINT) AS failed, CAST(sum(n_expected) + sum(n_failed) AS BIGINT) AS enumerated, max(newest_slot) AS newest_slot, min(oldest_slot) AS oldest_slot, max(stop) AS stop FROM pages GROUP BY program_id")
def walk_summary(spark, d):
    return completeness.walk_summary(plan_pages(spark, d))


@register(f"WITH {b.SIGNATURES}, {_CURSOR} SELECT s.* FROM signatures s JOIN cur c USING (program_id) WHERE s.slot < c.slot OR (s.slot = c.slot AND s.signature > c.signature)")
def below_cursor(spark, d):
    return completeness.below_cursor(b.signatures(spark, d), _cursors(spark, d))


_LACK = "lack AS (SELECT s.program_id, s.signature, s.slot FROM signatures s WHERE NOT failed AND signature NOT IN (SELECT DISTINCT md5(CAST(l_orderkey AS VARCHAR)) FROM lineitem WHERE l_quantity > 10))"


def _delivered(spark, d):
    li = b.table(spark, d, "lineitem").where("l_quantity > 10").select(F.md5(F.col("l_orderkey").cast("string")).alias("signature")).distinct()
    return b.signatures(spark, d).join(li, "signature", "left_semi")


@register(f"WITH {b.SIGNATURES}, {_LACK} SELECT * FROM lack")
def missing_signatures(spark, d):
    return completeness.missing(b.signatures(spark, d), _delivered(spark, d))


@register(f"WITH {b.SYNC} SELECT program_id, last_contiguous_slot, backfill_complete OR (9129 + program_id <= backfill_floor_slot) AS backfill_complete, backfill_floor_slot, snapshot_slot FROM sync")
def finish_backfill(spark, d):
    s = b.sync(spark, d)
    return completeness.finish_backfill(s, s.select("program_id", (F.col("program_id") + 9129).alias("floor_used")))


@register(f"""WITH {b.SYNC}, {_LACK}, t AS (SELECT program_id, max(slot) - program_id * 400 AS tip FROM signatures GROUP BY program_id), g AS (SELECT DISTINCT program_id FROM lack JOIN sync USING (program_id) JOIN t USING (program_id) WHERE slot > last_contiguous_slot AND slot <= tip)
 SELECT program_id, CASE WHEN backfill_complete AND g.program_id IS NULL THEN greatest(last_contiguous_slot, tip) ELSE last_contiguous_slot END AS last_contiguous_slot, backfill_complete, backfill_floor_slot, snapshot_slot FROM sync LEFT JOIN t USING (program_id) LEFT JOIN g USING (program_id)""")
def advance_frontier(spark, d):
    s = b.signatures(spark, d)
    tips = s.groupBy("program_id").agg((F.max("slot") - F.first("program_id") * 400).alias("slot"))
    return completeness.advance_frontier(b.sync(spark, d), tips, completeness.missing(s, _delivered(spark, d)))


@register("""WITH e AS (SELECT user_id AS program_id, event_id AS seq, CASE event_type WHEN 'signup' THEN 'session_end' WHEN 'purchase' THEN 'walk_done' WHEN 'error' THEN 'complete' ELSE 'session_start' END AS kind FROM events),
 x AS (SELECT program_id, max(seq) FILTER (kind = 'session_end') AS ended, max(seq) FILTER (kind = 'walk_done') AS walked, max(seq) FILTER (kind = 'complete') AS complete FROM e GROUP BY program_id)
 SELECT program_id, walked IS NULL OR coalesce(ended > walked, false) AS gap_open, NOT (walked IS NULL OR coalesce(ended > walked, false)) AND complete IS NOT NULL AS may_advance FROM x""")
def gap_state(spark, d):
    kind = F.expr("CASE event_type WHEN 'signup' THEN 'session_end' WHEN 'purchase' THEN 'walk_done' WHEN 'error' THEN 'complete' ELSE 'session_start' END")
    return completeness.gap_state(b.table(spark, d, "events").select(F.col("user_id").alias("program_id"), F.col("event_id").alias("seq"), kind.alias("kind")))


@register(f"WITH {b.SYNC} SELECT program_id, greatest({b.MID} - last_contiguous_slot, 0) AS slot_lag FROM sync")
def slot_lag(spark, d):
    return completeness.slot_lag(b.sync(spark, d), b.MID)


# --- metric windows ------------------------------------------------------------------------------

_STEP = f"{b.SAMPLES}, st AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS step FROM (SELECT *, lag(value) OVER (PARTITION BY series, reason ORDER BY ts, value) AS p FROM samples))"
_bucket = lambda s, col="ts": f"CAST(floor(epoch({col}) / {s}) * {s} AS BIGINT)"
_start = lambda df: df.withColumn("start", F.unix_timestamp("start"))
_SERIES = ["series", "reason"]


@register(f"WITH {_STEP} SELECT series, reason, {_bucket(3600)} AS start, sum(step) AS increase FROM st GROUP BY ALL")
def counter_increase(spark, d):
    return _start(metrics.increase(b.samples(spark, d), _SERIES, "1 hour")).drop("end")


@register(f"WITH {_STEP} SELECT series, reason, {_bucket(300)} AS start, sum(step) / 300.0 AS rate FROM st GROUP BY ALL")
def counter_rate(spark, d):
    return _start(metrics.rate(b.samples(spark, d), _SERIES, "5 minutes")).drop("end")


@register(f"WITH {_STEP}, x AS (SELECT series, reason, {_bucket(3600)} AS start, sum(step) / 3600.0 AS rate FROM st GROUP BY ALL) SELECT reason, start, round(sum(rate), 9) AS rate FROM x GROUP BY ALL")
def rate_by_reason(spark, d):
    return _start(metrics.sum_by(metrics.rate(b.samples(spark, d), _SERIES, "1 hour"), ["reason"])).withColumn("rate", F.round("rate", 9))


@register(f"WITH {b.SAMPLES}, x AS (SELECT *, coalesce(value <> lag(value) OVER (PARTITION BY series, reason ORDER BY ts, value), false) AS ch FROM samples) SELECT series, reason, {_bucket(900)} AS start, CAST(sum(CAST(ch AS BIGINT)) AS BIGINT) AS changes FROM x GROUP BY ALL")
def gauge_changes(spark, d):
    return _start(metrics.changes(b.samples(spark, d), _SERIES, "15 minutes")).drop("end")


def _lag(seconds, times="", gone="false"):
    """Frontiers by window, each with the tip as of the window's end."""
    return f"""{b.SAMPLES}, fr AS (SELECT series AS program, {_bucket(seconds)} AS start, max_by(value, row(ts, value)) AS v FROM samples WHERE reason <> 'view' GROUP BY ALL),
 tp AS (SELECT ts, max(value) {times} AS tip FROM samples WHERE reason = 'view' AND NOT ({gone}) GROUP BY ts),
 lag AS (SELECT program, start, tip - v AS lag FROM (SELECT *, make_timestamp((start + {seconds}) * 1000000) AS until FROM fr) f ASOF JOIN tp ON f.until > tp.ts)"""


_LAG = _lag(3600)


def _frontiers(spark, d):
    s = b.samples(spark, d)
    return s.where("reason <> 'view'").withColumnRenamed("series", "program"), s.where("reason = 'view'")


@register(f"WITH {_LAG} SELECT program, start, lag FROM lag")
def lag_per_program(spark, d):
    return _start(metrics.lag_per_program(*_frontiers(spark, d), "1 hour"))


#: whole days, and a quarter of every other one, without a tip
_GONE = "dayofyear(ts) % 3 = 0 OR hour(ts) < 6"


@register(f"WITH {_lag(900, gone=_GONE)} SELECT program, start, lag FROM lag")
def lag_without_tip_samples(spark, d):
    """The tip of the last sample before holds where there is none for days; programs are dealt in shares."""
    frontiers, tips = _frontiers(spark, d)
    return _start(metrics.lag_per_program(frontiers, tips.where(~F.expr(_GONE)), "15 minutes", shares=3))


@register(f"""WITH {b.SAMPLES}, l AS (SELECT event_id, CASE WHEN series <> 3 THEN series END AS series, ts FROM samples WHERE reason <> 'view'), r AS (SELECT CASE WHEN series <> 3 THEN series END AS series, ts, max(value) AS value FROM samples WHERE reason = 'view' GROUP BY ALL)
 SELECT l.event_id, l.series, r.value FROM (SELECT *, coalesce(series, -1) AS k FROM l) l ASOF LEFT JOIN (SELECT *, coalesce(series, -1) AS k FROM r) r ON l.k = r.k AND l.ts >= r.ts""")
def as_of_join(spark, d):
    """Each event with its series' last view; one series has no label."""
    s = b.samples(spark, d).withColumn("series", F.when(F.col("series") != 3, F.col("series")))
    return metrics.as_of(s.where("reason <> 'view'").select("event_id", "series", "ts"), s.where("reason = 'view'").select("series", "ts", "value"), ["series"], ["value"]).select("event_id", "series", "value")


_UNLABELLED = f"{b.SAMPLES}, un AS (SELECT * REPLACE (CASE WHEN series % 4 <> 3 THEN series END AS series) FROM samples)"


@register(f"WITH {_UNLABELLED}, st AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS step FROM (SELECT *, lag(value) OVER (PARTITION BY series, reason ORDER BY ts, value) AS p FROM un)) SELECT series, reason, {_bucket(3600)} AS start, sum(step) AS increase FROM st GROUP BY ALL")
def null_label_increase(spark, d):
    """Series without a label keep their steps over midnight."""
    s = b.samples(spark, d).withColumn("series", F.when(F.col("series") % 4 != 3, F.col("series")))
    return _start(metrics.increase(s, _SERIES, "1 hour")).drop("end")


@register(f"""WITH {_UNLABELLED}, u AS (SELECT series, ts, max(value) > 4 AS "on" FROM un GROUP BY ALL), g AS (SELECT *, sum(CASE WHEN "on" THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY ts) AS run FROM u), h AS (SELECT *, min(CASE WHEN "on" THEN ts END) OVER (PARTITION BY series, run) AS began FROM g)
 SELECT series, CAST(floor(epoch(ts)) AS BIGINT) AS t, CAST(floor(epoch(ts)) - floor(epoch(began)) AS BIGINT) AS held_seconds FROM h WHERE "on" AND floor(epoch(ts)) - floor(epoch(began)) >= 300""")
def null_label_held(spark, d):
    """A condition of a series without a label holds on over midnight."""
    s = b.samples(spark, d).withColumn("series", F.when(F.col("series") % 4 != 3, F.col("series"))).groupBy("series", "ts").agg((F.max("value") > 4).alias("on"))
    return metrics.held_for(s, ["series"], 300).select("series", F.unix_timestamp("ts").alias("t"), "held_seconds")


@register(f"""WITH {b.SAMPLES}, u AS (SELECT series, ts, value > 10 AS "on", event_id FROM samples), g AS (SELECT *, sum(CASE WHEN "on" THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY ts) AS run FROM u), h AS (SELECT *, min(CASE WHEN "on" THEN ts END) OVER (PARTITION BY series, run) AS began FROM g)
 SELECT series, CAST(floor(epoch(ts)) AS BIGINT) AS t, CAST(floor(epoch(ts)) - floor(epoch(began)) AS BIGINT) AS held_seconds FROM h WHERE "on" AND floor(epoch(ts)) - floor(epoch(began)) >= 300""")
def condition_held(spark, d):
    s = b.samples(spark, d).select("series", "ts", (F.col("value") > 10).alias("on"))
    return metrics.held_for(s, ["series"], 300).select("series", F.unix_timestamp("ts").alias("t"), "held_seconds")


_EITHER = f"{b.SAMPLES}, a AS (SELECT series, reason, max(value) AS v FROM samples WHERE value > 40 GROUP BY ALL), bb AS (SELECT series, reason, max(value) AS v FROM samples WHERE value < 20 GROUP BY ALL)"


def _two(spark, d):
    s = b.samples(spark, d)
    top = lambda cond: s.where(cond).groupBy("series", "reason").agg(F.max("value").alias("v"))
    return top("value > 40"), top("value < 20")


@register(f"WITH {_EITHER} SELECT * FROM a UNION ALL SELECT * FROM bb WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.series = bb.series AND a.reason = bb.reason)")
def either_vector(spark, d):
    return metrics.either(*_two(spark, d), _SERIES)


@register(f"WITH {_EITHER} SELECT a.* FROM a WHERE EXISTS (SELECT 1 FROM bb WHERE a.series = bb.series AND a.reason = bb.reason)")
def both_vectors(spark, d):
    return metrics.both(*_two(spark, d), _SERIES)


_BOUNDS = [1.0, 2.0, 5.0, 10.0, 25.0, 50.0, 100.0]
_LES = ", ".join(f"({x}::DOUBLE)" for x in _BOUNDS) + ", ('inf'::DOUBLE)"
_BUCKETS = f"les AS (SELECT * FROM (VALUES {_LES}) t(le)), by_reason AS (SELECT DISTINCT event_type AS reason FROM events), bk AS (SELECT reason, le, (SELECT count(*) FROM events e WHERE e.event_type = reason AND e.value <= le) AS n FROM by_reason CROSS JOIN les)"


def _buckets(spark, d):
    return metrics.bucketize(b.table(spark, d, "events").select(F.col("event_type").alias("reason"), "value"), ["reason"], _BOUNDS)


@register(f"WITH {_BUCKETS} SELECT * FROM bk")
def histogram_buckets(spark, d):
    return _buckets(spark, d)


@register(f"""WITH {_BUCKETS}, q AS (SELECT unnest([0.5, 0.95, 0.99]) AS q), w AS (SELECT reason, le, n, coalesce(lag(le) OVER (PARTITION BY reason ORDER BY le), 0.0) AS low, coalesce(lag(n) OVER (PARTITION BY reason ORDER BY le), 0) AS below, max(n) OVER (PARTITION BY reason) AS total FROM bk),
 h AS (SELECT q, w.* FROM w CROSS JOIN q WHERE n >= q * total AND n > below QUALIFY row_number() OVER (PARTITION BY reason, q ORDER BY le) = 1)
 SELECT reason, CAST(q AS DOUBLE) AS q, round(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (CAST(q AS DOUBLE) * total - below) / (n - below) END, 9) AS value FROM h""")
def histogram_quantiles(spark, d):
    return metrics.histogram_quantiles(_buckets(spark, d), ["reason"], _QS).withColumn("value", F.round("value", 9))


_QS = (0.5, 0.95, 0.99)
_LE = "CASE reason WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.5 WHEN 'signup' THEN 5.0 WHEN 'error' THEN 10.0 ELSE CAST('inf' AS DOUBLE) END"


@register(f"""WITH {b.SAMPLES}, x AS (SELECT series, series % 3 AS zone, CAST({_LE} AS DOUBLE) AS le, ts, value FROM samples), st AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS step FROM (SELECT *, lag(value) OVER (PARTITION BY series, le ORDER BY ts, value) AS p FROM x)),
 bk AS (SELECT zone, {_bucket(21600)} AS start, le, sum(step) AS n FROM st GROUP BY ALL), mono AS (SELECT zone, start, le, max(n) OVER (PARTITION BY zone, start ORDER BY le) AS n FROM bk),
 w AS (SELECT *, coalesce(lag(le) OVER o, 0.0) AS low, coalesce(lag(n) OVER o, 0) AS below, max(n) OVER (PARTITION BY zone, start) AS total FROM mono WINDOW o AS (PARTITION BY zone, start ORDER BY le)),
 q AS (SELECT CAST(unnest([0.5, 0.95, 0.99]) AS DOUBLE) AS q), h AS (SELECT zone, start, q, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (q * total - below) / (n - below) END AS value FROM w CROSS JOIN q WHERE total > 0 AND n >= q * total AND n > below QUALIFY row_number() OVER (PARTITION BY zone, start, q ORDER BY le) = 1)
 SELECT g.zone, g.start, g.q, round(value, 9) AS value FROM (SELECT DISTINCT zone, start, q FROM bk CROSS JOIN q) g LEFT JOIN h USING (zone, start, q)""")
def windowed_quantiles(spark, d):
    """Quantiles of a histogram's growth in each window, from one pass over its bucket counters."""
    s = b.samples(spark, d).select("series", (F.col("series") % 3).alias("zone"), F.expr(_LE).cast("double").alias("le"), "ts", "value")
    grown = metrics.bucket_increases(s, ["series", "zone"], ["zone"], "6 hours")
    return _start(metrics.histogram_quantiles(grown, ["zone", "start"], _QS)).withColumn("value", F.round("value", 9))


@register(f"""WITH {_STEP}, s AS (SELECT series, {_bucket(3600)} AS start, sum(step) AS v FROM (SELECT *, CASE WHEN p2 IS NULL THEN 0 WHEN value < p2 THEN value ELSE value - p2 END AS step FROM (SELECT series, ts, value, lag(value) OVER (PARTITION BY series ORDER BY ts, value) AS p2 FROM samples WHERE reason = 'view')) GROUP BY ALL),
 k AS (SELECT series, {_bucket(3600)} AS start, sum(step) AS v FROM (SELECT *, CASE WHEN p2 IS NULL THEN 0 WHEN value < p2 THEN value ELSE value - p2 END AS step FROM (SELECT series, ts, value, lag(value) OVER (PARTITION BY series ORDER BY ts, value) AS p2 FROM samples WHERE reason = 'click')) GROUP BY ALL)
 SELECT series, start, round(s.v / CASE WHEN k.v <> 0 THEN k.v END, 9) AS mean FROM s JOIN k USING (series, start)""")
def mean_per_flush(spark, d):
    s = b.samples(spark, d)
    return _start(metrics.mean_of(s.where("reason = 'view'"), s.where("reason = 'click'"), ["series"], "1 hour")).withColumn("mean", F.round("mean", 9))


@register(f"WITH {b.SAMPLES} SELECT series, {_bucket(3600)} AS start, min(value) AS lowest FROM samples GROUP BY ALL")
def lowest_value(spark, d):
    return _start(metrics.lowest(b.samples(spark, d), ["series"], "1 hour"))


@register(f"""WITH {_lag(60, "* 200")}, l AS (SELECT program, start, lag > 3000 AS "on" FROM lag), g AS (SELECT *, sum(CASE WHEN "on" THEN 0 ELSE 1 END) OVER (PARTITION BY program ORDER BY start) AS run FROM l), h AS (SELECT *, min(CASE WHEN "on" THEN start END) OVER (PARTITION BY program, run) AS began FROM g)
 SELECT 'SlotLagHigh' AS alert, program, start AS t FROM h WHERE "on" AND start - began >= 300""")
def alert_slot_lag_high(spark, d):
    frontiers, tips = _frontiers(spark, d)
    return metrics.slot_lag_high(frontiers, tips.withColumn("value", F.col("value") * 200)).select("alert", "program", F.unix_timestamp("ts").alias("t"))


_grown = lambda reason: f"SELECT DISTINCT series, start FROM (SELECT series, {_bucket(600)} AS start, sum(CASE WHEN p2 IS NULL THEN 0 WHEN value < p2 THEN value ELSE value - p2 END) AS v FROM (SELECT series, ts, value, lag(value) OVER (PARTITION BY series ORDER BY ts, value) AS p2 FROM samples WHERE reason = '{reason}') GROUP BY ALL) WHERE v > 0"


@register(f"WITH {b.SAMPLES} SELECT 'DecodeFailures' AS alert, series, start FROM ({_grown('error')} UNION {_grown('click')})")
def alert_decode_failures(spark, d):
    s = b.samples(spark, d)
    return _start(metrics.decode_failures(s.where("reason = 'error'"), s.where("reason = 'click'"), ["series"]))


def _down(job, alert):
    return f"""WITH {b.SAMPLES}, u AS (SELECT ts, CASE WHEN value < 40 THEN 0 ELSE 1 END = 0 AS "on" FROM samples WHERE series = {job}), g AS (SELECT *, sum(CASE WHEN "on" THEN 0 ELSE 1 END) OVER (ORDER BY ts) AS run FROM u), h AS (SELECT *, min(CASE WHEN "on" THEN ts END) OVER (PARTITION BY run) AS began FROM g)
 SELECT '{alert}' AS alert, 'job{job}' AS job, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM h WHERE "on" AND floor(epoch(ts)) - floor(epoch(began)) >= 120"""


def _up(spark, d, job, alert):
    up = b.samples(spark, d).select(F.concat(F.lit("job"), F.col("series").cast("string")).alias("job"), "ts", F.when(F.col("value") < 40, 0).otherwise(1).alias("value"))
    return metrics.target_down(up, f"job{job}", alert).select("alert", "job", F.unix_timestamp("ts").alias("t"))


@register(_down(1, "FeedDown"))
def alert_feed_down(spark, d):
    return _up(spark, d, 1, "FeedDown")


@register(_down(2, "ApiDown"))
def alert_api_down(spark, d):
    return _up(spark, d, 2, "ApiDown")


@register(f"WITH {_STEP} SELECT 'ReconnectStorm' AS alert, series, reason, {_bucket(900)} AS start FROM st GROUP BY ALL HAVING sum(step) > 5")
def alert_reconnect_storm(spark, d):
    return _start(metrics.reconnect_storm(b.samples(spark, d), _SERIES))


@register(f"""WITH {_lag(900, "* 200")},
 ch AS (SELECT series AS program, {_bucket(900)} AS start, sum(CAST(c AS BIGINT)) AS n FROM (SELECT *, coalesce(v <> lag(v) OVER (PARTITION BY series ORDER BY ts, v), false) AS c FROM (SELECT series, ts, floor(value / 25) AS v FROM samples WHERE reason <> 'view')) GROUP BY ALL),
 l AS (SELECT program, start, coalesce(lag > 3000 AND n = 0, false) AS "on" FROM lag LEFT JOIN ch USING (program, start)),
 g AS (SELECT *, sum(CASE WHEN "on" THEN 0 ELSE 1 END) OVER (PARTITION BY program ORDER BY start) AS run FROM l), h AS (SELECT *, min(CASE WHEN "on" THEN start END) OVER (PARTITION BY program, run) AS began FROM g)
 SELECT 'BackfillStalled' AS alert, program, start AS t FROM h WHERE "on" AND start - began >= 300""")
def alert_backfill_stalled(spark, d):
    frontiers, tips = _frontiers(spark, d)
    return metrics.backfill_stalled(frontiers, tips.withColumn("value", F.col("value") * 200), frontiers.withColumn("value", F.floor(F.col("value") / 25))).select("alert", "program", F.unix_timestamp("ts").alias("t"))


@register("""WITH x AS (SELECT event_type AS source, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM events), y AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ts) AS s FROM x)
 SELECT source, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM y GROUP BY source, s""")
def stream_sessions(spark, d):
    from tidelog.streaming.jobs import sessions

    e = b.table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("ts"))
    return _start(sessions(e, "30 minutes")).select("source", "start", "n")


def _store(spark):
    import uuid

    from tidelog.sources.store import Store, shared_folder

    return Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")


@register(f"""WITH {_BATCH} SELECT md5(CAST(key AS VARCHAR)) AS pubkey, slot, CAST(floor(price) AS BIGINT) AS lamports, closed_at_slot FROM applied WHERE key NOT IN (SELECT key FROM stored)
 UNION ALL SELECT md5(CAST(a.key AS VARCHAR)), a.slot, CAST(floor(a.price) AS BIGINT), a.closed_at_slot FROM applied a JOIN stored USING (key)""")
def stored_state(spark, d):
    """Two commits to the store, a replay of the second, and a compaction, read back."""
    state, ups, closes = b.split_state(spark, d)
    key = F.unhex(F.md5(F.col("key").cast("string"))).alias("pubkey")
    row = lambda df, arrival: df.select(key, "slot", F.floor("price").cast("long").alias("lamports"), key.alias("admin"), F.lit(0).cast("smallint").alias("bump"), arrival.alias("arrival"))
    store = _store(spark)
    store.commit("orders", 0, [store.changed("admin", row(state, F.lit(0).cast("long")))])
    store.compact("admin")
    for _ in range(2):
        store.commit("orders", 1, [store.changed("admin", row(ups, F.col("arrival")), closes.select(key, "slot"))])
    return store.read("admin").select(c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", "lamports", "closed_at_slot")


_CLOSING = ("admin", "role_account", "regions_location", "property_letting_agent")


def _closed_sql(name):
    meant = "(k.postcode IS NULL OR (arrival % 3 <> 0 AND k.postcode = 'P' || arrival % 4))" if name == "property_letting_agent" else "k.postcode IS NULL"
    return f"""SELECT '{name}' AS "table", u.pubkey, CASE WHEN max(k.slot) > u.slot THEN max(k.slot) ELSE u.slot END AS slot, CASE WHEN max(k.slot) > u.slot THEN max(k.slot) END AS closed_at_slot, u.lamports
 FROM (SELECT * FROM ({b.account_rows_sql(name)}) QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY slot DESC, arrival) = 1) u LEFT JOIN closes k ON k."table" = '{name}' AND k.pubkey = u.pubkey AND {meant} GROUP BY u.pubkey, u.slot, u.lamports"""


@register(f"WITH {b.FEED}, {_CLOSES} " + " UNION ALL ".join(map(_closed_sql, _CLOSING)))
def written_closes(spark, d):
    """Account updates from one source, transactions from another: instructions close rows in their own commit, one table only if its list ends."""
    from tidelog.streaming import jobs

    store = _store(spark)
    for t in _CLOSING:
        jobs.state_writer(store, t, f"accounts-{t}")(b.account_updates(spark, d, t), 0)
    jobs.transaction_writer(store, "live", tables=_CLOSING)(b.feed_transactions(spark, d), 0)
    parts = [store.read(t).select(F.lit(t).alias("table"), c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", "closed_at_slot", "lamports") for t in _CLOSING]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_REASONS = (*validate.REASONS, "no_block_time", "never")


@register(f"""WITH {b.FEED}, r AS (SELECT unnest({list(_REASONS)!r}) AS reason), kept AS (SELECT * FROM bad QUALIFY row_number() OVER (PARTITION BY signature, path ORDER BY slot, reason, program_id, ix_name) = 1)
 SELECT p.program, r.reason, (SELECT count(*) FROM kept k WHERE k.program = p.program AND k.reason = r.reason) AS n FROM (SELECT unnest({list(b.PROGRAMS)!r}) AS program) p CROSS JOIN r""")
def stored_rejects(spark, d):
    """What can't be mapped is stored with its reason and counted by program, zeros included."""
    from tidelog.streaming import jobs

    store, programs = _store(spark), registry.program_dimension(spark)
    jobs.transaction_writer(store, "live", tables=())(b.feed_transactions(spark, d), 0)
    rejects = store.read("rejects").join(F.broadcast(programs.select("program_id", "program")), "program_id")
    return validate.rejected_counts(rejects, programs, _REASONS)


@register(f"WITH {b.FEED} SELECT signature, CAST(path[1] AS SMALLINT) AS ix_index, CAST(path[2] AS SMALLINT) AS inner_index, program_id, slot, ix_name FROM good")
def two_sources_one_store(spark, d):
    """Live and history write one store, each with its own batches 0 and 1; history repeats part of what was live."""
    from tidelog.streaming import jobs

    store, t = _store(spark), b.feed_transactions(spark, d)
    live, history = jobs.transaction_writer(store, "live", tables=()), jobs.transaction_writer(store, "history", tables=())
    for number in (0, 1):
        live(t.where((F.col("o_orderkey") % 2 == 0) & (F.col("o_custkey") % 2 == number)), number)
        history(t.where(((F.col("o_orderkey") % 2 == 1) | (F.col("o_orderkey") % 10 == 0)) & (F.col("o_custkey") % 2 == number)), number)
    live(t.where("o_custkey % 2 = 1"), 1)  # a replay
    return store.read("program_instructions").select(c.lower_hex(F.col("signature")).alias("signature"), "ix_index", "inner_index", c.lower_hex(F.col("program_id")).alias("program_id"), "slot", "ix_name")


def _parts(spark, d, name):
    """How many parts a given table is read in."""
    return max(1, b.table(spark, d, name).rdd.getNumPartitions())


def _newest_sql(name):
    return f"SELECT * EXCLUDE (arrival) FROM ({b.account_rows_sql(name)}) QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY slot DESC, arrival) = 1"


@register(_newest_sql("regions_vote_record"))
def streamed_updates(spark, d):
    """Account updates that arrive as a stream of files, upserted batch by batch."""
    import uuid

    from tidelog.sources.feeds import read_changes
    from tidelog.sources.store import shared_folder
    from tidelog.streaming import jobs

    folder = f"{shared_folder(spark)}/updates-{uuid.uuid4().hex}"
    updates = b.account_updates(spark, d, "regions_vote_record")
    # slots don't tie between files, so the files' order doesn't matter; the table's parts set their number, so that none grows with it
    updates.repartition(3 * _parts(spark, d, "orders"), "slot").write.parquet(f"{folder}/feed")
    files = len(spark.read.schema(updates.schema).parquet(f"{folder}/feed").inputFiles())
    store = _store(spark)
    feed = read_changes(spark, f"{folder}/feed", "account_updates", files_per_trigger=-(-2 * files // 3))
    jobs.run_stream(feed, jobs.state_writer(store, "regions_vote_record", "live", compact_every=2), f"{folder}/progress", once=True).awaitTermination()
    return b.plain(store.read("regions_vote_record"))


@register(f"""WITH p AS ({_newest_sql("admin")}), live AS (SELECT DISTINCT md5('k' || o_custkey % {b.KEYS}) AS pubkey FROM orders WHERE o_custkey % {b.KEYS} % 3 <> 0)
 SELECT pubkey, CAST(40000 AS BIGINT) AS slot, CASE WHEN pubkey IN (SELECT pubkey FROM live) THEN NULL ELSE CAST(40000 AS BIGINT) END AS closed_at_slot, (SELECT CAST(40000 AS BIGINT)) AS snapshot_slot FROM p""")
def snapshot_job(spark, d):
    """A snapshot over a store that has more rows: what it lacks is closed at its slot, and its slot is noted in the same commit."""
    from tidelog.streaming import jobs

    store, updates, program = _store(spark), b.account_updates(spark, d, "admin"), registry.program("whitelist")
    jobs.seed(store, [program])
    jobs.state_writer(store, "admin", "accounts")(updates, 0)
    live = updates.where(F.col("pubkey").isin([bytearray(c.key_argument(hashlib.md5(f"k{n}".encode()).hexdigest(), 16)) for n in range(b.KEYS) if n % 3]))
    jobs.load_snapshot(store, program, live, 40_000)
    return store.read("admin").select(c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", "closed_at_slot").crossJoin(store.read("sync_state").select("snapshot_slot"))


@register(f"SELECT md5('k' || o_custkey % {b.KEYS}) AS pubkey, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % {b.KEYS} IN (SELECT o_custkey % {b.KEYS} FROM orders WHERE o_orderstatus = 'O') GROUP BY ALL")
def tracked_deletions(spark, d):
    from tidelog.streaming import jobs

    o = b.table(spark, d, "orders")
    key = F.unhex(F.md5(F.concat(F.lit("k"), (F.col("o_custkey") % b.KEYS).cast("string")))).alias("pubkey")
    held = o.select(key, F.when(F.col("o_orderstatus") != "O", 1).cast("long").alias("closed_at_slot"))
    deletions = o.where("o_orderkey % 3 = 0").select(key, F.lit(1).alias("slot"))
    return jobs.tracked_deletions(deletions, {"admin": held}).groupBy("pubkey").agg(F.count("*").alias("n")).withColumn("pubkey", c.lower_hex(F.col("pubkey")))


# --- typed state rows and their listings ---------------------------------------------------------


def _state_rows(name):
    def run(spark, d):
        return b.plain(mapping.state_rows(b.account_updates(spark, d, name), name))

    run.__name__ = f"state_{name}"
    return register(b.account_rows_sql(name))(run)


for _table in registry.all_tables():
    _state_rows(_table)


#: the order whose values the listings ask for
_ASKED = 1


def _listing(name, spec):
    closed = "CASE WHEN arrival % 4 = 0 THEN slot END"
    rows = f"SELECT * EXCLUDE (arrival) REPLACE ({closed} AS closed_at_slot) FROM ({b.account_rows_sql(spec.table, few=False)})"

    def typed(spark, d):
        r = mapping.state_rows(b.account_updates(spark, d, spec.table, few=False), spec.table)
        return r.withColumn("closed_at_slot", F.when(F.col("arrival") % 4 == 0, F.col("slot"))).drop("arrival")

    if spec.single:

        def run(spark, d):
            return b.plain(listing.query(name, typed(spark, d))[0])

        sql = f"SELECT * FROM ({rows}) ORDER BY slot DESC, pubkey LIMIT 1"
    else:
        column = spec.filters[0]
        value, literal = b.field_value(spec.table, column, _ASKED)

        def run(spark, d):
            page, total = listing.query(name, typed(spark, d), first=30, offset=2, active=True, **{column: value})
            return b.plain(page).crossJoin(F.broadcast(total))

        where = f"{column} = {literal} AND closed_at_slot IS NULL"
        sql = f"WITH r AS ({rows}) SELECT *, (SELECT CAST(count(*) AS INTEGER) FROM r WHERE {where}) AS total_count FROM r WHERE {where} ORDER BY slot DESC, pubkey LIMIT 30 OFFSET 2"
    run.__name__ = f"list_{name}"
    register(sql)(run)


for _name, _spec in listing.LISTINGS.items():
    if _spec.table in schemas.STATE_PAYLOAD:
        _listing(_name, _spec)


@register(f"WITH {_BATCH} SELECT key AS pubkey, slot, price, closed_at_slot FROM applied ORDER BY slot DESC, key LIMIT 100")
def list_all_rows(spark, d):
    """Without ``active``, closed rows are listed too."""
    return listing.list_rows(_accounts(spark, d), [mapping.is_active(None)], listing.by_slot(), 100)[0].select("pubkey", "slot", "price", "closed_at_slot")


@register(f"""WITH {b.ACTIONS}, last AS (SELECT slot, block_time, tx_signature FROM actions WHERE type = 'AUTHORITY_UPDATED' ORDER BY {_DESC} LIMIT 1)
 SELECT s.s_name AS authority, CAST(NULL AS VARCHAR) AS pending_authority, slot AS updated_at_slot, block_time AS updated_at, tx_signature AS updated_in_tx FROM (SELECT s_name FROM supplier WHERE s_suppkey = (SELECT min(s_suppkey) FROM supplier)) s, last""")
def config_view(spark, d):
    return listing.config_view(config_fold(spark, d))


@register(f"WITH {_ADMINS} SELECT * FROM admins ORDER BY added_at_slot DESC, id LIMIT 50 OFFSET 50")
def numbered_admins(spark, d):
    return listing.query_numbered("admins", fold.admins_fold(b.actions(spark, d)), page=1)


@register(f"WITH {b.ACTIONS} SELECT id, type, subject, role, permission, actor, slot, block_time, tx_signature, instruction_index FROM actions WHERE actor = 'a3' ORDER BY slot DESC, tx_signature, path, id LIMIT 500 OFFSET 500")
def numbered_actions(spark, d):
    return listing.query_numbered("whitelist_actions", b.actions(spark, d), page=1, size=900, actor="a3")


@register(f"WITH {b.SYNC} SELECT 'p' || program_id AS program, last_contiguous_slot, backfill_complete, backfill_floor_slot, snapshot_slot FROM sync WHERE program_id IN (1, 3)")
def sync_programs(spark, d):
    names = b.signatures(spark, d).select("program_id").distinct().withColumn("program", F.concat(F.lit("p"), F.col("program_id").cast("string")))
    return listing.sync_programs(b.sync(spark, d), names, [1, 3])


@register(f"WITH {b.SYNC} SELECT min(last_contiguous_slot) AS last_contiguous_slot, bool_and(backfill_complete) AS backfill_complete, CASE WHEN count(*) = count(snapshot_slot) THEN min(snapshot_slot) END AS snapshot_slot, CAST({_TIP} AS BIGINT) AS chain_tip_slot, greatest({_TIP} - greatest(min(last_contiguous_slot), 0), 0) AS slot_lag FROM sync WHERE program_id IN (0, 1)")
def sync_status_of_some(spark, d):
    return listing.sync_status(b.sync(spark, d), _TIP, [0, 1])


# --- sources, ties, replays ----------------------------------------------------------------------


@register(f"WITH {b.INSTRUCTIONS} SELECT program, signature, slot, ix_name FROM instructions WHERE slot BETWEEN 10000 AND 10400 AND program = 2")
def history_range(spark, d):
    from tidelog.sources.feeds import read_history

    rows = b.lineitem_instructions(spark, d).withColumn("program_id", F.col("program").cast("string").cast("binary"))
    return read_history(rows, 10000, 10400, b"2").select("program", "signature", "slot", "ix_name")


@register("SELECT c_custkey AS pubkey, c_acctbal AS lamports, CAST(77 AS BIGINT) AS slot FROM customer")
def snapshot_rows(spark, d):
    from tidelog.sources.feeds import read_snapshot

    return read_snapshot(b.table(spark, d, "customer").select(F.col("c_custkey").alias("pubkey"), F.col("c_acctbal").alias("lamports")), 77)


_AT = "CAST(floor(epoch(ts)) AS BIGINT) AS t"


def _sampled(samples):
    return samples.select(F.unix_timestamp("ts").alias("t"), "metric", F.to_json("labels").alias("labels"), "value")


@register(f"""SELECT {_AT}, 'views' AS metric, '{{"type":"' || event_type || '"}}' AS labels, 1.0::DOUBLE AS value FROM events""")
def counter_samples(spark, d):
    from tidelog.sources import feeds

    return _sampled(feeds.counter_samples(b.table(spark, d, "events").withColumnRenamed("event_type", "type"), "views", "ts", ["type"]))


@register(f"""SELECT {_AT}, 'level' AS metric, '{{"type":"' || event_type || '"}}' AS labels, value FROM events""")
def gauge_samples(spark, d):
    from tidelog.sources import feeds

    return _sampled(feeds.gauge_samples(b.table(spark, d, "events").withColumnRenamed("event_type", "type"), "level", "ts", "value", ["type"]))


@register(f"""WITH e AS (SELECT * FROM events WHERE value IS NOT NULL) SELECT {_AT}, 'took_bucket' AS metric, '{{"type":"' || event_type || '","le":"' || name || '"}}' AS labels, 1.0::DOUBLE AS value
 FROM e, (VALUES (10.0, '10'), (50.0, '50'), (100.0, '100'), ('inf'::DOUBLE, '+Inf')) b(le, name) WHERE value <= le
 UNION ALL SELECT {_AT}, 'took_sum', '{{"type":"' || event_type || '"}}', value FROM e UNION ALL SELECT {_AT}, 'took_count', '{{"type":"' || event_type || '"}}', 1.0 FROM e""")
def histogram_samples(spark, d):
    from tidelog.sources import feeds

    return _sampled(feeds.bucket_samples(b.table(spark, d, "events").withColumnRenamed("event_type", "type"), "took", "ts", "value", ["type"], [10.0, 50.0, 100.0]))


@register(f"WITH {b.STATE} SELECT key, slot, price, closed_at_slot FROM upserted")
def same_slot_closes(spark, d):
    """A close at the slot of its row leaves it open until the next sweep."""
    state, ups, _ = b.split_state(spark, d)
    rows = keyed.slot_guarded_upsert(state, ups, ["key"])
    return keyed.soft_close(rows, rows.select("key", "slot"), ["key"])


@register(f"WITH {_ROLES} SELECT * FROM assignments")
def replayed_role_fold(spark, d):
    """The fold doesn't mind repeated events or their order."""
    a = b.actions(spark, d)
    return fold.role_assignments_fold(a.orderBy(F.desc("id")).unionByName(a.repartition(7, "tx_signature")))


@register("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' ELSE 'ABSTAIN' END AS vote FROM part")
def checked_enum(spark, d):
    p = b.table(spark, d, "part").select("p_partkey", c.spelled(F.col("p_size") % 3, enums.VOTE).alias("vote"))
    return p.withColumn("vote", c.checked(F.col("vote"), enums.VOTE, "vote"))


@register(f"WITH {b.SIGNATURES} SELECT program_id, signature, slot FROM signatures WHERE NOT failed AND slot % 7 = 0")
def delivered_without_rows(spark, d):
    """A signature that was delivered isn't missing, though it left no rows."""
    s = b.signatures(spark, d)
    return completeness.missing(s, s.where("slot % 7 <> 0").select("program_id", "signature"))


@register(f"WITH {b.SYNC}, {_CURSOR} SELECT cur.* FROM cur JOIN sync USING (program_id) WHERE NOT backfill_complete")
def kept_cursors(spark, d):
    return completeness.kept_cursors(_cursors(spark, d), b.sync(spark, d))


_PUBLIC = ", ".join(f'{x} AS "{c.public_name(x)}"' for x in ("id", "user_pubkey", "role", "active", "permission", "assigned_at_slot", "updated_at_slot", "removal_kind"))


@register(f"WITH {_ROLES} SELECT {_PUBLIC} FROM assignments WHERE NOT active ORDER BY assigned_at_slot DESC, id LIMIT 50 OFFSET 50")
def public_role_assignments(spark, d):
    page = listing.query_numbered("role_assignments", fold.role_assignments_fold(b.actions(spark, d)), page=1, active=False)
    return listing.public(page.select("id", "user_pubkey", "role", "active", "permission", "assigned_at_slot", "updated_at_slot", "removal_kind"))


@register(f"WITH {_ROLES} SELECT * FROM assignments")
def streamed_role_fold(spark, d):
    """The fold over a stream of the same events; its last complete result, through files."""
    import uuid

    from tidelog.sources.store import shared_folder
    from tidelog.streaming.jobs import fold_stream

    schema = b.table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    folder = f"{shared_folder(spark)}/fold-{uuid.uuid4().hex}"
    last = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{number}")
        last[:] = [number]

    query = fold_stream(b.actions_of(stream)).writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/{last[0]}")


# --- payloads in bytes, and what can't be decoded ------------------------------------------------


def _binary_rows(name):
    def run(spark, d):
        return b.plain(payloads.payload_rows(b.binary_updates(spark, d, name), name))

    run.__name__ = f"binary_{name}"
    return register(f"SELECT * EXCLUDE (reason) FROM ({b.binary_rows_sql(name)}) WHERE reason IS NULL")(run)


for _table in payloads.layouts():
    _binary_rows(_table)


#: of four programs, with and without enums, keys that may lack, and bytes of any length
_LAID_OUT = ("config", "role_account", "regions_location", "regions_vote_record", "marketplace_property_asset", "marketplace_lawyer", "property_config", "property_letting")


@register(" UNION ALL ".join(f"SELECT '{t}' AS told, CASE WHEN reason <> 'unknown_kind' THEN '{t}' END AS kind, reason, count(*) AS n FROM ({b.binary_rows_sql(t)}) WHERE reason IS NOT NULL GROUP BY ALL" for t in _LAID_OUT))
def payload_rejects(spark, d):
    """Bytes of eight kinds of account in one pass: why each undecodable one is none."""
    told = lambda t: b.binary_updates(spark, d, t).withColumn("pubkey", F.concat(F.lit(f"{t}/").cast("binary"), F.col("pubkey")))
    rows = told(_LAID_OUT[0])
    for t in _LAID_OUT[1:]:
        rows = rows.unionByName(told(t))
    bad = payloads.payload_rejects(rows).withColumn("told", F.split(F.decode(F.substring("pubkey", 1, 40), "ISO-8859-1"), "/")[0])
    return bad.groupBy("told", "kind", "reason").agg(F.count("*").alias("n"))


def _stored_payloads_sql(t):
    """The newest of a table's decodable updates, closed where a deletion is newer."""
    return f"""SELECT '{t}' AS "table", u.pubkey, CASE WHEN k.slot > u.slot THEN k.slot ELSE u.slot END AS slot, CASE WHEN k.slot > u.slot THEN k.slot END AS closed_at_slot, u.bump
 FROM (SELECT * FROM ({b.binary_rows_sql(t)}) WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY slot DESC, arrival) = 1) u LEFT JOIN gone k USING (pubkey)"""


_GONE_KEYS = f"gone AS (SELECT md5('k' || o_custkey % {b.KEYS}) AS pubkey, CAST(max(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) - 200) AS BIGINT) AS slot FROM orders WHERE o_custkey % {b.KEYS} % 3 = 1 GROUP BY 1)"


@register(f"WITH {_GONE_KEYS} " + " UNION ALL ".join(map(_stored_payloads_sql, ("config", "admin", "role_account"))))
def stored_payloads(spark, d):
    """A program's accounts from their bytes, all tables in one commit; then deletions that name no table."""
    from tidelog.streaming import jobs

    store, tables = _store(spark), ("config", "admin", "role_account")
    rows = b.binary_updates(spark, d, tables[0]).unionByName(b.binary_updates(spark, d, tables[1])).unionByName(b.binary_updates(spark, d, tables[2]))
    jobs.payload_writer(store, registry.program("whitelist"), "accounts")(rows, 0)
    gone = b.table(spark, d, "orders").where(f"o_custkey % {b.KEYS} % 3 = 1").select(F.unhex(F.md5(F.concat(F.lit("k"), (F.col("o_custkey") % b.KEYS).cast("string")))).alias("pubkey"), (F.unix_date(F.to_date("o_orderdate")) - 200).cast("long").alias("slot"))
    jobs.deletion_writer(store, "deletions", list(tables))(gone, 0)
    parts = [store.read(t).select(F.lit(t).alias("table"), c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", "closed_at_slot", "bump") for t in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(f"""WITH x AS (SELECT *, {b.BROKEN} AS reason FROM ({b.account_rows_sql("role_account")})),
 good AS (SELECT pubkey, slot, role FROM x WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY slot DESC, arrival) = 1)
 SELECT pubkey, slot, role, CAST(NULL AS VARCHAR) AS reason FROM good UNION ALL SELECT DISTINCT CASE WHEN reason <> 'missing_key' THEN pubkey END, slot, CASE WHEN reason = 'unknown_kind' THEN 'strange' ELSE 'role_account' END, reason FROM x WHERE reason IS NOT NULL""")
def undecodable_updates(spark, d):
    """Broken payloads, empty ones, unknown kinds and rows without key after good ones: stored rows stay, rejects have their reason."""
    from tidelog.streaming import jobs

    store, rows = _store(spark), b.broken_updates(spark, d, "role_account")
    write = jobs.state_writer(store, "role_account", "accounts")
    write(rows.where("arrival % 7 > 4"), 0)
    write(rows.where("arrival % 7 <= 4").withColumn("slot", F.col("slot")), 1)
    state = store.read("role_account").select(c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", "role", F.lit(None).cast("string").alias("reason"))
    return state.unionByName(store.read("account_rejects").select(c.lower_hex(F.col("pubkey")).alias("pubkey"), "slot", F.col("kind").alias("role"), "reason"))


@register(f"""WITH x AS (SELECT *, {b.BROKEN} AS reason FROM ({b.account_rows_sql("admin")})), held AS (SELECT DISTINCT pubkey FROM ({b.account_rows_sql("admin")})), there AS (SELECT DISTINCT pubkey FROM x WHERE coalesce(reason, '') NOT IN ('unknown_kind', 'missing_key') AND arrival % 2 = 0)
 SELECT (SELECT count(*) FROM x WHERE reason IS NULL AND arrival % 2 = 0) AS loaded, (SELECT count(*) FROM x WHERE reason IS NOT NULL AND arrival % 2 = 0) AS undecodable, (SELECT count(*) FROM held WHERE pubkey NOT IN (SELECT pubkey FROM there)) AS closed_missing, CAST(50000 AS BIGINT) AS snapshot_slot""")
def snapshot_report(spark, d):
    """What a snapshot loaded, skipped and closed, observed while it was written; a second one at a lower slot does nothing."""
    from tidelog.streaming import jobs

    store, program = _store(spark), registry.program("whitelist")
    jobs.seed(store, [program])
    jobs.state_writer(store, "admin", "accounts")(b.account_updates(spark, d, "admin"), 0)
    jobs.load_snapshot(store, program, b.broken_updates(spark, d, "admin").where("arrival % 2 = 0"), 50_000)
    jobs.load_snapshot(store, program, b.account_updates(spark, d, "admin").limit(0), 40_000)
    row = spark.createDataFrame([tuple(jobs.snapshot_counts(store, program).values())], "loaded long, undecodable long, closed_missing long")
    return row.crossJoin(store.read("sync_state").select("snapshot_slot"))


@register("WITH tips AS (SELECT o_orderkey AS n, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS tip FROM orders WHERE o_orderkey <= 6) SELECT CAST(483386556 + max(tip) AS BIGINT) AS last_contiguous_slot, true AS backfill_complete FROM tips")
def lower_tip(spark, d):
    """Tips come from several nodes: one behind the frontier, or behind an earlier one, moves nothing and raises nothing."""
    from tidelog.streaming import jobs

    store, program = _store(spark), registry.program("whitelist")
    jobs.seed(store, [program])
    nothing = spark.createDataFrame([], schemas.table_schema("signatures"))
    jobs.backfill(store, program, nothing, spark.createDataFrame([], schemas.table_schema("transactions")), 10)
    tips = b.table(spark, d, "orders").where("o_orderkey <= 6").select("o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("tip")).orderBy("o_orderkey").collect()  # six rows at most
    for r in tips:
        jobs.reconcile(store, program, nothing, nothing, program.floor + r["tip"])
    return store.read("sync_state").select("last_contiguous_slot", "backfill_complete")


_WALK_FLOOR = 9000


@register(f"""WITH {b.FEED}, own AS (SELECT DISTINCT o_orderkey FROM feed WHERE program = 'property' AND slot >= {_WALK_FLOOR})
 SELECT signature, CAST(path[1] AS SMALLINT) AS ix_index, CAST(path[2] AS SMALLINT) AS inner_index, program_id, slot, ix_name, true AS backfill_complete, CAST(0 AS BIGINT) AS cursors FROM good WHERE o_orderkey IN (SELECT o_orderkey FROM own)""")
def resumed_history(spark, d):
    """A history run that is stopped after a window, fails in the next for want of a transaction, and goes on in a third run."""
    from tidelog.streaming import jobs

    store, program = _store(spark), registry.program("property")
    store.commit("seed", 0, [store.put("sync_state", spark.createDataFrame([(bytearray(program.id), _WALK_FLOOR, False, _WALK_FLOOR)], "program_id binary, last_contiguous_slot long, backfill_complete boolean, backfill_floor_slot long"))])
    # every run and window reads some of these transactions; they are made once
    folder = f"{store.root}/given"
    mapping.touching(b.feed_transactions(spark, d), [program.id]).write.parquet(folder)
    given = spark.read.parquet(folder)
    signatures = given.select(F.lit(program.id).alias("program_id"), "signature", "slot", (F.col("failed") | F.col("vote")).alias("failed"))
    page = max(1, signatures.count() // 4)  # a few windows, whatever the table's size
    jobs.backfill(store, program, signatures, given, page, windows=1)
    try:
        jobs.backfill(store, program, signatures, given.where("slot % 2 = 0"), page)
    except ValueError:  # what is lacking there ends the run before its window is marked
        pass
    jobs.backfill(store, program, signatures, given, page)
    rows = store.read("program_instructions").select(c.lower_hex(F.col("signature")).alias("signature"), "ix_index", "inner_index", c.lower_hex(F.col("program_id")).alias("program_id"), "slot", "ix_name")
    return rows.crossJoin(store.read("sync_state").select("backfill_complete")).crossJoin(store.read("backfill_cursor").agg(F.count("*").alias("cursors")))


@register(f"""WITH n AS (SELECT count(DISTINCT o_custkey % {b.KEYS}) AS n FROM orders)
 SELECT 'failed' AS step, CAST(0 AS BIGINT) AS admins, CAST(0 AS BIGINT) AS roles, CAST(NULL AS VARCHAR) AS mark UNION ALL SELECT 'unverified', 0, 0, NULL UNION ALL SELECT 'whole', n, n, 'done' FROM n UNION ALL SELECT 'replayed', n, n, 'done' FROM n""")
def commit_then_mark(spark, d):
    """A batch with a bad value in its second table, or whose verification says no, shows nothing and marks nothing; its retry shows all."""
    from pyspark.errors import PySparkException

    store = _store(spark)
    both = lambda bad: [store.changed(t, mapping.state_rows(b.account_updates(spark, d, t).where(F.col("kind") == bad(t)), t)) for t in ("admin", "role_account")]
    whole = lambda t: F.lit(t)
    strange = lambda t: c.checked(F.when((F.col("arrival") % 5 == 2) & (F.col("kind") == "role_account"), "strange").otherwise(F.col("kind")), (t,), "kind")
    marks, steps = {"loaded": "done"}, []

    def seen(step):
        rows = store.read("admin").agg(F.count("*").alias("admins")).crossJoin(store.read("role_account").agg(F.count("*").alias("roles")))
        steps.append(rows.select(F.lit(step).alias("step"), "admins", "roles", F.lit(store.marks().get("loaded")).cast("string").alias("mark")))

    try:
        store.commit("accounts", 0, both(strange), marks)
    except PySparkException:
        seen("failed")
    if not store.commit("accounts", 0, both(whole), marks, verify=lambda s: s.read("admin").isEmpty()):
        seen("unverified")
    store.commit("accounts", 0, both(whole), marks)
    seen("whole")
    store.commit("accounts", 0, both(whole), {"loaded": "twice"})
    seen("replayed")
    return reduce(DataFrame.unionByName, steps)


# --- streams with state --------------------------------------------------------------------------


def _as_stream(spark, frames, source):
    """(stream, folder) of frames that come one after the other, each a batch.

    A frame is so many files as ``source``, the table it comes from, has parts (16 at most), so no task has it whole. All have
    the same number, with empty files where there are no rows, so a batch of that many files is one frame.
    """
    import uuid

    from tidelog.sources.store import shared_folder

    folder, width = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}", max(1, min(16, source.rdd.getNumPartitions()))
    for n, f in enumerate(frames):
        f.coalesce(width).write.parquet(f"{folder}/feed/{n}")
        for _ in range(width - len(spark.read.schema(f.schema).parquet(f"{folder}/feed/{n}").inputFiles())):
            f.limit(0).coalesce(1).write.mode("append").parquet(f"{folder}/feed/{n}")
    return lambda session: session.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", width).parquet(f"{folder}/feed/*"), folder


def _by_time(rows, parts=4):
    """The rows in parts of their time, the oldest first."""
    lo, hi = rows.agg(F.unix_timestamp(F.min("ts")), F.unix_timestamp(F.max("ts"))).first()
    part = F.least(F.floor((F.unix_timestamp("ts") - lo) * parts / F.lit(hi - lo + 1)), F.lit(parts - 1))
    return [rows.where(part == k) for k in range(parts)]


_QUIET, _DELAY = 2700, 600


@register(f"""WITH x AS (SELECT event_type || '-' || user_id % 5 AS source, ts FROM events), g AS (SELECT source, lag(ts) OVER (PARTITION BY source ORDER BY ts) AS start, ts AS "end" FROM x)
 SELECT source, CAST(epoch_us(start) AS BIGINT) AS start, CAST(epoch_us("end") AS BIGINT) AS "end" FROM g WHERE "end" >= start + INTERVAL {_QUIET} SECOND
 UNION ALL SELECT source, CAST(epoch_us(max(ts)) AS BIGINT), NULL FROM x GROUP BY source HAVING max(ts) + INTERVAL {_QUIET} SECOND <= (SELECT max(ts) FROM x) - INTERVAL {_DELAY} SECOND""")
def stream_gaps(spark, d):
    """Gaps of sources as a stream finds them: opened by timers while a source is silent, ended by its next row."""
    from tidelog.streaming import jobs, stateful

    e = b.table(spark, d, "events").select(F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("source"), F.col("ts").cast("timestamp").alias("ts"))
    read, folder = _as_stream(spark, _by_time(e), b.table(spark, d, "events"))
    store, session = _store(spark), stateful.with_state_store(spark)
    jobs.run_stream(stateful.gap_stream(read(session), _QUIET, f"{_DELAY} seconds"), stateful.gap_writer(store, "gaps"), f"{folder}/progress", once=True).awaitTermination()
    return store.read("gaps").select("source", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"))


@register(SQL["stream_gaps"])
def gaps(spark, d):
    """The same gaps of the whole table."""
    from tidelog.streaming import stateful

    e = b.table(spark, d, "events").select(F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("source"), F.col("ts").cast("timestamp").alias("ts"))
    return stateful.gaps(e, _QUIET, _DELAY).select("source", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"))


@register(SQL["alert_slot_lag_high"].replace("SELECT 'SlotLagHigh' AS alert, program, start AS t FROM h", "SELECT 'SlotLagHigh' AS alert, CAST(program AS VARCHAR) AS program, start AS t FROM h"))
def streamed_slot_lag_high(spark, d):
    """The lag alert over a stream of lags by minute, with a run's beginning kept from batch to batch."""
    from tidelog.streaming import jobs, stateful

    frontiers, tips = _frontiers(spark, d)
    lags = metrics.lag_is_high(frontiers, tips.withColumn("value", F.col("value") * 200)).select(F.col("program").cast("string").alias("series"), "ts", "on")
    read, folder = _as_stream(spark, _by_time(lags, 3), b.table(spark, d, "events"))
    out = f"{folder}/held"
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
    held = stateful.held_stream(read(stateful.with_state_store(spark)), metrics.LAG_SECONDS, "1 minute")
    jobs.run_stream(held, write, f"{folder}/progress", once=True).awaitTermination()
    rows = spark.read.parquet(out).where("not silent")
    return rows.select(F.lit("SlotLagHigh").alias("alert"), F.col("series").alias("program"), F.unix_timestamp("ts").alias("t"))


@register("""WITH e AS (SELECT event_id, event_type, event_id % 10 AS k FROM events)
 SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type, (SELECT count(*) FROM e) + (SELECT count(*) FROM e WHERE k IN (0, 1)) AS passed FROM e""")
def bounded_dedup(spark, d):
    """Rows that come again soon are dropped in the stream, those that come again late by the store; one that comes first, late, stays."""
    from tidelog.streaming import jobs, stateful

    e = b.table(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"), (F.col("event_id") % 10).alias("k"))
    at = lambda rows, time: rows.withColumn("arrived", F.lit(time).cast("timestamp"))
    frames = [
        at(e.where("k < 4"), "2024-01-01 00:00:00"),
        at(e.where("k between 2 and 5"), "2024-01-01 00:10:00"),  # 2 and 3 again, within the hour
        at(e.where("k = 6"), "2024-01-02 00:00:00"),
        at(e.where("k = 7"), "2024-01-03 00:00:00"),
        at(e.where("k in (0, 1) or k > 7"), "2024-01-04 00:00:00"),  # 0 and 1 again, days later
    ]
    read, folder = _as_stream(spark, frames, b.table(spark, d, "events"))
    store, passed = _store(spark), f"{folder}/passed"

    def write(batch, number):
        batch.select("id").write.mode("overwrite").parquet(f"{passed}/batch={number}")
        rows = batch.select("id", "type", "arrived")
        store.commit("live", number, [store.appended("whitelist_actions", rows.withColumns({c: F.lit(None).cast(t.dataType) for c, t in ((t.name, t) for t in schemas.table_schema("whitelist_actions").fields) if c not in ("id", "type")}).drop("arrived"), F.lit(number))])

    jobs.run_stream(stateful.deduplicated(read(spark), ["id"], "arrived", "1 hour"), write, f"{folder}/progress", once=True).awaitTermination()
    return store.read("whitelist_actions").select("id", "type").crossJoin(spark.read.parquet(passed).agg(F.count("*").alias("passed")))


@register(_newest_sql("marketplace_lawyer"))
def late_updates(spark, d):
    """A stream whose files come newest first: however late a row is, the guard decides and no watermark drops it."""
    from tidelog.streaming import jobs

    u = b.account_updates(spark, d, "marketplace_lawyer")
    read, folder = _as_stream(spark, [u.where("slot >= 9500"), u.where("slot >= 8500 and slot < 9500"), u.where("slot < 8500")], b.table(spark, d, "orders"))
    store = _store(spark)
    jobs.run_stream(read(spark), jobs.state_writer(store, "marketplace_lawyer", "live"), f"{folder}/progress", once=True).awaitTermination()
    return b.plain(store.read("marketplace_lawyer"))


_START_TIP = 9000


@register(f"""WITH x AS (SELECT * FROM ({b.account_rows_sql("admin")}) WHERE slot <> {_START_TIP}), held AS (SELECT * REPLACE (CAST({_START_TIP} AS BIGINT) AS slot) FROM x WHERE slot < {_START_TIP} QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY slot DESC, arrival) = 1)
 SELECT * EXCLUDE (arrival) FROM (SELECT * FROM x WHERE slot > {_START_TIP} UNION ALL SELECT * FROM held) QUALIFY row_number() OVER (PARTITION BY pubkey ORDER BY slot DESC, arrival) = 1""")
def followed_start(spark, d):
    """The stream starts, then the tip is read, then the snapshot is loaded at it: stale stream rows lose, changes during the load win."""
    from tidelog.streaming import jobs

    store, program = _store(spark), registry.program("whitelist")
    jobs.seed(store, [program])
    u = b.account_updates(spark, d, "admin").where(f"slot <> {_START_TIP}")
    read, folder = _as_stream(spark, [u.where(f"slot < {_START_TIP} and arrival % 3 = 0"), u.where(f"slot > {_START_TIP}")], b.table(spark, d, "orders"))
    held = keyed.newest_rows(u.where(f"slot < {_START_TIP}"), ["pubkey"])
    start = lambda: jobs.run_stream(read(spark), jobs.state_writer(store, "admin", "live"), f"{folder}/progress", once=True)
    jobs.follow(start, lambda: _START_TIP, lambda tip: jobs.load_snapshot(store, program, feeds.read_snapshot(held, tip), tip)).awaitTermination()
    return b.plain(store.read("admin"))
