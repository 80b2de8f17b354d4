"""The library's operators on the cases of the reference's own tests, and randomized order tests."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.core import enums, registry, schemas
from tidelog.core.order import latest_per_key
from tidelog.functions import columns as c
from tidelog.operators import completeness, fold, keyed, listing, mapping, validate

STATE = "key string, slot long, lamports long, closed_at_slot long"
UPDATE = "key string, slot long, lamports long, arrival long"
CLOSE = "key string, slot long"
ACTION = "id string, type string, subject string, role string, permission string, actor string, slot long, block_time timestamp, tx_signature string, instruction_index string"


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def simulate(state, ops):
    """Row-by-row reference of guarded upserts and closes in the order of arrival."""
    state = dict(state)
    for kind, key, slot, value in ops:
        if kind == "up" and (key not in state or state[key][0] < slot):
            state[key] = slot, value, None
        if kind == "close" and key in state and state[key][0] < slot:
            state[key] = slot, state[key][1], slot
    return sorted((k, *v) for k, v in state.items())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], STATE)


def test_guard_keeps_the_newer_slot(spark, empty):
    first = keyed.slot_guarded_upsert(empty, spark.createDataFrame([("a", 200, 1000, 0)], UPDATE), ["key"])
    second = keyed.slot_guarded_upsert(first, spark.createDataFrame([("a", 100, 5, 1)], UPDATE), ["key"])
    equal = keyed.slot_guarded_upsert(second, spark.createDataFrame([("a", 200, 7, 2)], UPDATE), ["key"])
    assert rows(first) == rows(second) == rows(equal) == [("a", 200, 1000, None)]


def test_close_and_recreate(spark, empty):
    def up(state, slot):
        return keyed.slot_guarded_upsert(state, spark.createDataFrame([("a", slot, slot, 0)], UPDATE), ["key"])

    def close(state, slot, key="a"):
        return keyed.soft_close(state, spark.createDataFrame([(key, slot)], CLOSE), ["key"])

    s = close(up(empty, 100), 200)
    assert rows(s) == [("a", 200, 100, 200)]
    s = up(close(s, 150), 150)
    assert rows(s) == [("a", 200, 100, 200)]
    assert rows(up(s, 300)) == [("a", 300, 300, None)]
    assert rows(close(up(empty, 100), 100)) == [("a", 100, 100, None)]  # one slot: open until the sweep
    assert rows(close(empty, 100)) == [] and rows(close(s, 900, "b")) == rows(s)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_equals_one_by_one(spark, seed):
    rng = random.Random(seed)
    stored = {f"k{i}": (rng.randint(1, 9), i, None) for i in range(6)}
    ups = [("up", f"k{rng.randint(0, 11)}", rng.randint(1, 20), n) for n in range(40)]
    closes = [("close", f"k{rng.randint(0, 13)}", rng.randint(1, 25), None) for _ in range(20)]
    state = spark.createDataFrame([(k, *v) for k, v in stored.items()], STATE)
    shuffled = [(k, s, v, n) for n, (_, k, s, v) in enumerate(ups)]
    rng.shuffle(shuffled)
    got = keyed.apply_batch(state, spark.createDataFrame(shuffled, UPDATE), spark.createDataFrame([(k, s) for _, k, s, _ in closes], CLOSE), ["key"])
    assert rows(got) == simulate(stored, ups + closes)


def test_conditional_close(spark):
    schema = "key string, slot long, closed_at_slot long, locations array<struct<postcode:string,deposit:long>>"
    state = spark.createDataFrame([("two", 100, None, [("M11AE", 1), ("SW1", 1)]), ("one", 100, None, [("M11AE", 1)]), ("other", 100, None, [("SW1A1AA", 1)])], schema)
    gone = lambda slot: spark.createDataFrame([(k, "M11AE", slot) for k in ("two", "one", "other")], "key string, postcode string, slot long")
    assert rows(keyed.close_if_last(state, gone(50), ["key"]), "key", "closed_at_slot") == [("one", None), ("other", None), ("two", None)]
    assert rows(keyed.close_if_last(state, gone(150), ["key"]), "key", "slot", "closed_at_slot") == [("one", 150, 150), ("other", 100, None), ("two", 100, None)]


def test_sweep_and_open_keys(spark):
    state = spark.createDataFrame([("live", 5, 0, None), ("gone", 5, 0, None), ("new", 50, 0, None), ("closed", 5, 0, 5)], STATE)
    live = spark.createDataFrame([("live",), ("fresh",)], "key string")
    swept = keyed.close_missing(state, live, 20, ["key"])
    assert rows(swept) == [("closed", 5, 0, 5), ("gone", 20, 0, 20), ("live", 5, 0, None), ("new", 50, 0, None)]
    assert rows(keyed.open_keys({"t": swept}, ["key"])) == [("t", "live"), ("t", "new")]
    assert rows(keyed.snapshot_summary(state, live, live, 20, ["key"])) == [(2, 2, 1)]


def test_append_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", 3, "z")], "key string, arrival long, v string")
    once = keyed.append_dedup(df, ["key"], "arrival")
    assert rows(once, "key", "v") == [("a", "y"), ("b", "z")]
    assert keyed.append_new(once, df, ["key"], "arrival").count() == 0


# --- folds ---------------------------------------------------------------------------------------


def act(n, kind, slot, subject="u", role=None, permission=None, actor="boss"):
    from datetime import datetime, timezone

    return (str(n), kind, subject, role, permission, actor, slot, datetime.fromtimestamp(1_700_000_000 + slot, timezone.utc), f"tx{n}", "0")


def both_orders(spark, actions):
    return spark.createDataFrame(actions, ACTION), spark.createDataFrame(actions[::-1], ACTION)


def test_admin_fold(spark):
    for df in both_orders(spark, [act(1, "ADMIN_ADDED", 10), act(2, "ADMIN_REMOVED", 20)]):
        assert rows(fold.admins_fold(df), "id", "active", "removed_at_slot") == [("u", False, 20)]
    for df in both_orders(spark, [act(1, "ADMIN_ADDED", 10), act(2, "ADMIN_REMOVED", 20), act(3, "ADMIN_ADDED", 30), act(4, "ADMIN_REMOVED", 5, "nobody")]):
        assert rows(fold.admins_fold(df), "id", "active", "added_at_slot", "removed_at_slot") == [("u", True, 30, None)]


def test_role_fold(spark):
    a = act(1, "ROLE_ASSIGNED", 10, role="LAWYER")
    for df in both_orders(spark, [a, act(2, "PERMISSION_UPDATED", 20, role="LAWYER", permission="REVOKED"), act(3, "ROLE_REMOVED", 30, role="LAWYER", actor="x")]):
        assert rows(fold.role_assignments_fold(df), "id", "active", "permission", "removal_kind", "removed_by", "updated_at_slot", "rent_payer") == [("u-3", False, "REVOKED", "REMOVED", "x", 30, "boss")]
    assert rows(fold.role_assignments_fold(spark.createDataFrame([a], ACTION)), "active", "permission") == [(True, "COMPLIANT")]
    for df in both_orders(spark, [a, act(2, "ROLE_RENOUNCED", 20, role="LAWYER", actor="u"), act(9, "PERMISSION_UPDATED", 5, role="LAWYER", permission="REVOKED")]):
        assert rows(fold.role_assignments_fold(df), "active", "permission", "removal_kind", "removed_by") == [(False, "COMPLIANT", "RENOUNCED", "u")]


def test_path_breaks_ties(spark):
    a = list(act(1, "ADMIN_ADDED", 10))
    b = list(act(2, "ADMIN_REMOVED", 10))
    a[8] = b[8] = "tx"
    a[9], b[9] = "3", "10"
    assert rows(fold.admins_fold(spark.createDataFrame([tuple(a), tuple(b)], ACTION)), "active") == [(False,)]
    a[9], b[9] = "3.1", "3"
    assert rows(fold.admins_fold(spark.createDataFrame([tuple(a), tuple(b)], ACTION)), "active") == [(True,)]


def test_config_fold(spark):
    config = spark.createDataFrame([("auth", None)], "authority string, pending_authority string")
    df = lambda *a: spark.createDataFrame(list(a), ACTION)
    first = act(1, "CONFIG_INITIALIZED", 5)
    assert rows(fold.config_fold(config, df(first)), "authority", "updated_at_slot") == [("auth", 5)]
    assert rows(fold.config_fold(config, df(first, act(2, "AUTHORITY_UPDATE_PROPOSED", 15))), "authority", "updated_at_slot") == [("auth", 15)]
    with pytest.raises(Exception, match="no action"):
        listing.config_view(fold.config_fold(config, df())).collect()


def test_violations(spark):
    df = spark.createDataFrame([act(1, "ADMIN_REMOVED", 1), act(2, "ROLE_REMOVED", 1, role="LAWYER"), act(3, "AUTHORITY_UPDATED", 1), act(4, "ROLE_ASSIGNED", 2, role="ODD")], ACTION)
    assert rows(fold.fold_violations(df)) == [("1", "admin_not_added"), ("2", "role_not_assigned"), ("3", "no_config"), ("4", "unknown_role")]


def test_latest_per_key_order_does_not_matter(spark):
    rng = random.Random(4)
    actions = [act(n, "X", rng.randint(1, 5), subject=f"s{n % 3}") for n in range(30)]
    shuffled = actions[:]
    rng.shuffle(shuffled)
    assert rows(latest_per_key(spark.createDataFrame(actions, ACTION), ["subject"])) == rows(latest_per_key(spark.createDataFrame(shuffled, ACTION), ["subject"]))


# --- page plans and frontiers --------------------------------------------------------------------


@pytest.mark.parametrize(
    ("entries", "floor", "size", "want"),
    [
        ([300, 200], 100, 10, [(2, 0, None, None, "HistoryExhausted")]),
        ([500, 400, 300, 200], 100, 3, [(3, 0, 4, 3, None), (1, 0, None, None, "HistoryExhausted")]),
        ([120, 110, 100, 99, 98], 100, 10, [(3, 0, 4, None, "ReachedFloor")]),
        ([50, 40], 100, 10, [(0, 0, 1, None, "ReachedFloor")]),
        ([300, -250, 200], 100, 10, [(2, 1, None, None, "HistoryExhausted")]),
        ([500, 400, -300, 200], 100, 3, [(2, 1, 4, 3, None), (1, 0, None, None, "HistoryExhausted")]),
        ([500, 400, 300, 50], 100, 3, [(3, 0, 4, None, "ReachedFloor")]),
        ([500, 400, 300], 100, 3, [(3, 0, None, None, "HistoryExhausted")]),
    ],
)
def test_page_plan(spark, entries, floor, size, want):
    df = spark.createDataFrame([(1, f"s{n}", abs(s), s < 0) for n, s in enumerate(entries, 1)], "program_id int, signature string, slot long, failed boolean")
    got = [(r["n_expected"], r["n_failed"], r["until"] and int(r["until"][1:]), r["next_cursor"] and int(r["next_cursor"][1:]), r["stop"]) for r in completeness.plan_pages(df, floor, size, width=7).orderBy("page").collect()]
    assert got == want
    assert completeness.plan_pages(df.limit(0), floor, size).count() == 0


def test_frontier(spark):
    schema = "program_id int, last_contiguous_slot long, backfill_complete boolean, backfill_floor_slot long, snapshot_slot long"
    sync = spark.createDataFrame([(1, 10, True, 5, None), (2, 10, False, 5, None), (3, 10, True, 5, None), (4, 90, True, 5, None)], schema)
    tips = spark.createDataFrame([(p, 50) for p in (1, 2, 3, 4)], "program_id int, slot long")
    lacking = spark.createDataFrame([(3, "s", 40), (1, "s", 60)], "program_id int, signature string, slot long")
    assert rows(completeness.advance_frontier(sync, tips, lacking), "program_id", "last_contiguous_slot") == [(1, 50), (2, 10), (3, 10), (4, 90)]
    walks = spark.createDataFrame([(1, 9), (2, 6), (3, 5)], "program_id int, floor_used long")
    assert rows(completeness.finish_backfill(sync.withColumn("backfill_complete", F.lit(False)), walks), "program_id", "backfill_complete") == [(1, False), (2, False), (3, True), (4, False)]
    events = spark.createDataFrame([(1, 1, "walk_done"), (1, 2, "complete"), (2, 1, "walk_done"), (2, 2, "complete"), (2, 3, "session_end"), (3, 1, "walk_done")], "program_id int, seq long, kind string")
    assert rows(completeness.gap_state(events)) == [(1, False, True), (2, True, False), (3, False, False)]


# --- mapping -------------------------------------------------------------------------------------


def test_payload_fields(spark):
    df = spark.createDataFrame([(bytearray.fromhex("ffae7db4cb9bca8303"),), (bytearray.fromhex("c3a90100ffffffffffffffff"),), (bytearray(b""),)], "data binary")
    got = df.select(c.spelled(c.little_endian(F.col("data"), 8, 1), enums.ROLE), c.little_endian(F.col("data"), 0, 4), c.little_endian(F.col("data"), 4, 8), c.lossy_text(F.col("data"))).collect()
    assert got[0][0] == "LAWYER" and got[1][1] == 0x0001A9C3 and got[1][2] == -1 and got[2][1] is None and "�" in got[0][3]


def test_paths(spark):
    df = spark.createDataFrame([([3],), ([3, 1],), ([3, 1, 2],)], "path array<int>")
    outer, inner = c.path_indexes(F.col("path"))
    got = [tuple(r) for r in df.select(c.dotted(F.col("path")), outer, inner, c.row_id(F.lit("s"), outer, inner)).collect()]
    assert got == [("3", 3, -1, "s-3"), ("3.1", 3, 1, "s-3.1"), ("3.1.2", 3, 1, "s-3.1")]


def test_enum_check(spark):
    with pytest.raises(Exception, match="unknown role"):
        spark.createDataFrame([("NOPE",)], "r string").select(c.checked(F.col("r"), enums.ROLE, "role")).collect()
    with pytest.raises(ValueError, match="32 bytes"):
        c.key_argument("ab")
    assert c.key_argument("ab" * 32) == b"\xab" * 32


def test_registry(spark):
    tables = registry.all_tables()
    assert len(tables) == len(set(tables)) == 24 and {p.name for p in registry.programs()} == {"whitelist", "regions", "marketplace", "property"}
    rules = [r for p in registry.programs() for r in p.close_rules]
    assert len(rules) == 26 and len({(p.name, r[0]) for p in registry.programs() for r in p.close_rules}) == 22
    for t in tables:
        assert schemas.table_schema(t).fieldNames()[:4] == ["pubkey", "slot", "lamports", "closed_at_slot"]
    with pytest.raises(ValueError, match="another program"):
        registry.register_program("other", registry.program("regions").id, 0, {"x": "a int"})
    with pytest.raises(ValueError, match="tables of another"):
        registry.register_program("other", b"1", 0, {"admin": "a int"})
    for table, column in schemas.CHECKS:
        assert column in schemas.table_schema(table).fieldNames()


def test_registered_for_a_block():
    before = registry.programs()
    with pytest.raises(KeyError), registry.registered("fifth", b"5", 0, {"fifth_item": "value int"}):
        assert registry.program("fifth").tables == ("fifth_item",)
        raise KeyError
    with registry.registered("regions", b"6", 0, {"regions_location": "value int"}):
        assert registry.program("regions").id == b"6"
    assert {p.name: p for p in registry.programs()} == {p.name: p for p in before}
    with pytest.raises(ValueError, match="another program"), registry.registered("sixth", before[0].id, 0, {}):
        pass
    assert {p.name: p for p in registry.programs()} == {p.name: p for p in before}


def test_time_origins(spark):
    from tidelog.sources.feeds import time_dimension

    rows = spark.createDataFrame([("own", 1, 10), ("cached", 1, None), ("looked", 2, None), ("none", 3, None), ("no slot", None, None), ("own, no slot", None, 7)], "id string, slot long, block_time long")
    looked_up = spark.createDataFrame([(1, 99), (2, 20), (2, None), (None, 5)], "slot long, block_time long")
    good, bad = mapping.with_block_time(rows, time_dimension(rows, looked_up))
    assert {tuple(r) for r in good.select("id", "block_time", "time_origin").collect()} == {("own", 10, "hint"), ("cached", 10, "cached"), ("looked", 20, "looked_up"), ("own, no slot", 7, "hint")}
    assert {(r["id"], r["time_origin"], r["reason"]) for r in bad.collect()} == {("none", None, "no_block_time"), ("no slot", None, "no_block_time")}
    assert time_dimension(rows.limit(0), looked_up.limit(0)).collect() == []


def transaction(spark, signature=b"\x07" * 64, name="assign_role", args='{"role": 3}', n=5, path=(3, 1), failed=False):
    p = registry.program("whitelist").id
    accounts = [bytearray([k] * 32) for k in range(n)]
    return spark.createDataFrame([(9, bytearray(signature), 1_700_000_009, failed, False, [(list(path), bytearray(p), name, accounts, args, None), (list(path), bytearray(p), "cpi_event", accounts, None, None), ([0], bytearray(b"x"), "assign_role", accounts, args, None)])], schemas.table_schema("transactions"))


def test_actions_and_closes(spark):
    programs, rules, closing = registry.program_dimension(spark), registry.action_rule_table(spark), registry.close_rule_table(spark)
    i = mapping.instructions(mapping.succeeded(transaction(spark)), programs)
    assert i.count() == 1 and mapping.succeeded(transaction(spark, failed=True)).count() == 0
    got, bad = mapping.actions(i, rules)
    r = got.collect()[0]
    assert (r["type"], r["subject"], r["role"], r["actor"], r["instruction_index"], bad.count()) == ("ROLE_ASSIGNED", "02" * 32, "LAWYER", "00" * 32, "3.1", 0)
    assert r["id"] == "07" * 64 + "-3.1"
    short, bad = mapping.actions(mapping.instructions(transaction(spark, n=2), programs), rules)
    assert short.count() == 0 and rows(bad, "reason") == [("missing_account",)]
    r = mapping.actions(mapping.instructions(transaction(spark, name="remove_admin", args='{"admin_key": "abc"}'), programs), rules)[0].collect()[0]
    assert (r["type"], r["subject"], r["role"]) == ("ADMIN_REMOVED", "abc", None)
    closed, _ = mapping.closes(mapping.instructions(transaction(spark, name="remove_role"), programs), closing)
    assert [(x["table"], bytes(x["pubkey"])) for x in closed.collect()] == [("role_account", b"\x04" * 32)]
    assert rows(mapping.actions(mapping.instructions(transaction(spark, path=()), programs), rules)[1], "reason") == [("empty_absolute_path",)]


def test_state_rows(spark):
    payload = '{"listing_id": 4, "status": 2, "developer_lawyer": {"lawyer": "AAE=", "costs": 5, "doc_status": 1, "documents_hash": "AA=="}, "spv_election": {"expiry": 9, "candidate_count": 1, "round": 2}, "collected": [{"mint": "m", "funds": 1, "fee": 2, "tax": 3}]}'
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b"o"), 5, 7, "marketplace_listing", payload, 0), (bytearray(b"k"), bytearray(b"o"), 5, 7, "admin", "{}", 0)], schemas.table_schema("account_updates"))
    r = mapping.state_rows(df, "marketplace_listing").collect()
    assert len(r) == 1 and (r[0]["status"], r[0]["developer_lawyer_doc_status"], r[0]["developer_lawyer_costs"], r[0]["spv_election_round"], r[0]["collected"][0]["fee"], r[0]["spv_lawyer"]) == ("SOLD_OUT", "APPROVED", 5, 2, 2, None)
    for t in registry.all_tables():
        assert mapping.state_rows(df, t).columns == [*schemas.table_schema(t).fieldNames(), "arrival"]


def test_block_time_is_never_invented(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, None)], "slot long, block_time long")
    good, bad = mapping.with_block_time(df, spark.createDataFrame([(1, 99), (2, 20)], "slot long, block_time long"))
    assert rows(good, "slot", "block_time") == [(1, 10), (2, 20)] and rows(bad, "slot", "reason") == [(3, "no_block_time")]


def test_rejects(spark):
    df = spark.createDataFrame([([1], 3, "{}"), ([], 3, "{}"), ([1], 2, "{}"), ([1], 3, "{")], "path array<int>, n int, args string").withColumn("accounts", F.sequence(F.lit(1), F.col("n")))
    reason = validate.instruction_reason(F.col("path"), F.col("accounts"), F.lit(2), F.col("args"))
    assert [r[0] for r in df.select(reason).collect()] == [None, "empty_absolute_path", "missing_account", "serialize"]


# --- listings ------------------------------------------------------------------------------------


def test_paging():
    assert [listing.clamp_page(f, o) for f, o in ((None, None), (100_000, 50_000), (-3, -1), (0, 5))] == [(20, 0), (100, 10_000), (0, 0), (0, 5)]
    assert listing.numbered_page(None, None) == (50, 0) and listing.numbered_page(3, 9999) == (500, 1500)


def test_older_queries(spark):
    with pytest.raises(ValueError, match="missing argument: role"):
        listing.role_assignment(spark.createDataFrame([], "user_pubkey string, role string"), "u", "")
    versions = spark.createDataFrame([("k", 5, 1, None, None), ("k", 3, 1, None, 5)], "pubkey string, slot long, region_id int, closed_at_slot long, valid_to long")
    assert rows(listing.query_numbered("locations", versions, region_id=1, active=True), "slot") == [(5,)]
    assert listing.public(versions).columns == ["pubkey", "slot", "regionId", "closedAtSlot", "validTo"]


def test_every_listing(spark):
    for name, spec in listing.LISTINGS.items():
        if spec.table.endswith("_view"):
            continue
        df = spark.createDataFrame([], schemas.table_schema(spec.table))
        page, total = listing.query(name, df, active=None if spec.table in schemas.LOG_TABLES else True, **dict.fromkeys(spec.filters))
        assert page.columns == df.columns and rows(total) == [(0,)]
    with pytest.raises(ValueError, match="no filter"):
        listing.query("lawyers", spark.createDataFrame([], schemas.table_schema("marketplace_lawyer")), owner=1)


def test_status(spark):
    schema = "program_id int, last_contiguous_slot long, backfill_complete boolean, backfill_floor_slot long, snapshot_slot long"
    sync = spark.createDataFrame([(1, 10, True, 0, 4), (2, 7, False, 0, None)], schema)
    assert rows(listing.sync_status(sync, 5)) == [(7, False, None, 5, 0)]
    assert rows(listing.sync_status(sync.where("program_id = 1"), 25)) == [(10, True, 4, 25, 15)]
    with pytest.raises(Exception, match="no sync state"):
        listing.sync_status(sync.limit(0), 5).collect()
    assert rows(listing.health(sync.limit(0), None)) == [(None, False, None, None)]
    assert rows(listing.check_access(fold.role_assignments_fold(spark.createDataFrame([], ACTION)), "u", "LAWYER")) == [(False, False)]


def test_a_filter_does_not_repeat_the_parsing(spark):
    """Payloads are parsed once a row, though a filter and the columns both need what comes out."""
    from tidelog.operators import mapping, payloads
    from tidelog.plans import bridges

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows = mapping.state_rows(bridges.account_updates(spark, "/root/testdata/sf0.001", "marketplace_listing"), "marketplace_listing")
    assert plan(rows).count("from_json(") == 1
    given = spark.createDataFrame([], "pubkey binary, owner binary, slot long, lamports long, data binary")
    assert "regexp_replace" not in plan(payloads.payload_rows(given, "config"))


def test_lines_of_the_feed_travel_as_numbers(spark):
    """No exchange of the feed has the accounts or arguments of an instruction in it."""
    from tidelog.plans import bridges

    feed = bridges.feed_transactions(spark, "/root/testdata/sf0.001")
    assert "to_json" not in feed._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)[1]


def test_newest_rows_are_found_from_numbers(spark):
    from tidelog.operators import keyed

    u = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 5, "y"), ("a", 2, 3, "z"), (None, 1, 1, "n"), ("b", None, 1, "m")], "k string, slot long, arrival long, v string")
    rows = keyed.newest_rows(u, ["k"])
    assert sorted(r["v"] for r in rows.collect()) == ["m", "n", "z"]
    assert "SortAggregate" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_frame_of_a_stream_is_not_one_task(spark):
    """Each frame has as many files as its source has parts, with empty ones where rows lack, so a batch is a frame."""
    from tidelog.plans import catalog

    source = spark.range(0, 12, 1, 3)
    read, folder = catalog._as_stream(spark, [source.where("id < 6"), source.where("id >= 6")], source)
    assert [len(spark.read.schema("id long").parquet(f"{folder}/feed/{n}").inputFiles()) for n in (0, 1)] == [3, 3]
    seen = []
    read(spark).writeStream.foreachBatch(lambda b, n: seen.append(sorted(r["id"] for r in b.collect()))).option("checkpointLocation", f"{folder}/p").trigger(availableNow=True).start().awaitTermination()
    assert seen == [list(range(6)), list(range(6, 12))]
