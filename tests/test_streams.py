"""Stateful streams, compaction schedules, bucketed bases, payload layouts and resumed walks in small."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidelog.core import registry, schemas
from tidelog.operators import metrics, payloads
from tidelog.sources.store import Store
from tidelog.streaming import jobs, stateful

from test_store import closing, keys, state

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def feed(spark, path, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return stateful.with_state_store(spark).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


# --- store ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("schedule", [(), (0,), (1, 2), (0, 1, 2, 3)])
def test_any_compaction_schedule_gives_the_same_rows(spark, tmp_path, schedule):
    store = Store(spark, f"file://{tmp_path}/s")
    steps = [("b", 0, [("a", 5), ("b", 5)], []), ("a", 0, [("a", 5), ("c", 1)], [("b", 9)]), ("b", 1, [("b", 9), ("c", 1)], [("a", 7)]), ("a", 1, [("b", 10)], [("c", 3), ("z", 1)])]
    for n, (source, batch, ups, gone) in enumerate(steps):
        closes = closing(spark, *gone) if gone else spark.createDataFrame([], "pubkey binary, slot long")
        store.commit(source, batch, [store.changed("admin", state(ups, spark)), store.routed(closes.withColumn("table", F.lit("admin")))])
        if n in schedule:
            store.compact("admin", buckets=2)
    assert keys(store.read("admin")) == [("a", 7, 7), ("b", 10, None), ("c", 3, 3)]
    assert keys(Store(spark, f"file://{tmp_path}/s").read("admin")) == keys(store.read("admin"))


def test_a_base_is_read_without_an_exchange(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.commit("a", 0, [store.changed("admin", state([(f"k{n}", n) for n in range(50)], spark))])
    store.compact("admin", buckets=4)
    assert "Exchange" not in store.read("admin")._jdf.queryExecution().executedPlan().toString()
    store.commit("a", 1, [store.changed("admin", state([("k3", 99)], spark))])
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = store.read("admin")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep[0])
        spark.conf.set("spark.sql.adaptive.enabled", keep[1])
    scans = [line for line in plan.split("\n") if "default.base_" in line]
    assert scans and all("Bucketed: true" in line for line in scans)
    # the changes are grouped by key; nothing else is shuffled
    above = plan.split("\n")
    base = next(n for n, line in enumerate(above) if "default.base_" in line)
    depth = above[base].index("+-") if "+-" in above[base] else above[base].index(":-")
    parents = []
    for line in reversed(above[:base]):
        indent = min((line.index(x) for x in ("+-", ":-") if x in line), default=0)
        if indent < depth:
            parents.append(line)
            depth = indent
    assert not any("Exchange" in line for line in parents)
    assert ("k3", 99, None) in keys(store.read("admin"))


def test_deletions_are_one_write(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.commit("accounts", 0, [store.changed("admin", state([("a", 1), ("b", 1), ("c", 9)], spark)), store.changed("config", _config(spark, [("a", 2)]))])
    jobs.deletion_writer(store, "deletions", ["admin", "config", "role_account"])(closing(spark, ("a", 5), ("c", 5), ("q", 5)), 0)
    assert keys(store.read("admin")) == [("a", 5, 5), ("b", 1, None), ("c", 9, None)]
    assert keys(store.read("config")) == [("a", 5, 5)]
    assert [c.tables for c in store.commits() if c.source == "deletions"] == [("closes",)]
    # closed in one table, open in another: both take the later slot
    store.commit("accounts", 1, [store.changed("config", _config(spark, [("a", 6)]))])
    jobs.deletion_writer(store, "deletions", ["admin", "config"])(closing(spark, ("a", 8)), 1)
    assert keys(store.read("admin"))[0] == keys(store.read("config"))[0] == ("a", 8, 8)


def _config(spark, rows):
    return spark.createDataFrame([(bytearray(k.encode()), s, 1, bytearray(b"x"), None, 1, 0) for k, s in rows], "pubkey binary, slot long, lamports long, authority binary, pending_authority binary, bump smallint, arrival long")


# --- payloads ------------------------------------------------------------------------------------


def test_layouts_follow_the_accounts():
    known = payloads.layouts()
    assert len(known) == 21 and known["admin"].header == bytes([244, 158, 220, 65, 8, 73, 4, 65])
    assert known["admin"].least == 8 + 32 + 1 and known["config"].least == 8 + 32 + 1 + 1


def test_payloads_of_every_kind_of_field(spark):
    whitelist, regions = registry.program("whitelist").id, registry.program("regions").id
    config, location = payloads.layouts()["config"], payloads.layouts()["regions_location"]
    key = bytes(range(32))
    rows = [
        ("some", whitelist, config.header + key + b"\1" + key + b"\7"),
        ("none", whitelist, config.header + key + b"\0" + b"\7"),
        ("tail", whitelist, config.header + key + b"\0" + b"\7" + b"more"),
        ("tag", whitelist, config.header + key + b"\2" + key + b"\7"),
        ("cut", whitelist, config.header + key + b"\1" + key),
        ("short", whitelist, b"abc"),
        ("other", regions, config.header + key + b"\0" + b"\7"),
        ("place", regions, location.header + b"\x39\5" + b"\3\0\0\0" + b"SW1" + b"\xff" * 8 + b"\1"),
        ("long", regions, location.header + b"\x39\5" + b"\xff\xff\xff\x7f" + b"SW1" + b"\xff" * 8 + b"\1"),
        (None, whitelist, config.header + key + b"\0" + b"\7"),
    ]
    df = spark.createDataFrame([(None if k is None else bytearray(k.encode()), bytearray(o), 1, 2, bytearray(d)) for k, o, d in rows], "pubkey binary, owner binary, slot long, lamports long, data binary")
    got = {bytes(r["pubkey"]).decode(): r for r in payloads.payload_rows(df, "config").collect()}
    assert set(got) == {"some", "none", "tail"} and bytes(got["some"]["pending_authority"]) == key and got["none"]["pending_authority"] is None and got["tail"]["bump"] == 7
    (place,) = payloads.payload_rows(df, "regions_location").collect()
    assert (place["region_id"], bytes(place["postcode"]), place["deposit"], place["bump"]) == (1337, b"SW1", -1, 1)
    bad = {None if r["pubkey"] is None else bytes(r["pubkey"]).decode(): r["reason"] for r in payloads.payload_rejects(df).collect()}
    assert bad == {"tag": "bad_tag", "cut": "too_short", "short": "unknown_kind", "other": "too_short", "long": "too_short", None: "missing_key"}


def test_documents_that_are_none(spark):
    rows = [("good", '{"role": 3, "permission": 0}'), ("broken", "{broken"), ("empty", "{}"), ("text", "no"), ("null", "null"), ("enum", '{"role": 77}'), ("kind", '{"role": "x"}'), ("other", '{"colour": 1}')]
    df = spark.createDataFrame([(bytearray(k.encode()), bytearray(b"o"), 1, 1, "role_account", p, n) for n, (k, p) in enumerate(rows)], schemas.table_schema("account_updates"))
    got = {bytes(r["pubkey"]).decode(): r["reason"] for r in payloads.judged_documents(df, "role_account").collect()}
    assert got == {"good": None, "broken": "broken_payload", "empty": "missing_field", "text": "broken_payload", "null": "broken_payload", "enum": "unknown_enum", "kind": "broken_payload", "other": "missing_field"}


def test_broken_rows_leave_stored_ones_and_are_counted(spark, tmp_path):
    store, p = Store(spark, f"file://{tmp_path}/s"), registry.program("whitelist")
    jobs.seed(store, [p])
    row = lambda key, payload, kind="admin": (bytearray(key.encode()), bytearray(b"o"), 9, 1, kind, payload, 0)
    rows = lambda *r: spark.createDataFrame(list(r), schemas.table_schema("account_updates"))
    write = jobs.state_writer(store, "admin", "live")
    write(rows(row("a", '{"bump": 1}')), 0)
    assert store.marks()["live-undecodable"] == "0"
    write(rows(row("a", "{broken"), row("b", "{}"), row("c", "{}", "nonsense"), row("d", "x", "config")), 1)
    assert [(bytes(r["pubkey"]), r["bump"]) for r in store.read("admin").collect()] == [(b"a", 1)]
    assert sorted((bytes(r["pubkey"]), r["reason"]) for r in store.read("account_rejects").collect()) == [(b"a", "broken_payload"), (b"b", "missing_field"), (b"c", "unknown_kind")]
    assert store.marks()["live-undecodable"] == "3"
    # in a snapshot an undecodable row closes nothing, and is counted
    jobs.load_snapshot(store, p, rows(row("a", "{broken"), row("e", '{"bump": 2}')), 50)
    assert keys(store.read("admin")) == [("a", 9, None), ("e", 50, None)]
    assert jobs.snapshot_counts(store, p) == {"loaded": 1, "undecodable": 1, "closed_missing": 0}
    assert jobs.load_snapshot(store, p, rows(row("z", '{"bump": 2}')), 40).count() == 0 and len(keys(store.read("admin"))) == 2


# --- streams -------------------------------------------------------------------------------------


def test_gaps_open_while_a_source_is_silent(spark, tmp_path):
    schema = "source string, ts timestamp"
    batches = [[("a", at(0)), ("b", at(0)), ("a", at(50))], [("b", at(400))], [("b", at(420))], [("b", at(500)), ("a", at(450))], [("b", at(2000))]]
    stream = feed(spark, f"{tmp_path}/in", batches, schema)
    store = Store(spark, f"file://{tmp_path}/s")
    seen = []

    def keep(batch, number):
        seen.extend((r["source"], r["start"], r["end"]) for r in batch.collect())
        stateful.gap_writer(store, "gaps")(batch, number)

    jobs.run_stream(stateful.gap_stream(stream, 100, "10 seconds"), keep, f"{tmp_path}/cp", once=True).awaitTermination()
    when = lambda s: at(s).astimezone().replace(tzinfo=None)
    assert ("a", when(50), None) in seen  # told before its next row came
    got = sorted((r["source"], r["start"], r["end"]) for r in store.read("gaps").collect())
    assert got == [("a", when(50), when(450)), ("a", when(450), None), ("b", when(0), when(400)), ("b", when(500), when(2000))]
    assert [r["source"] for r in stateful.open_gaps(store).collect()] == ["a"]
    whole = spark.createDataFrame([r for b in batches for r in b], schema)
    assert sorted((r["source"], r["start"], r["end"] is None) for r in stateful.gaps(whole, 100, 10).collect()) == sorted((s, a, e is None) for s, a, e in got)


def test_a_held_condition_fires_once_and_in_silence(spark, tmp_path):
    schema = "series string, ts timestamp, on boolean"
    batches = [[("x", at(0), True), ("x", at(60), True), ("y", at(0), True)], [("x", at(120), True), ("x", at(180), True), ("x", at(240), False)], [("z", at(600), True), ("x", at(600), None)]]
    stream = feed(spark, f"{tmp_path}/in", batches, schema)
    rows = []
    jobs.run_stream(stateful.held_stream(stream, 120, "1 second"), lambda b, n: rows.extend(b.collect()), f"{tmp_path}/cp", once=True).awaitTermination()
    told = sorted((r["series"], int((r["ts"].astimezone(timezone.utc) - T0).total_seconds()), r["first"], r["silent"]) for r in rows)
    assert told == [("x", 120, True, False), ("x", 180, False, False), ("y", 120, True, True)]
    whole = spark.createDataFrame([r for b in batches for r in b], schema).where("on is not null")
    assert metrics.held_for(whole, ["series"], 120).count() == 2


def test_repeats_within_the_delay_go(spark, tmp_path):
    schema = "id string, arrived timestamp"
    stream = feed(spark, f"{tmp_path}/in", [[("a", at(0)), ("a", at(1)), ("b", at(0))], [("a", at(10))], [("c", at(9000))], [("d", at(20_000))], [("a", at(30_000)), ("old", at(30_000))]], schema)
    rows = []
    jobs.run_stream(stateful.deduplicated(stream, ["id"], "arrived", "1 hour"), lambda b, n: rows.extend(r["id"] for r in b.collect()), f"{tmp_path}/cp", once=True).awaitTermination()
    assert sorted(rows) == ["a", "a", "b", "c", "d", "old"]


# --- walks ---------------------------------------------------------------------------------------


def test_a_walk_goes_on_where_it_stopped(spark, tmp_path):
    p = registry.program("whitelist")
    store = Store(spark, f"file://{tmp_path}/s")
    nothing = spark.createDataFrame([], schemas.table_schema("transactions"))
    entries = [(bytearray(p.id), bytearray(bytes([n]) * 64), p.floor - 2 + n // 2, n % 5 == 0) for n in range(12)]
    signatures = spark.createDataFrame(entries, schemas.table_schema("signatures"))
    good = lambda n: ([0], bytearray(p.id), "assign_role", [bytearray([k] * 32) for k in range(5)], '{"role": 1}', None)
    given = spark.createDataFrame([(s, sig, 1, failed, False, [good(0)]) for _, sig, s, failed in entries], schemas.table_schema("transactions"))
    with pytest.raises(ValueError, match="seed it first"):
        jobs.backfill(store, p, signatures, given, 3)
    jobs.seed(store, [p])
    assert jobs.backfill(store, p, signatures, given, 3, windows=1) == {"windows": 1, "expected": 2, "failed": 1}
    (cursor,) = store.read("backfill_cursor").collect()
    assert cursor["slot"] == p.floor + 2 and cursor["signature"] == ("08" * 64 if cursor["signature"].startswith("08") else "09" * 64)
    with pytest.raises(ValueError, match="not delivered"):
        jobs.backfill(store, p, signatures, nothing, 3)
    assert store.read("backfill_cursor").count() == 1 and not store.read("sync_state").collect()[0]["backfill_complete"]
    jobs.backfill(store, p, signatures, given, 3)
    assert store.read("backfill_cursor").count() == 0 and store.read("sync_state").collect()[0]["backfill_complete"]
    want = {bytes(sig) for _, sig, s, failed in entries if s >= p.floor and not failed}
    assert {bytes(r["signature"]) for r in store.read("program_instructions").collect()} == want
    # a complete program is walked again from the top
    assert jobs.backfill(store, p, signatures, given, 100)["expected"] == len(want)
    # a tip that isn't ahead is no news
    jobs.reconcile(store, p, signatures, signatures, p.floor + 9)
    jobs.reconcile(store, p, signatures, signatures, p.floor + 4)
    assert store.read("sync_state").collect()[0]["last_contiguous_slot"] == p.floor + 9


# --- metrics -------------------------------------------------------------------------------------


@pytest.mark.parametrize("shares", [1, 3])
def test_as_of_carries_over_days(spark, shares):
    left = spark.createDataFrame([("a", at(0), 1), ("a", at(5), 2), ("a", at(300_000), 3), (None, at(300_000), 4), ("b", at(9), 5)], "series string, ts timestamp, n int")
    right = spark.createDataFrame([("a", at(1), 1.0), ("a", at(5), 2.0), (None, at(90_000), 3.0), ("b", at(10), 9.0)], "series string, ts timestamp, value double")
    got = {r["n"]: r["value"] for r in metrics.as_of(left, right, ["series"], ["value"], shares=shares).collect()}
    assert got == {1: None, 2: 2.0, 3: 2.0, 4: 3.0, 5: None}
    before = {r["n"]: r["value"] for r in metrics.as_of(left, right, ["series"], ["value"], shares=shares, with_equal=False).collect()}
    assert before[2] == 1.0


def test_quantiles_of_falling_counts(spark):
    rows = spark.createDataFrame([("x", 1.0, 4.0), ("x", 2.0, 3.0), ("x", float("inf"), 8.0), ("none", 1.0, 0.0), ("none", float("inf"), 0.0)], "series string, le double, n double")
    got = {(r["series"], r["q"]): r["value"] for r in metrics.histogram_quantiles(rows, ["series"], (0.25, 0.5, 0.99)).collect()}
    assert got == {("x", 0.25): 0.5, ("x", 0.5): 1.0, ("x", 0.99): 2.0, ("none", 0.25): None, ("none", 0.5): None, ("none", 0.99): None}


def test_streamed_updates_feed_follows_the_table(spark, tmp_path, monkeypatch):
    """The feed has files for each part of the table, all rows of a slot in one, and takes two batches as before."""
    from tidelog.plans import catalog
    from tidelog.sources import feeds
    from tidelog.streaming import jobs

    given, known, batches = "/root/testdata/sf0.001/orders.parquet", {}, []
    read, writer = feeds.read_changes, jobs.state_writer

    def spy(spark, path, table, **more):
        known["feed"] = spark.read.parquet(path)
        return read(spark, path, table, **more)

    def counted(*args, **more):
        write = writer(*args, **more)
        return lambda batch, number: (batches.append(number), write(batch, number))

    monkeypatch.setattr(feeds, "read_changes", spy)
    monkeypatch.setattr(jobs, "state_writer", counted)
    run = lambda d: sorted(map(repr, catalog.QUERIES["streamed_updates"](spark, d).collect()))
    spark.read.parquet(given).repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    parts = spark.read.parquet(f"{tmp_path}/orders.parquet").rdd.getNumPartitions()
    assert parts > 1
    assert run(str(tmp_path)) == run("/root/testdata/sf0.001")
    assert batches == [0, 1, 0, 1]
    run(str(tmp_path))
    of = known["feed"].withColumn("file", F.input_file_name())
    assert of.groupBy("slot").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0
    assert of.select("file").distinct().count() > 3
