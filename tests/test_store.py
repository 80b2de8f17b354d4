"""The versioned store and the streaming jobs against their batch forms."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.core import schemas
from tidelog.operators import fold, mapping
from tidelog.sources.feeds import counter_samples, read_changes, read_history, read_snapshot, slot_times
from tidelog.sources.store import Store
from tidelog.streaming import jobs

from test_library import transaction


def state(rows, spark):
    df = spark.createDataFrame([(bytearray(k.encode()), s, 1, bytearray(b"a"), 0, n) for n, (k, s) in enumerate(rows)], "pubkey binary, slot long, lamports long, admin binary, bump smallint, arrival long")
    return df


def keys(df):
    return sorted((bytes(r["pubkey"]).decode(), r["slot"], r["closed_at_slot"]) for r in df.collect())


def closing(spark, *rows):
    return spark.createDataFrame([(bytearray(k.encode()), s) for k, s in rows], "pubkey binary, slot long")


def test_commits_are_exactly_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    assert store.commit("live", 0, [store.changed("admin", state([("a", 1), ("b", 2), ("c", 3)], spark))])
    assert store.commit("live", 1, [store.changed("admin", state([("a", 5), ("b", 1)], spark), closing(spark, ("c", 9), ("z", 9)))])
    want = [("a", 5, None), ("b", 2, None), ("c", 9, 9)]
    assert keys(store.read("admin")) == want
    assert not store.commit("live", 1, [store.changed("admin", state([("a", 99)], spark))])
    with pytest.raises(ValueError, match="comes after"):
        store.commit("live", -5, [store.changed("admin", state([("a", 99)], spark))])
    with pytest.raises(ValueError, match="source's name"):
        store.commit("a/b", 0, [])
    store.compact("admin")
    again = Store(spark, f"file://{tmp_path}/s")
    assert keys(again.read("admin")) == want and not again.commit("live", 1, [again.changed("admin", state([("a", 99)], spark))])
    assert again.commit("live", 2, [again.changed("admin", state([("c", 10)], spark))])
    assert keys(again.read("admin")) == [("a", 5, None), ("b", 2, None), ("c", 10, None)]


def test_sources_count_for_themselves(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    for source, key in (("live", "a"), ("history", "b"), ("snapshot", "c")):
        assert store.commit(source, 0, [store.changed("admin", state([(key, 1)], spark))])
    other = Store(spark, f"file://{tmp_path}/s")  # a second driver that saw the store before
    assert store.commit("live", 1, [store.changed("admin", state([("a", 2)], spark))]) and other.commit("history", 1, [other.changed("admin", state([("b", 3)], spark))])
    assert keys(store.read("admin")) == keys(other.read("admin")) == [("a", 2, None), ("b", 3, None), ("c", 1, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_apply_one_after_the_other(spark, tmp_path, seed):
    import random

    from test_library import simulate

    rng = random.Random(seed)
    store, ops = Store(spark, f"file://{tmp_path}/s"), []
    for n in range(5):
        ups = [(f"k{rng.randint(0, 4)}", rng.randint(1, 30)) for _ in range(4)]
        gone = [(f"k{rng.randint(0, 5)}", rng.randint(1, 30)) for _ in range(3)]
        store.commit("live", n, [store.changed("admin", state(ups, spark), closing(spark, *gone))])
        ops += [("up", k, s, None) for k, s in ups] + [("close", k, s, None) for k, s in gone]
        if n == 2:
            store.compact("admin")
    assert keys(store.read("admin")) == [(k, s, c) for k, s, _, c in simulate({}, ops)]


def test_append_ignores_replays(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    write, other = jobs.transaction_writer(store, "live"), jobs.transaction_writer(store, "history")
    for n in range(2):
        write(transaction(spark), n)
    other(transaction(spark), 0)
    assert store.read("program_instructions").count() == store.read("whitelist_actions").count() == 1
    write(transaction(spark, signature=b"\x08" * 64), 2)
    assert store.read("whitelist_actions").count() == 2


def test_closes_come_with_their_instruction(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    key = bytearray(b"\x04" * 32)
    rows = spark.createDataFrame([(key, bytearray(b"o"), 5, 1, "role_account", '{"role": 3}', 0)], schemas.table_schema("account_updates"))
    jobs.state_writer(store, "role_account", "accounts")(rows, 0)
    jobs.transaction_writer(store, "live")(transaction(spark, name="remove_role"), 0)  # at slot 9, of account 4
    got = store.read("role_account").collect()
    assert [(bytes(r["pubkey"]), r["slot"], r["closed_at_slot"], r["role"]) for r in got] == [(bytes(key), 9, 9, "LAWYER")]
    assert store.read("whitelist_actions").count() == store.read("program_instructions").count() == 1


def test_conditional_close_needs_the_last_location(spark, tmp_path):
    from tidelog.core import registry

    for held, gone, slot, closed in ((["M11AE", "SW1"], "M11AE", 150, None), (["M11AE"], "M11AE", 50, None), (["M11AE"], "M11AE", 150, 150), (["SW1A1AA"], "M11AE", 150, None)):
        store = Store(spark, f"file://{tmp_path}/{len(list(tmp_path.iterdir()))}")
        payload = json.dumps({"locations": [{"postcode": p, "assigned_count": 0, "deposit": 1} for p in held]})
        jobs.state_writer(store, "property_letting_agent", "accounts")(spark.createDataFrame([(bytearray(b"\x02" * 32), bytearray(b"o"), 100, 1, "property_letting_agent", payload, 0)], schemas.table_schema("account_updates")), 0)
        instruction = ([0], bytearray(registry.program("property").id), "remove_letting_agent", [bytearray([k] * 32) for k in range(4)], json.dumps({"postcode": gone}), None)
        jobs.transaction_writer(store, "live")(spark.createDataFrame([(slot, bytearray(b"s" * 64), 1, False, False, [instruction])], schemas.table_schema("transactions")), 0)
        assert [r["closed_at_slot"] for r in store.read("property_letting_agent").collect()] == [closed]


def test_bad_instructions_are_kept_as_rejects(spark, tmp_path):
    from tidelog.core import registry

    p, accounts = bytearray(registry.program("whitelist").id), [bytearray([k] * 32) for k in range(5)]
    good = lambda at: (at, p, "assign_role", accounts, '{"role": 1}', None)
    feed = [
        (1, b"a", 1, [good([0]), ([1], p, "assign_role", None, '{"role": 1}', None), good([2])]),
        (2, b"b", 1, [good([0]), (None, p, "assign_role", accounts, '{"role": 1}', None)]),
        (3, b"c", 1, [good([0]), ([0, 1], p, "assign_role", accounts, '{"role"', None), good([0, 2])]),
        (4, b"d", None, [good([0])]),
        (5, b"e", 1, [good([0])]),
    ]
    rows = [(s, bytearray(g * 64), t, False, False, x) for s, g, t, x in feed]
    store = Store(spark, f"file://{tmp_path}/s")
    jobs.transaction_writer(store, "live")(spark.createDataFrame(rows, schemas.table_schema("transactions")), 0)
    assert sorted((r["slot"], r["instruction_index"], r["reason"]) for r in store.read("rejects").collect()) == [(1, "1", "missing_account"), (2, "", "empty_absolute_path"), (3, "0.1", "serialize"), (4, "0", "no_block_time")]
    assert sorted(r["slot"] for r in store.read("whitelist_actions").collect()) == sorted(r["slot"] for r in store.read("program_instructions").collect()) == [1, 3, 5]


def test_marks_come_with_their_rows(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    change = lambda: [store.changed("admin", state([("a", 1)], spark))]
    assert not store.commit("snapshot", 0, change(), {"snapshot": "1"}, lambda s: s.read("admin").count() == 2)
    assert store.marks() == {} and store.read("admin").count() == 0
    broken = [("admin", store.changed("admin", state([("b", 1)], spark))[1].withColumn("closed_at_slot", F.raise_error(F.lit("lost")).cast("long")))]
    with pytest.raises(Exception, match="lost"):
        store.commit("snapshot", 0, broken, {"snapshot": "1"})
    assert store.marks() == {} and store.read("admin").count() == 0
    assert store.commit("snapshot", 0, change(), {"snapshot": "1"}, lambda s: s.read("admin").count() == 1)
    assert store.marks() == {"snapshot": "1"} and keys(store.read("admin")) == [("a", 1, None)]


def test_jobs_of_a_program(spark, tmp_path):
    from tidelog.core import registry

    p = registry.program("whitelist")
    store = Store(spark, f"file://{tmp_path}/s")
    jobs.seed(store, [p])
    sync = lambda: [(r["last_contiguous_slot"], r["backfill_complete"], r["snapshot_slot"]) for r in store.read("sync_state").collect()]
    assert sync() == [(p.floor, False, None)]
    jobs.seed(store, registry.programs())
    assert store.read("sync_state").count() == 4
    store2 = Store(spark, f"file://{tmp_path}/t")
    jobs.seed(store2, [p])
    updates = lambda *ks: spark.createDataFrame([(bytearray(k.encode()), bytearray(b"o"), 0, 1, "admin", '{"bump": 1}', n) for n, k in enumerate(ks)], schemas.table_schema("account_updates"))
    assert {tuple(r) for r in jobs.load_snapshot(store2, p, updates("a", "b"), 50).collect()} == {("config", 0, 0), ("admin", 2, 0), ("role_account", 0, 0)}
    assert ("admin", 1, 1) in {tuple(r) for r in jobs.load_snapshot(store2, p, updates("a"), 60).collect()}
    assert keys(store2.read("admin")) == [("a", 60, None), ("b", 60, 60)] and store2.read("sync_state").collect()[0]["snapshot_slot"] == 60
    feed = transaction(spark)
    signatures = spark.createDataFrame([(bytearray(p.id), bytearray(b"\x07" * 64), 9, False)], schemas.table_schema("signatures"))
    jobs.load_history(store2, p, signatures, feed, 5, 20, 0)
    assert store2.read("program_instructions").count() == 1 and store2.read("sync_state").collect()[0]["backfill_complete"] and store2.read("backfill_cursor").count() == 0
    more = signatures.withColumn("signature", F.lit(bytearray(b"q" * 64))).unionByName(signatures)
    with pytest.raises(ValueError, match="not delivered"):
        jobs.load_history(store2, p, more, feed, 5, 20, 1)
    tip = p.floor + 7
    jobs.reconcile(store2, p, signatures, feed.select(F.lit(bytearray(p.id)).alias("program_id"), "signature"), tip)
    assert store2.read("sync_state").collect()[0]["last_contiguous_slot"] == tip
    late = signatures.withColumn("signature", F.lit(bytearray(b"r" * 64))).withColumn("slot", F.lit(tip + 1).cast("long"))
    jobs.reconcile(store2, p, late, signatures.select("program_id", "signature"), tip + 5)
    assert store2.read("sync_state").collect()[0]["last_contiguous_slot"] == tip
    order = []
    assert jobs.follow(lambda: order.append("stream") or "q", lambda: order.append("tip") or 3, lambda slot: order.append(slot)) == "q" and order == ["stream", "tip", 3]


def test_a_partial_walk_keeps_its_cursor(spark, tmp_path):
    from tidelog.core import registry

    p = registry.program("whitelist")
    store = Store(spark, f"file://{tmp_path}/s")
    jobs.seed(store, [p])
    at = p.floor + 10
    feed = transaction(spark).withColumn("slot", F.lit(at).cast("long"))
    signatures = spark.createDataFrame([(bytearray(p.id), bytearray(b"\x07" * 64), at, False)], schemas.table_schema("signatures"))
    jobs.load_history(store, p, signatures, feed, p.floor + 5, at, 0)
    assert [(r["signature"], r["slot"]) for r in store.read("backfill_cursor").collect()] == [("07" * 64, at)] and not store.read("sync_state").collect()[0]["backfill_complete"]


def test_deletions_close_on_every_table(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.commit("accounts", 0, [store.changed("admin", state([("a", 1), ("b", 1)], spark))])
    jobs.deletion_writer(store, "deletions", ["admin", "config"])(closing(spark, ("a", 5), ("q", 5)), 0)
    assert keys(store.read("admin")) == [("a", 5, 5), ("b", 1, None)] and store.read("config").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = [(bytearray(f"k{n % 7}".encode()), bytearray(b"o"), n * 37 % 50, n, "admin", json.dumps({"bump": n}) if n % 4 else None, n) for n in range(40)]
    feed = spark.createDataFrame(rows, schemas.table_schema("account_updates"))
    feed.repartition(5).write.parquet(f"{tmp_path}/in")
    one = Store(spark, f"file://{tmp_path}/one")
    jobs.state_writer(one, "admin", "batch")(feed, 0)
    many = Store(spark, f"file://{tmp_path}/many")
    stream = read_changes(spark, f"{tmp_path}/in", "account_updates")
    jobs.run_stream(stream, jobs.state_writer(many, "admin", "live"), f"{tmp_path}/cp", once=True).awaitTermination()
    assert keys(one.read("admin")) == keys(many.read("admin"))
    again = jobs.run_stream(stream, jobs.state_writer(many, "admin", "live"), f"{tmp_path}/cp", once=True)
    again.awaitTermination()
    assert keys(one.read("admin")) == keys(many.read("admin"))


def test_streamed_fold(spark, tmp_path):
    df = mapping.actions(*_instructions(spark))[0].withColumn("block_time", F.lit(None).cast("timestamp"))
    df.write.parquet(f"{tmp_path}/a")
    q = jobs.fold_stream(read_changes(spark, f"{tmp_path}/a", "whitelist_actions")).writeStream.format("memory").queryName("roles").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("roles").collect() == fold.role_assignments_fold(df).collect()


def _instructions(spark):
    from tidelog.core import registry

    return mapping.instructions(transaction(spark), registry.program_dimension(spark)), registry.action_rule_table(spark)


def test_metric_samples(spark):
    from tidelog.operators import metrics

    events = spark.createDataFrame([("2024-01-01 00:00:01", "a", "x"), ("2024-01-01 00:00:02", "a", "y"), ("2024-01-01 00:00:03", "b", "x")], "t string, program string, reason string").withColumn("t", F.col("t").cast("timestamp"))
    samples = counter_samples(events, "skipped", "t", ["program", "reason"])
    assert samples.columns == [f.name for f in schemas.table_schema("metric_samples")]
    up = samples.select("ts", "value", F.col("labels")["program"].alias("program"))
    assert [tuple(r) for r in metrics.lowest(up, ["program"], "1 minute").orderBy("program").select("program", "lowest").collect()] == [("a", 1.0), ("b", 1.0)]
    totals = spark.createDataFrame([(10, 5.0), (20, 7.0), (30, 2.0), (40, 3.0)], "s long, value double").select(F.timestamp_seconds("s").alias("ts"), "value", F.lit("m").alias("series"))
    assert [r["increase"] for r in metrics.increase(totals, ["series"], "1 hour").collect()] == [5.0]  # 2, a reset to 2, 1
    assert [r["changes"] for r in metrics.changes(totals, ["series"], "1 hour").collect()] == [3]
    buckets = metrics.bucketize(totals, ["series"], [2.0, 5.0])
    assert sorted((r["le"], r["n"]) for r in buckets.collect()) == [(2.0, 1), (5.0, 3), (float("inf"), 4)]
    assert [r["value"] for r in metrics.histogram_quantile(buckets, ["series"], 0.5).collect()] == [3.5]
    assert [r["value"] for r in metrics.histogram_quantile(buckets, ["series"], 0.99).collect()] == [5.0]


def test_feeds(spark):
    t = transaction(spark)
    assert read_history(t, 0, 9).count() == 1 and read_history(t, 10, 20).count() == 0
    assert [tuple(r) for r in slot_times(t).collect()] == [(9, 1_700_000_009)]
    assert read_snapshot(t, 77).select("slot").collect()[0][0] == 77
    deletions = spark.createDataFrame([(bytearray(b"a"), 1), (bytearray(b"q"), 1)], schemas.table_schema("account_deletions"))
    held = state([("a", 1)], spark).withColumn("closed_at_slot", F.lit(None).cast("long"))
    assert jobs.tracked_deletions(deletions, {"admin": held}).count() == 1
    assert jobs.close_rows(transaction(spark, name="remove_role")).count() == 1
