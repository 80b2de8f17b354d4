"""The corpus operators against brute force on small tables with odd rows."""

import hashlib
import html as html_lib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "é", "ung", "ción", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    """Plain, copied, nearly copied, repeated, empty, null and long texts."""
    rng = random.Random(3)
    rows = [sentence(rng, rng.randint(3, 200)) for _ in range(40)]
    passage = sentence(rng, 30)
    for k in range(12):
        words = rows[k].split(" ")
        if len(words) > 20:
            words[rng.randrange(len(words))] = "changed"
        rows.append(" ".join(words))
        rows.append(rows[k])
        rows.append(sentence(rng, 40) + " " + passage + "\n" + sentence(rng, 20))
    rows += ["", None, "one", "One", "a b c", " \t\n", "a b c a b c a b c " * 30, "# $ %\nline\nline\n\n \nline", "été " * 300, sentence(rng, 6000), None, ""]
    return [(k * 3 + 1, x, ["en", None, "fr"][k % 3], f"s{k % 4}", len(x or "")) for k, x in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    got = df.collect()
    out = {r["doc_id"]: r.asDict() for r in got}
    assert len(out) == len(got)
    return out


def tokens(text):
    return WORD.findall((text or "").translate(LOWER))


# --- near duplicates ---------------------------------------------------------------------------


def shingle_set(text):
    w = tokens(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    sets = {i: shingle_set(x) for i, x, *_ in rows}
    texts = {i: x or "" for i, x, *_ in rows}
    linked = {i: [j for j in sets if i != j and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in sets}
    out = {}
    for i in sets:
        seen, queue = {i}, [i]
        while queue:
            for j in linked[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        out[i] = min(seen), len({texts[j] for j in linked[i]} - {texts[i]}), len(linked[i])
    return out


@pytest.mark.parametrize(("bucket", "chunk"), [(4096, 256), (2, 2)])
def test_jaccard_join(docs, rows, bucket, chunk):
    from tidelog.llm.near_duplicates import jaccard_join

    got = by_id(jaccard_join(docs, bucket=bucket, chunk=chunk))
    assert {i: (r["class_id"], r["n_links"], r["n_linked_docs"]) for i, r in got.items()} == brute_classes(rows)


def test_jaccard_join_of_nothing(nothing):
    from tidelog.llm.near_duplicates import jaccard_join, keep_one

    assert jaccard_join(nothing).count() == 0
    assert keep_one(nothing).columns == nothing.columns


def test_runs_reach_the_recall():
    from tidelog.llm.near_duplicates import runs_for

    assert runs_for(0.999, 1) < runs_for(0.999, 3) <= 16


def test_ids_may_be_missing_or_repeated(spark):
    from tidelog.llm.near_duplicates import jaccard_join, keep_one

    rng = random.Random(12)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    near = a + " and then some more"
    rows = [(1, a, "x", None, 1), (1, a, "x", None, 2), (1, b, "x", None, 3), (None, near, "x", None, 4), (None, c, "x", None, 5), (None, c, "x", None, 6), (None, None, "x", None, 7), (None, "", "x", None, 8), (9, a, "x", None, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in jaccard_join(df).collect())
    want = Counter({(1, 1, 1, 3): 2, (1, 1, 0, 0): 1, (None, 1, 1, 3): 1, (None, None, 0, 1): 2, (None, None, 0, 0): 2, (9, 1, 1, 3): 1})
    assert got == want
    kept = sorted(r["n_chars"] for r in keep_one(df).collect())
    assert kept in ([1, 3, 5, 7, 8], [1, 3, 6, 7, 8], [2, 3, 5, 7, 8], [2, 3, 6, 7, 8])  # one row of each class


@pytest.mark.parametrize("chunk", [3, 64])
def test_bands_of_sizes_lose_no_link(spark, chunk):
    """Prefixes of one text: a chain of links through all sizes, all in one candidate group or a few."""
    from tidelog.llm.near_duplicates import jaccard_join

    rng = random.Random(13)
    words = sentence(rng, 400).split()
    rows = [(k, " ".join(words[: 40 + 9 * k]), None, None, 0) for k in range(40)]
    got = by_id(jaccard_join(spark.createDataFrame(rows, SCHEMA), bucket=8, chunk=chunk))
    size = {k: 36 + 9 * k for k in range(40)}
    want = {k: sum(5 * min(size[k], size[j]) >= 4 * max(size[k], size[j]) for j in size if j != k) for k in size}
    assert {k: r["n_links"] for k, r in got.items()} == want


def test_keep_one(docs, rows):
    from tidelog.llm.near_duplicates import keep_one

    assert {r["doc_id"] for r in keep_one(docs).collect()} == {c for c, *_ in brute_classes(rows).values()}


def exchanges(df):
    return len(re.findall(r"^[\s:+*()\d-]*Exchange ", df._jdf.queryExecution().executedPlan().toString(), re.M))


def test_components_deal_links_out_twice_a_round(spark, monkeypatch):
    """Each shuffle leaves files for every task until the driver collects its garbage; a run of rounds must not be many of them."""
    from tidelog.llm import _text
    from tidelog.llm.components import components

    seen, cut = [], _text.checkpoint
    monkeypatch.setattr(_text, "checkpoint", lambda df: seen.append(exchanges(df)) or cut(df))
    rng = random.Random(14)
    order = rng.sample(range(1000, 1300), 300)
    links = list(zip(order, order[1:], strict=False))
    links += [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(200)]
    links += [(b, a) for a, b in links[:50]] + links[:50] + [(5000, 5000)] + [(9000, k) for k in range(6000, 6500)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    name = {x: x for a, b in links if a != b for x in (a, b)}
    while any(name[a] != name[b] for a, b in links if a != b):
        for a, b in links:
            if a != b:
                name[a] = name[b] = min(name[a], name[b])
    assert Counter(map(tuple, got)) == Counter(name.items())
    assert len(seen) > 3 and max(seen) <= 2


def test_keep_one_reads_no_links(spark, rows):
    """Of the documents only those to be kept are looked up; links and signatures aren't joined for it."""
    from tidelog.llm.near_duplicates import keep_one

    assert exchanges(keep_one(spark.createDataFrame(rows, SCHEMA))) <= 6


# --- language model ----------------------------------------------------------------------------


def test_language_model(docs, rows, nothing):
    from tidelog.llm.language_model import score_texts

    got = by_id(score_texts(docs, burn_in=1, samples=2))
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows}
    ends = {i: [*tokens(x), None] for i, x, *_ in rows}
    count = Counter(w for i, ws in ends.items() if not held[i] for w in ws)
    total, kinds = sum(count.values()), len(count)
    for i, ws in ends.items():
        r = got[i]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(count[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
    assert score_texts(nothing).count() == 0


def test_held_out_texts_score_better_than_the_base(spark):
    from tidelog.llm.language_model import score_texts

    rng = random.Random(8)
    words = [sentence(rng, 1)[:3] + str(k) for k in range(30)]

    def walk(n):  # the next word mostly follows from the last
        k, out = 0, []
        for _ in range(n):
            k = (k + 1) % 30 if rng.random() < 0.9 else rng.randrange(30)
            out.append(words[k])
        return " ".join(out)

    docs = spark.createDataFrame([(k, walk(100)) for k in range(300)], "doc_id long, text string")
    held = [r for r in score_texts(docs).collect() if r["held_out"]]
    assert len(held) > 20 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_predictive_sums_to_one():
    from tidelog.llm import language_model as m

    rng = np.random.default_rng(1)
    level = m._Level(np.arange(256, dtype=np.uint64), 1)
    level.count = rng.integers(0, 50, 256)
    uniform = np.full(256, 1 / 256)
    level.tables = np.minimum(level.count, 1)
    for _ in range(5):
        level.reseat(uniform, 0.7, rng)
        assert ((level.tables >= np.minimum(level.count, 1)) & (level.tables <= level.count)).all()
        assert level.predictive(uniform, 0.7).sum() == pytest.approx(1)


def test_seating_follows_the_restaurant_rule():
    """Mean tables after seating against the exact mean of a one-dish restaurant."""
    from tidelog.llm import language_model as m

    n, d = 20_000, 0.6
    for c in (2, 5, 60):
        got = m._seat(np.full(n, c), np.zeros(n, np.int64), np.ones(n), d, np.random.default_rng(2)).mean()
        want = 1.0
        for k in range(1, c):
            want += (m.STRENGTH + d * want) / (k + m.STRENGTH)
        assert got == pytest.approx(want, rel=0.04)


# --- sharding ----------------------------------------------------------------------------------


def test_sharding(docs, rows, nothing):
    from tidelog.llm.sharding import shard

    got = by_id(shard(docs, 5))
    size = {i: len((x or "").encode()) + 8 for i, x, *_ in rows}
    assert {i: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for i, r in got.items()} == {i: (size[i], zlib.crc32((x or "").encode()), "bytes", None) for i, x, *_ in rows}
    total = Counter()
    slots = {}
    for i, r in got.items():
        total[r["shard"]] += size[i]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(total) == set(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) <= 2 * max(size.values())
    assert shard(nothing).count() == 0


def test_shards_are_near_equal(spark):
    from pyspark.sql import functions as F

    from tidelog.llm.sharding import shard

    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.repeat(F.lit("x"), (F.col("id") % 200).cast("int"))).alias("text"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("n_chars"))
    total = [r["sum(size)"] for r in shard(df).groupBy("shard").sum("size").collect()]
    assert len(total) == 24 and max(total) < 1.1 * min(total)


def brute_tree(items, targets, first=0):
    """The leaf of each item (weight, positions, tie) by plain recursion over sorted lists."""
    from tidelog.llm.sharding import DIMENSIONS

    n = len(targets)
    if n == 1 or not items:
        return {i["h"]: first for i in items}
    spread = {d: max(i[d] for i in items) - min(i[d] for i in items) for d in DIMENSIONS}
    d = max(DIMENSIONS, key=lambda d: (spread[d], -DIMENSIONS.index(d)))
    items = sorted(items, key=lambda i: (i[d], i["tie"]))
    want = sum(i["weight"] for i in items) * (sum(targets[: n // 2]) / sum(targets) if sum(targets) else (n // 2) / n)
    before, at = 0, len(items)
    for k, i in enumerate(items):
        if before + i["weight"] > want:
            at = k + (before + i["weight"] - want < want - before)
            break
        before += i["weight"]
    return brute_tree(items[:at], targets[: n // 2], first) | brute_tree(items[at:], targets[n // 2 :], first + n // 2)


@pytest.mark.parametrize("targets", [[1.0] * 7, [5.0, 0.0, 1.0, 2.0, 2.0], [1.0] * 24])
def test_tree_against_recursion(docs, targets):
    from tidelog.llm import sharding as s

    items = s._items(s._narrow(docs)).cache()
    want = brute_tree([r.asDict() for r in items.collect()], targets)
    assert {r["h"]: r["node"] for r in s._placed(items, targets).collect()} == want


def test_heavy_groups_fill_the_emptiest_shards():
    from tidelog.llm.sharding import _deal

    where, left = _deal([(("a",), 90), (("b",), 30), (("c",), 20)], 60, 4)
    assert where == {("a",): 0, ("b",): 1, ("c",): 2} and left == pytest.approx([0.0, 110 / 3 - 30, 110 / 3 - 20, 110 / 3])
    assert _deal([], 12, 3)[1] == [4.0] * 3


def test_equal_texts_share_a_shard(spark):
    from tidelog.llm.sharding import shard

    rng = random.Random(9)
    texts = [sentence(rng, rng.randint(1, 30)) for _ in range(150)]
    rows = [(k, rng.choice(texts), rng.choice("ab"), rng.choice("xyz"), 0) for k in range(600)] + [(None, texts[0], None, None, None), (None, None, None, None, None)]
    got = shard(spark.createDataFrame(rows, SCHEMA), 6).collect()
    by, total = {}, Counter()
    for r in got:
        by.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        total[r["shard"]] += r["size"]
    assert len(got) == len(rows) and all(len(x) == 1 for x in by.values())
    assert max(total.values()) < 1.1 * min(total.values())
    # a third of all bytes in one text: too much for a shard, the others stay together
    many = [(k, texts[0] if k % 3 == 0 else texts[k % 150], "a", "x", 0) for k in range(3000)]
    held = {}
    total = Counter()
    for r in shard(spark.createDataFrame(many, SCHEMA), 6).collect():
        held.setdefault(r["text_crc32"], set()).add(r["shard"])
        total[r["shard"]] += r["size"]
    assert sum(len(x) > 1 for x in held.values()) <= 1 and max(total.values()) < 1.15 * min(total.values())


# --- suffix-array dedup ------------------------------------------------------------------------


def brute_repeats(rows, n=50):
    first = {}
    texts = {i: (x or "").encode() for i, x, *_ in rows}
    for i in sorted(texts):
        for k in range(len(texts[i]) - n + 1):
            first.setdefault(texts[i][k : k + n], i)
    out = {}
    for i, x in texts.items():
        gone = bytearray(len(x))
        for k in range(len(x) - n + 1):
            if first[x[k : k + n]] < i:
                gone[k : k + n] = b"\1" * n
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[i] = len(x), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(x, gone, strict=True) if not g)).hexdigest()
    return out


@pytest.mark.parametrize("block", [1 << 23, 20_000])
def test_suffix_dedup(docs, rows, nothing, block):
    from tidelog.llm.substrings import repeated_bytes

    got = by_id(repeated_bytes(docs, block_bytes=block))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute_repeats(rows)
    assert repeated_bytes(nothing).count() == 0


def test_cut_repeats(docs, rows):
    from tidelog.llm.substrings import cut_repeats

    want = brute_repeats(rows)
    got = cut_repeats(docs, block_bytes=20_000).collect()
    assert len(got) == len(rows)
    for r in got:
        n, gone, _, _ = want[r["doc_id"]]
        assert n - gone - 2 * want[r["doc_id"]][2] * 4 <= len((r["text"] or "").encode()) <= n - gone


def common_line(n):
    """Documents that share one line, each with other text around it."""
    rng = random.Random(17)
    line = "this line of sixty and some bytes is common to all documents here"
    return [(k, f"{rng.random()} {sentence(rng, 12)} {rng.random()}\n{line}\n{rng.random()} {sentence(rng, 12)}", None, None, 0) for k in range(n)]


def test_a_hot_anchor_is_dealt_out():
    import pyarrow as pa
    import pyarrow.compute as pc

    from tidelog.llm import substrings as s

    rows, buckets = common_line(400), 16
    blocks = [pa.table({"doc_id": [r[0] for r in rows[k::4]], "text": [r[1] for r in rows[k::4]], s.BLOCK: [k] * 100}) for k in range(4)]
    none = pa.table([pa.array([], x) for x in s._ANSWER_TYPES], ["block", "kind", "blob"])
    sent = pa.concat_tables([s._send(buckets)(b, none) for b in blocks])
    met = pa.concat_tables([s._meet(sent.filter(pc.equal(sent["bucket"], k))) for k in set(sent["bucket"].to_pylist())])
    held = Counter()
    for k, b in enumerate(blocks):
        for r in s._passages(buckets)(b, met.filter(pc.equal(met["block"], k))).to_pylist():
            held[r["bucket"]] += len(r["name"]) + len(r["doc"]) + len(r["data"])
    assert 0 < max(held.values()) < sum(held.values()) / 10


@pytest.mark.parametrize("block", [20_000, 1 << 22])
def test_repeats_around_a_hot_anchor(spark, block):
    from tidelog.llm.substrings import repeated_bytes

    rows = common_line(300)
    want = brute_repeats(rows)
    assert sum(x[1] for x in want.values()) >= 299 * 60
    got = by_id(repeated_bytes(spark.createDataFrame(rows, SCHEMA), block_bytes=block))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def test_anchor_buckets_are_even():
    import pyarrow as pa

    from tidelog.llm import substrings as s

    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 123, 200_000))) for _ in range(20)]
    a = s._Anchors(pa.table({"doc_id": list(range(20)), "text": texts}))
    own = np.arange(len(a.at))
    for buckets in (64, 1024, 4096):
        held = np.bincount(a.bucket(own, buckets), minlength=buckets)
        mean = held.mean()
        assert held.max() < mean + 6 * mean**0.5 + 2  # as even as random dealing: within twice the mean from 36 a bucket on
    many = np.bincount(a.bucket(own, 1 << 16), minlength=1 << 16)
    assert (many > 0).sum() > 0.95 * (1 - np.exp(-many.mean())) * (1 << 16)  # no bucket is out of reach


def test_documents_without_an_id_keep_all(spark):
    from tidelog.llm.substrings import cut_repeats, repeated_bytes

    line = "a passage of more than fifty bytes that several documents share " * 2
    df = spark.createDataFrame([(1, line, "en", None, 1), (None, line, "en", None, 2), (2, line, "en", None, 3), (None, None, "en", None, 4), (None, line, "en", None, 5)], SCHEMA)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in repeated_bytes(df).collect()), key=repr)
    assert got == [(1, 128, 0), (2, 128, 128), (None, 0, 0), (None, 128, 0), (None, 128, 0)]
    assert {r["n_chars"]: r["text"] for r in cut_repeats(df).collect()} == {1: line, 2: line, 3: "", 4: None, 5: line}


def test_suffix_array_against_sorting():
    from tidelog.llm.suffixes import common_prefixes, suffix_array

    rng = np.random.default_rng(4)
    for letters in (1, 2, 5):
        x = rng.integers(1, letters + 1, 300).astype(np.uint8)
        x[::37] = 0
        text = np.concatenate((x, np.zeros(64, np.uint8)))
        used = np.arange(len(text)) < 300
        got = suffix_array(text, used | (np.arange(len(text)) == 300), 56)
        got = got[got < 300]
        raw = text.tobytes()
        keys = [raw[i:].split(b"\0")[0][:56] for i in got]
        assert keys == sorted(keys) and sorted(got) == list(range(300))
        for a, b, n in zip(got, got[1:], common_prefixes(text, got, 56), strict=False):
            p, q = raw[a : a + 56], raw[b : b + 56]
            assert n == next((k for k in range(56) if p[k] != q[k]), 56)


# --- license scans -----------------------------------------------------------------------------


def test_license_scan(spark, docs, rows):
    from tidelog.llm.licenses import rules, scan

    assert len(rules()) > 200
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    extra = [(900, "All Rights  Reserved. CC-BY and cc by; General Public License", None, None, 0), (901, "Released under the MIT License.", None, None, 0), (902, "Licensed under the Apache License, Version 2.0. all rights reserved", None, None, 0), (903, "licensed under cc by-nc 4.0", None, None, 0)]
    got = by_id(scan(docs.unionByName(spark.createDataFrame(extra, SCHEMA))))
    for i, x, *_ in rows + extra:
        w = words.findall((x or "").translate(LOWER))
        places = [(k, label) for p, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")) for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(sorted({b for _, b in places})))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] < 1
    assert got[901]["labels"] == "mit" and got[902]["labels"] == "apache-2.0,reserved" and got[903]["labels"] == "cc-by,cc-by-nc-4.0"
    assert got[901]["score"] > 0 and got[1]["score"] == 0


SIGNED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
 of this software and associated documentation files (the "Software"), to deal""",
    "bsd": """// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are
// met:""",
    "bsd-3-clause": "Neither the name of Google Inc. nor the names of its\n * contributors may be used to endorse or promote products derived from\n * this software",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "zlib": "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    "apache-2.0": '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.",
    "gnu-gpl-2.0": "under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of the License",
    "gnu-lgpl-2.1": "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1",
    "cc-by-sa-4.0": "see https://creativecommons.org/licenses/by-sa/4.0/ for it",
    "cc0-1.0": "http://creativecommons.org/publicdomain/zero/1.0/",
    "gnu-gpl-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
    "bsd-2-clause": '"license": "BSD-2-Clause"',
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "openssl": "This product includes software developed by the OpenSSL Project\n for use in the OpenSSL Toolkit.",
    "commercial": "Unauthorized copying of this file, via any medium, is strictly prohibited",
    "alle-rechte": "Alle Rechte vorbehalten.",
    "open-access": "This is an open access article distributed under the terms of the Creative Commons Attribution License",
}


@pytest.mark.parametrize("label", list(SIGNED))
def test_signatures(label):
    from tidelog.llm.licenses import detect

    assert label in {d.label for d in detect(f"some text before. {SIGNED[label]} and after".lower())}
    assert detect("nothing of the kind, only a permit for a general of the public") == []


def test_scan_against_all_rules_and_all_pairs():
    """Without keywords, and with every detection compared to every other."""
    from tidelog.llm.licenses import detect, rules

    rng = random.Random(31)
    parts = [x.lower() for x in SIGNED.values()] + ["gpl v3", "licensed under the mit license", "cc by-nc-sa 4.0", "apache 2.0 license", "copyright (c) 1999", "public domain", "bsd-style license", "words between."]
    for _ in range(60):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        every = {k for r in rules() for k in r.keywords} | {"licen", "license", "spdx-license", "reserved"}
        whole = detect(text, every)
        assert detect(text) == whole
        for d in whole:
            assert not any(o.start <= d.start and d.end <= o.end and (o.priority > d.priority or o.priority == d.priority and o != d) for o in whole)


@pytest.mark.parametrize("seed", range(5))
def test_suppression_against_pairs(seed):
    from tidelog.llm.licenses import Detection, suppressed

    rng = random.Random(seed)
    found = [Detection(s := rng.randint(0, 40), s + rng.randint(1, 15), rng.choice("abc"), rng.choice([10, 20, 30])) for _ in range(rng.randint(0, 60))]
    want: list = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
        if not any(k.start <= d.start and d.end <= k.end for k in want):
            want.append(d)
    assert suppressed(found) == sorted(want)


def test_a_very_long_text_of_names(spark):
    import time

    from tidelog.llm.licenses import detect, scan

    text = "licensed under the gnu general public license, version 3. mit license and cc by-sa 4.0; " * 12_000  # a megabyte
    began = time.time()
    assert len(detect(text)) == 36_000 and time.time() - began < 20
    odd = spark.createDataFrame([(None, "mit license", "x"), (5, None, "y"), (5, "", "z")], "doc_id long, text string, labels string")
    assert sorted((tuple(r) for r in scan(odd).select("doc_id", "labels", "n_words").collect()), key=repr) == [(5, "", 0), (5, "", 0), (None, "mit", 2)]
    assert scan(odd.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("it is gplv3 code", {"gnu-gpl-3.0"}),
        ("it is lgplv2.1+ code", {"gnu-lgpl-2.1"}),
        ("gpl3 and mpl2.0", {"gnu-gpl-3.0", "mpl-2.0"}),
        ("see the LICENSE file", {"see-license"}),
        ("See the file COPYING", {"see-license"}),
        ("see LICENSE.md", {"see-license"}),
        ("see the accompanying license for details", {"see-license"}),
        ("dual licensed MIT/Apache-2.0", {"dual", "mit", "apache-2.0"}),
        ("dual-licensed under the Apache License, Version 2.0 or MIT", {"dual", "mit", "apache-2.0"}),
        ("gplv3x cc01 fooagpl3 see the file and see for it", set()),
    ],
)
def test_short_forms(text, labels):
    from tidelog.llm.licenses import detect

    assert {d.label for d in detect(text.lower())} == labels


def test_contained_detections_are_suppressed():
    from tidelog.llm.licenses import detect

    assert [d[2] for d in detect("licensed under the gnu general public license, version 3. mit license")] == ["gnu-gpl-3.0", "mit"]


# --- quality -----------------------------------------------------------------------------------


def test_quality(spark, docs, rows, nothing):
    from tidelog.llm.quality import keep_good, quality_scores

    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in rows[:20]] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    got = by_id(quality_scores(docs, labels))
    for i, x, *_ in rows:
        w = WORD.findall(x or "")
        three = Counter(zip(w, w[1:], w[2:], strict=False))
        repeat = {k + j for k in range(len(w) - 2) if three[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [y for y in (x or "").split("\n") if WORD.search(y)]
        want = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x or ""), len(lines) - len(set(lines)), len(repeat)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] <= (not r["base_failed"])
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}
    assert quality_scores(nothing, labels).count() == 0
    assert {r["score"] for r in quality_scores(docs, labels.limit(0)).collect()} == {0.0}


def test_quality_trusts_every_label(spark):
    """The label that comes last by its id's hash counts, however many there are."""
    from pyspark.sql import functions as F

    from tidelog.llm.quality import quality_scores

    labels = spark.range(20_002).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    last = labels.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    docs = spark.createDataFrame([(last, "calm river stones " * 30), (-1, "loud metal noise " * 30)], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in quality_scores(docs, labels).collect()}
    assert scores[last] > 0 > scores[-1]


def test_quality_moves_ids_not_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tidelog.llm import quality

    written = lambda: sum(e.totalShuffleWrite() for e in [spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0)])
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.sha2(F.concat_ws("-", "id", k.cast("string")), 256)), " ")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), words.alias("text")).unionByName(spark.createDataFrame([(None, "an odd text")], "doc_id long, text string"))
    labels = spark.range(0, 3000, 3).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        at = written()
        ratio, least = quality.log_ratio(docs, labels)
        assert written() - at < 2_500_000  # the trusted texts have 3.9 MB
        assert quality._trusted_docs(docs, labels)[1] is None
        monkeypatch.setattr(quality, "BITS", quality.PIECE)  # so few bits that trusted and other ids share some
        sure, rest = quality._trusted_docs(docs, labels)
        assert 0 < rest.count() < 1000
        again, same = quality.log_ratio(docs, labels)
        assert (again == ratio).all() and same == least
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quality_tells_junk(spark):
    from tidelog.llm.quality import quality_scores

    rng = random.Random(5)
    good = [(k, sentence(rng, 600), None, None, 0) for k in range(500)]
    bad = [(1000 + k, " ".join(f"{w}{rng.choice(['###', '$$$'])}" for w in sentence(rng, 600).split()), None, None, 0) for k in range(30)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(300)], "doc_id long, quality int, toxic int")
    got = by_id(quality_scores(spark.createDataFrame(good + bad, SCHEMA), labels))
    assert all(r["kept"] == (i < 1000) for i, r in got.items())


@pytest.mark.parametrize("trusted", [8, 200])
def test_few_trusted_documents_tell_junk_too(spark, trusted):
    from tidelog.llm.quality import quality_scores

    rng = random.Random(6)
    good = [(k, sentence(rng, 300), None, None, 0) for k in range(300)]
    bad = [(1000 + k, " ".join(f"{w}{rng.choice(['###', '$$$'])}" for w in sentence(rng, 300).split()), None, None, 0) for k in range(30)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(trusted)], "doc_id long, quality int, toxic int")
    got = by_id(quality_scores(spark.createDataFrame(good + bad, SCHEMA), labels))
    assert not any(got[i]["kept"] for i, *_ in bad)
    assert sum(got[i]["kept"] for i, *_ in good) > 0.9 * len(good)


# --- html --------------------------------------------------------------------------------------


def test_html():
    from tidelog.llm.html import main_text

    assert main_text(None) == "" and main_text("") == "" and main_text("<p>") == ""
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><a href="/">Home</a></header><nav><ul><li>Menu one<li>Menu two</ul></nav><div class="ad">Buy now.</div><div class="cookie-notice">We use cookies.</div>
    <article><h1>Title &amp; more</h1><p><b>First &lt;part&gt;,
       of <i>text</i>.<br><p>Second&nbsp;one.<ul><li>x<li>y</ul><aside>Side</aside><form><input>Send</form><p>Last</article>
    <section id="comments"><p>A comment that is rather long, and has marks; all the same it goes.</p></section><footer>&copy; 2020</footer></body></html>"""
    assert main_text(page) == "Title & more\nFirst <part>, of text.\nSecond one.\nx\ny\nLast"
    plain = "<body><div class=menu>" + "<a>link</a>" * 9 + "</div><div><p>" + "Some words, and more of them. " * 9 + "</p><p>Short.</p></div></body>"
    assert main_text(plain).endswith("Short.") and "link" not in main_text(plain)
    assert main_text("<article><p>kept<script>lost") == "kept"
    assert main_text('<body class="nav-open has-sidebar"><div class="with-sidebar"><article class="comments-open"><header class="entry-header"><h1>T</h1></header><p>x</p><div class="share">s</div></article></div>') == "T\nx"


def test_html_edges():
    from tidelog.llm.html import main_text

    assert main_text('<main><article>Real text, here.<p>More, more text.</p><article class="comment">I disagree, strongly.</article></article></main>') == "Real text, here.\nMore, more text."
    assert main_text('<p title="x>Hello</p><p>there, you.</p>') == "Hello\nthere, you."
    assert main_text('<p a="b > c">d "e" f</p>') == 'd "e" f'
    assert main_text('<body><article><div class="notice-board-history">Kept, really.</div><section id="discussion">Also kept, yes.</section><div class="alert-systems">On alerts.</div><p>And, this.</p></article>') == "Kept, really.\nAlso kept, yes.\nOn alerts.\nAnd, this."
    assert main_text("<html><head><title>x</title><style>y</style><meta name=a><body><p>No head end.</p>") == "No head end."
    long = "Some words, and more of them. " * 40
    assert main_text(f"<article><div><h2>Heading without marks</h2></div><table><tr><td>1<td>2</table><p>{long}</p></article>") == f"Heading without marks\n1\n2\n{long.strip()}"
    assert main_text("a < b <i>c</i>") == "a < b c" and main_text("<p>x</p><p>x</p>") == "x\nx"
    assert len(main_text('<p class="a" ' * 100_000)) > 0 and len(main_text('<a """"' * 50_000)) > 0  # no blow-up


def random_page(rng, marked):
    """A page and its article's blocks, put together from known parts."""
    from html import escape

    text = lambda n: sentence(rng, n) + rng.choice([".", "!", ", and so on.", " & more <things>."])
    body = [text(rng.randint(1, 60)) for _ in range(rng.randint(1, 8))]
    inner, want = "", []
    for b in body:
        kind = rng.choice(["p", "p", "p", "h2", "li", "div", "blockquote"])
        inside = escape(b).replace(" ", rng.choice([" ", "\n  ", " <b></b>"]), 1)
        inner += f"<ul><li>{inside}</ul>" if kind == "li" else f"<{kind}>{inside}</{kind}>"
        want.append(" ".join(b.split()))
        if rng.random() < 0.3:
            inner += rng.choice(["<script>var a = '<p>x</p>';</script>", f'<div class="share">{text(3)}</div>', f"<aside>{text(9)}</aside>", f"<form>{text(4)}<input></form>", "<!-- <p>no</p> -->"])
    junk = [f"<nav><ul><li><a href=/>{text(1)}</a></ul></nav>", f'<div class="ad">{text(12)}</div>', f'<div id="sidebar"><p>{text(20)}</p></div>', f'<div class="cookie-banner">{text(9)}</div>', f"<header><p>{text(5)}</p></header>"]
    tail = [f"<footer>{text(8)}</footer>", f'<section class="comments"><p>{text(30)}</p></section>', f'<div class="newsletter">{text(6)}</div>']
    rng.shuffle(junk)
    tag = rng.choice(["article", "main"]) if marked else "div"
    page = f"<html><head><title>{text(4)}</title>{rng.choice(['</head>', ''])}<body>{''.join(junk[: rng.randint(0, 5)])}<{tag}>{inner}</{tag}>{''.join(tail[: rng.randint(0, 3)])}</body></html>"
    return page, "\n".join(want)


@pytest.mark.parametrize("marked", [True, False])
def test_html_of_known_parts(marked):
    from tidelog.llm.html import main_text

    rng, other = random.Random(23), 0
    for _ in range(300):
        page, want = random_page(rng, marked)
        assert main_text(page) == want
        other += main_text(page, threshold=0) != want
    assert other > 150  # the ratios decide: without a threshold, doubted paths stay


def plain_article(page):
    """The same choice of paths, written anew over a parsed tree of simple pages."""
    from html.parser import HTMLParser

    gone = {"nav", "form", "menu", "aside", "head", "title", "script", "style"}
    found, holders, stack = [], [], []

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            if tag == "input":
                return
            if tag == "body":  # content ends the head
                del stack[1:]
            name = dict(attrs).get("class") or dict(attrs).get("id") or ""
            inside = any(s["tag"] in ("article", "main") for s in stack)
            up = stack[-1]["holders"] if stack else ()
            if tag in ("article", "main", "section", "div", "td") and not inside:
                holders.append([0, 0])
                up = (*up, len(holders) - 1)
            hard = tag in gone or tag == "header" and not inside or name in ("sidebar", "share", "cookie-banner", "comments", "newsletter")
            stack.append({"tag": tag, "step": (tag, name), "hard": hard or bool(stack and stack[-1]["hard"]), "doubts": (stack[-1]["doubts"] if stack else 0) + (tag == "footer" or name == "ad"), "holders": up})

        def handle_endtag(self, tag):
            while any(s["tag"] == tag for s in stack) and stack.pop()["tag"] != tag:
                pass

        def handle_data(self, data):
            kinds = ("b", "i")
            if not stack or stack[-1]["hard"]:
                return
            block = next(k for k in range(len(stack) - 1, -1, -1) if stack[k]["tag"] not in kinds)
            own = id(stack[block])
            if found and found[-1]["own"] == own:
                found[-1]["text"] += data
            else:
                keep.append(stack[block])
                found.append({"own": own, "text": data, "path": tuple(s["step"] for s in stack if s["tag"] not in kinds), "doubts": stack[block]["doubts"], "holders": stack[block]["holders"], "article": any(s["tag"] in ("article", "main") for s in stack)})

    keep = []
    Reader().feed(page)
    for f in found:
        f["text"] = " ".join(f["text"].split())
    found = [f for f in found if f["text"]]
    key = lambda f: (f["path"], f["holders"], f["doubts"], f["article"])
    own = {}
    for f in found:
        size, marks = len(f["text"]), len(re.findall(r"[.,;:!?…。，]", f["text"]))
        for total in [own.setdefault(key(f), [0, 0])] + [holders[h] for h in f["holders"]]:
            total[0] += size
            total[1] += marks
    marked = any(f["article"] and not f["doubts"] for f in found)
    trust = 0.5 * min(1, sum(len(f["text"]) for f in found) / 600) ** 3
    score = {}
    for k, (size, marks) in own.items():
        weights = [0.5 ** (n + 1) for n in range(len(k[1]))]
        size += sum(w * holders[h][0] for w, h in zip(weights, k[1][::-1], strict=True))
        marks += sum(w * holders[h][1] for w, h in zip(weights, k[1][::-1], strict=True))
        score[k] = size * (1 + marks) ** 0.25 * trust ** (k[2] + (marked and not k[3]))
    best = max(score.values())
    shares = sorted([1.0, 0.03] + [max(0.03, v / best) for v in score.values()])
    gap, cut = max((hi / lo, math.sqrt(hi * lo)) for lo, hi in zip(shares, shares[1:], strict=False) if lo < 0.18)
    return "\n".join(f["text"] for f in found if score[key(f)] >= best * min(0.18, cut))


@pytest.mark.parametrize("marked", [True, False])
def test_html_equals_a_plain_version(marked):
    from tidelog.llm.html import main_text

    rng = random.Random(31)
    for _ in range(200):
        page, _ = random_page(rng, marked)
        assert main_text(page) == plain_article(page)


def test_html_ratios_decide(monkeypatch):
    """Adverts without a name, or with a strange one, go by their ratios; with ratios of 1 most pages keep something else."""
    from tidelog.llm import html

    rng, wrong, other, lost, n = random.Random(5), 0, 0, 0, 200
    ratios = html.path_ratios
    for k in range(n):
        paragraphs = [sentence(rng, rng.randint(30, 90)) + ", and so on." for _ in range(rng.randint(3, 7))]
        title, name = sentence(rng, 6), ["", ' class="zorb"', ' id="x17"'][k % 3]
        inner = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        page = f"<body><nav>Home</nav><div{name}>{sentence(rng, 8)}.</div><article>{inner}</article><footer>{sentence(rng, 9)}.</footer></body>"
        want = "\n".join([title, *paragraphs])
        got = html.main_text(page)
        wrong += got != want
        bare = html.main_text(page.replace("article", "div"))
        lost += any(p not in bare for p in [title, *paragraphs])
        wrong += bare != want
        monkeypatch.setattr(html, "path_ratios", lambda found: dict.fromkeys(ratios(found), 1.0))
        other += html.main_text(page) != got
        monkeypatch.setattr(html, "path_ratios", ratios)
    assert (wrong, lost) == (0, 0)
    assert other > 0.9 * n


def test_html_rows(spark):
    from tidelog.llm.html import extract

    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "t", 9), (1, "u", "<p>a</p>", "t", 9), (None, "w", "<p>b</p>", None, None)], "page_id long, url string, html string, text string, n_chars long")
    assert sorted((tuple(r) for r in extract(pages).collect()), key=repr) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, "w", "b", 1)]
    assert extract(pages.limit(0)).collect() == []


def test_html_query(spark):
    from tidelog.llm.html import extract

    pages = spark.createDataFrame([(1, "u", "<article><p>é &eacute;</p></article>"), (2, None, None), (3, "v", "x" * 100_000)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    assert (got[1]["text"], got[1]["n_chars"], got[2]["text"], got[3]["n_chars"]) == ("é é", 3, "", 100_000)
    assert html_lib.unescape("&eacute;") in got[1]["text"]


# --- token counts ------------------------------------------------------------------------------


def test_token_counts(docs, rows, nothing):
    from tidelog.llm import tokens as m

    scores = m.vocabulary(m.vocabulary_path())

    def brute(word):
        word = m.MARK + word
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            n = len(word[i - 1].encode())
            options = [(best[i - 1][0] + m.BYTE_SCORE * n, -(best[i - 1][1] + n))]
            options += [(best[j][0] + scores[word[j:i]], -(best[j][1] + 1)) for j in range(i) if word[j:i] in scores]
            s, c = max(options)
            best.append((s, -c))
        return best[-1][1]

    got = by_id(m.token_counts(docs))
    for i, x, *_ in rows:
        w = WORD.findall(x or "")
        count = {y: brute(y) for y in set(w)}
        assert (got[i]["n_pretokens"], got[i]["n_tokens"]) == (len(w), sum(count[y] for y in w))
    assert m.token_counts(nothing).count() == 0


# --- packing -----------------------------------------------------------------------------------


def test_packing(docs, rows, nothing):
    from tokenizers import Tokenizer

    from tidelog.llm.packing import pack_documents, tokenizer_path

    odd = [(5000, "It's <|endoftext|> 2023! don't×stop…, A1b2 Élan—vital ²³ <|x", None, None, 0), (5001, "x×y÷z ÀÉ.é 'tis 'S éa ...a!! a_b", None, None, 0)]
    df = docs.unionByName(docs.sparkSession.createDataFrame(odd, SCHEMA))
    tok = Tokenizer.from_file(tokenizer_path())
    for capacity in (4096, 64):
        got = pack_documents(df, capacity=capacity).collect()
        ids = {i: [*tok.encode(x or "", add_special_tokens=False).ids, 1] for i, x, *_ in rows + odd}
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter(
            (i, p // capacity, p, len(x[p : p + capacity]), zlib.crc32(np.array(x[p : p + capacity], "<u4").tobytes())) for i, x in ids.items() for p in range(0, len(x), capacity)
        )
        used = {}
        for r in sorted(got, key=lambda r: r["offset"]):
            assert used.get(r["sequence_id"], 0) == r["offset"]
            used[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(used.values()) <= capacity and len(used) <= -(-sum(map(len, ids.values())) // capacity) * 1.05 + 1
    assert pack_documents(nothing).count() == 0


def test_packing_merges_rounds(spark):
    from pyspark.sql import functions as F

    from tidelog.llm.packing import pack

    parts = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.col("id") * 7919 % 900 + 1).alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    got = pack(parts, capacity=1000, node_items=100).collect()
    assert len(got) == 3000
    used = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert used.get(r["sequence_id"], 0) == r["offset"]
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 1000 and len(used) <= 1.06 * sum(r["length"] for r in got) / 1000 + 1


# --- decontamination ---------------------------------------------------------------------------


def test_decontamination(spark, nothing):
    from tidelog.llm.decontaminate import contamination, drop_contaminated

    rng = random.Random(9)
    items = [(k, sentence(rng, rng.randint(15, 60))) for k in range(20)] + [(90, None), (91, ""), (92, "tiny")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [(0, None, "en", "s", 0), (1, "", "en", "s", 0)], set()
    for k in range(60):
        text = sentence(rng, 150)
        if k % 3 == 0:
            leak = items[k % 20][1]
            if k % 2:
                leak = leak.upper().replace(" ", "!\n ")
            if k % 4 == 0:
                leak = leak[:20] + "x" + leak[21:40] + leak[41:]
            text = text[:300] + " " + leak + " " + text[300:]
            want.add(k + 2)
        rows.append((k + 2, text, "en", "s", len(text)))
    docs = spark.createDataFrame(rows, SCHEMA)
    for block in (1 << 24, 600):
        got = by_id(contamination(docs, bench, block_bytes=block))
        assert {i for i, r in got.items() if r["contaminated"]} == want
        assert all(str((i - 2) % 20) in got[i]["items"].split(",") for i in want)
        assert {r["doc_id"] for r in drop_contaminated(docs, bench, block_bytes=block).collect()} == set(got) - want
    assert contamination(nothing, bench).count() == 0
    assert not any(r["contaminated"] for r in contamination(docs, bench.limit(0)).collect())


def test_alignment_against_edit_distance():
    from tidelog.llm.decontaminate import Index, normalised

    rng = random.Random(2)
    for _ in range(40):
        item = "".join(rng.choice("abcdefgh") for _ in range(80))
        edits = rng.randint(0, 14)
        x = list(item)
        for _ in range(edits):
            k = rng.randrange(len(x))
            x[k : k + 1] = rng.choice([[], ["z"], [x[k], "z"]])
        text = "q" * 50 + "".join(x) + "q" * 50
        row = list(range(len(text) + 1)) and [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        data = np.frombuffer(text.encode(), np.uint8)
        found = Index([(1, item)]).search(*normalised(data, np.array([0, len(data)])))[0]
        assert bool(len(found)) == (min(row) <= 8)


def test_a_passage_is_found_wherever_it_lies_in_its_item():
    from tidelog.llm.decontaminate import Index, normalised

    rng = random.Random(12)
    item, other = ("".join(rng.choice("abcdefgh") for _ in range(400)) for _ in range(2))
    index = Index([(7, other), (1, item), (2, "short item")])
    texts = ["q" * 60 + item[k : k + 87] + "q" * 60 for k in range(400 - 87 + 1)] + ["q" * 300]
    data, off = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    doc, seg = index.search(*normalised(data, off))
    assert set(doc.tolist()) == set(range(len(texts) - 1)) and {index.item[s] for s in seg} == {1}


# --- odd tables --------------------------------------------------------------------------------


def test_packing_rounds_stay_bounded(spark, monkeypatch):
    """Items that hardly combine: no round may put more on a node than its items, and none is worth its exchange."""
    from tidelog.llm import packing

    calls, rounds = [], packing._round

    def counted(items, number, nodes, capacity):
        calls.append((items.count(), nodes))
        return rounds(items, number, nodes, capacity)

    monkeypatch.setattr(packing, "_round", counted)
    for least, most in ((600, 900), (300, 900)):
        calls.clear()
        parts = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (F.lit(least) + F.pmod(F.hash("id"), F.lit(most - least))).cast("long").alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
        got = packing.pack(parts, capacity=1000, node_items=50).collect()
        assert all(n <= 50 * nodes for n, nodes in calls) and calls[0][1] == 60
        assert [nodes for _, nodes in calls] == sorted({nodes for _, nodes in calls}, reverse=True)
        bins = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(got) == 3000 and all(sum(n for _, n in b) <= 1000 for b in bins.values())
        assert all(o == sum(n for _, n in sorted(b)[:k]) for b in bins.values() for k, (o, _) in enumerate(sorted(b)))


@pytest.mark.parametrize("name", ["jaccard_join", "score_texts", "shard", "repeated_bytes", "scan", "quality_scores", "token_counts", "pack_documents", "contamination", "keep_one", "cut_repeats", "keep_good", "drop_contaminated"])
def test_repeated_rows_and_clashing_columns(spark, rows, name):
    """Every operator with repeated rows and columns that are named like its own."""
    from pyspark.sql import functions as F

    from tidelog.llm import decontaminate, language_model, licenses, near_duplicates, packing, quality, sharding, substrings
    from tidelog.llm import tokens as token_module

    modules = (decontaminate, language_model, licenses, near_duplicates, packing, quality, sharding, substrings, token_module)
    operator = next(getattr(m, name) for m in modules if hasattr(m, name))
    some = rows[:12] + rows[60:75]
    clash = ["block", "bucket", "h1", "h2", "n", "item", "node", "sid", "gid", "path", "kind", "shard", "slot", "length", "size", "kept", "score", "class_id", "items", "tokens", "held_out"]
    docs = spark.createDataFrame(some + some[:5], SCHEMA).select("*", *[F.lit(f"x{k}").alias(k) for k in clash])
    more = {"quality_scores": spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"), "contamination": spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")}
    more |= {"keep_good": more["quality_scores"], "drop_contaminated": more["contamination"]}
    got = operator(docs, *([more[name]] if name in more else []))
    counts = Counter(r["doc_id"] for r in got.collect())
    if name in ("keep_one", "cut_repeats", "keep_good", "drop_contaminated"):
        assert got.columns == docs.columns and all(r[c] == f"x{c}" for r in got.collect() for c in clash)
        assert set(counts) <= {r[0] for r in some}
    else:
        assert counts == Counter(r[0] for r in some + some[:5])


def _operators(spark):
    """Every operator as a function of documents alone, with its ``doc_id`` column for what became of them."""
    from tidelog.llm import decontaminate, language_model, licenses, near_duplicates, packing, quality, sharding, substrings, tokens

    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k"), (None, "a b c d e f g h i j k"), (2, None)], "item_id long, text string")
    out = {f.__name__: f for f in (language_model.score_texts, sharding.shard, licenses.scan, tokens.token_counts, packing.pack_documents, near_duplicates.keep_one, substrings.cut_repeats)}
    out |= {f.__name__: lambda d, f=f: f(d, labels) for f in (quality.quality_scores, quality.keep_good)}
    return out | {f.__name__: lambda d, f=f: f(d, bench) for f in (decontaminate.contamination, decontaminate.drop_contaminated)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for name, operator in _operators(spark).items():
        assert operator(none).collect() == [], name


def test_rows_without_id_and_very_long_texts(spark):
    """No row is lost for want of an id, and a long text is judged by what stands at its end, too."""
    rng = random.Random(44)
    long = " ".join(f"w{rng.randint(0, 40_000)}" for _ in range(60_000))
    some = [(None, sentence(rng, 80), "en", "s", 1), (None, None, None, None, None), (3, long + " mit license a b c d e f g h i j k", "en", "s", 2), (None, "", "en", "s", 1), (4, sentence(rng, 70), None, None, None)]
    docs = spark.createDataFrame(some, SCHEMA)
    for name, operator in _operators(spark).items():
        got = operator(docs).collect()
        ids = Counter(r["doc_id"] for r in got)
        if name == "pack_documents":
            assert ids[None] == 3 and ids[4] == 1 and sum(r["length"] for r in got if r["doc_id"] == 3) > 60_000
        elif name in ("keep_good", "drop_contaminated", "keep_one"):
            assert ids[4] == 1 and ids[None] >= 1, name
            assert ids[3] == (name != "drop_contaminated"), name
        else:
            assert ids == {None: 3, 3: 1, 4: 1}, name
        row = next((r for r in got if r["doc_id"] == 3), None)
        if name == "scan":
            assert row["labels"] == "mit" and row["n_words"] == 60_013
        elif name == "contamination":
            assert row["contaminated"] and row["items"] == "1"
        elif name == "cut_repeats":
            assert row["text"] == some[2][1]


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline(spark, rows, tmp_path):
    """The stages one by one against brute force, and ``run`` against the stages."""
    import corpus_pipeline

    rng = random.Random(12)
    leak = sentence(rng, 40)
    all_rows = rows + [(9000, sentence(rng, 80) + " " + leak, "en", "s", 1)]
    folder = str(tmp_path)
    spark.createDataFrame(all_rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, *_ in all_rows[:30]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(7, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k < 4:
            assert docs.columns == columns
            after = {r["doc_id"] for r in docs.collect()}
        if k == 0:
            assert after and all(len(WORD.findall(x or "")) >= 50 for i, x, *_ in before if i in after)
        elif k == 1:
            assert after == {c for c, *_ in brute_classes(before).values()}
        elif k == 2:
            assert after == {i for i, *_ in before}
        elif k == 3:
            assert {i for i, *_ in before} - after == {9000}
    assert Counter(r["doc_id"] for r in docs.collect()).keys() == after
    names = [c for c in docs.columns if c not in ("sequence_id", "offset")]
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).select(names).collect())) == Counter(map(tuple, docs.select(names).collect()))
