"""The conversation trie, the phrase miner and the vector forest against brute force, with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TALK = "conv_id long, turn long, role string, text string"


# --- conversation trie -------------------------------------------------------------------------


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute_trie(rows):
    talks = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    ends = lambda p, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(talks[c]) == len(p)).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], ends(p, m)) for p, m in members.items())


def found_trie(df):
    got = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    return sorted(tuple(r) for r in got)


def talks(seed, n=120, most=9, vocabulary=4):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(rng.randint(1, most)):
            rows.append((c, k, rng.choice(["user", "assistant", None]), rng.choice(["hi there", "a", "b c d", "", None, "é è"][:vocabulary])))
    # copies of one conversation, ties and repeated rows, null turns, a conversation without id, a negative one
    rows += [(c, k, "user", f"turn {k}") for c in range(500, 540) for k in range(5)]
    rows += [(600, 1, "user", "x"), (600, 1, "user", "x"), (600, None, "system", "first"), (600, 1, "assistant", "x"), (None, 0, "user", "lost"), (-7, 0, "user", "minus"), (10**15, 0, "user", "large")]
    return rows


@pytest.mark.parametrize(("length", "cells"), [(256, 1 << 19), (256, 40), (3, 30), (1, 1)])
def test_trie_equals_brute_force(spark, length, cells):
    from tidelog.llm.prefix_trie import conversation_trie

    rows = talks(5)
    df = spark.createDataFrame(rows, TALK).repartition(3)
    assert found_trie(conversation_trie(df, length=length, cells=cells)) == brute_trie(rows)


def test_trie_of_a_long_conversation_and_one_turn_for_all(spark):
    from tidelog.llm.prefix_trie import conversation_trie

    rows = [(k, 0, "system", "be kind") for k in range(0, 400, 20)] + [(k, j, "user", f"{j % 3}") for k in (3, 7, 44) for j in range(90 + k)] + [(5, 0, "user", "w " * 30_000)]
    df = spark.createDataFrame(rows, TALK)
    assert found_trie(conversation_trie(df, length=20, cells=64)) == brute_trie(rows)


def test_trie_of_nothing_and_of_other_columns(spark):
    from tidelog.llm.prefix_trie import conversation_trie

    assert conversation_trie(spark.createDataFrame([], TALK)).collect() == []
    assert conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], TALK)).collect() == []
    rows = talks(8, n=30)
    df = spark.createDataFrame(rows, TALK).withColumns({c: F.lit(1) for c in ("rank", "seg", "ids", "words", "key", "root", "_lead", "part")})
    assert found_trie(conversation_trie(df)) == brute_trie(rows)


# --- phrases -----------------------------------------------------------------------------------


def brute_phrases(rows, least=30, top=2000, longest=4):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts["und" if lang is None else lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            inside = [q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * often[q] >= 80 * a for q in inside):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=150):
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta", "été", "x", "y-z", "\x01odd", "日本"]
    rows = []
    for k in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice([*words, "alpha beta Gamma", "one two three four five"]) + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "])
        rows.append((k, text, ["en", None, "de\n\0", "und"][k % 4], "s", len(text)))
    rows += [(1000, None, "en", "s", 0), (1001, "", None, "s", 0), (None, "alpha beta " * 50, "en", "s", 0), (1002, "very long " * 40_000, "fr", "s", 0)] + [(1003, "same same same", "en", "s", 0)] * 15
    return rows


@pytest.mark.parametrize("block", [12 << 20, 300])
def test_phrases_equal_brute_force(spark, block):
    from tidelog.llm.collocations import collocations

    rows = prose(2)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(tuple(r) for r in collocations(df, least=7, top=40, block_bytes=block).collect())
    assert got == brute_phrases(rows, least=7, top=40)
    assert got


def test_phrases_of_nothing_and_of_other_columns(spark):
    from tidelog.llm.collocations import collocations

    assert collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect() == []
    rows = prose(3, n=60)
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("kind", "block", "id", "n", "phrase", "rank", "score", "a")})
    assert sorted(tuple(r) for r in collocations(df, least=5).collect()) == brute_phrases(rows, least=5)


# --- neighbours --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_nearest(rows, k=20):
    seen = {}
    for i, v, *_ in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        seen[i] = v
    out = []
    ids = sorted(seen)
    dim = max((len(v) for v in seen.values()), default=0)
    x = np.array([list(seen[i]) + [0.0] * (dim - len(seen[i])) for i in ids], float).reshape(len(ids), dim)
    for q in ids:
        if q % 20 == 0:
            s = np.add.accumulate(x * x[ids.index(q)], axis=1)[:, -1]
            best = sorted((-a, i) for a, i in zip(s.tolist(), ids, strict=True) if i != q)[:k]
            out += [(q, r, i, -a) for r, (a, i) in enumerate(best, 1)]
    return out


def found_nearest(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_neighbours_are_exact_while_the_budget_holds_all(spark):
    from tidelog.llm.forest import nearest

    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(12).tolist(), 0) for k in range(300)]
    rows += [(1000 + k, rows[3][1], 0) for k in range(60)]  # copies, queries among them
    rows += [(2000 + k, [1.0, 0.0, 0.0], 0) for k in range(40)]  # shorter ones, ties
    rows += [(3000, None, 0), (3020, [], 0), (3040, [0.0] * 12, 0), (3060, [1.0, None], 0), (3080, [float("nan")] * 12, 0), (3100, [float("inf")] + [0.0] * 11, 0), (None, [1.0] * 12, 0), (-20, [-9.0] * 12, 0), (3120, [1e3] * 12, 0)]
    rows += [rows[0], rows[20]]  # repeated
    df = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({c: F.lit(1) for c in ("key", "ids", "v", "asks", "score", "rank", "query_id")})
    assert found_nearest(nearest(df)) == brute_nearest(rows)


def test_few_vectors_and_none(spark):
    from tidelog.llm.forest import nearest

    rows = [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (20, [1.0, 1.0], 0)]
    assert found_nearest(nearest(spark.createDataFrame(rows, VECTORS))) == brute_nearest(rows)
    assert nearest(spark.createDataFrame([], VECTORS)).collect() == []
    assert nearest(spark.createDataFrame([(5, [0.0], 1)], VECTORS)).collect() == []
    assert nearest(spark.createDataFrame([(20, [1.0], 1)], VECTORS)).collect() == []


def test_recall_below_the_root(spark, monkeypatch):
    """With a budget of a third of the rows, in runs and parts of a few hundred; scores are exact."""
    from tidelog.llm import forest

    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 32))
    rows = [(k, (centres[k % 20] + 0.6 * rng.standard_normal(32)).tolist(), 0) for k in range(4000)]
    monkeypatch.setattr(forest, "RUN_ROWS", 300)
    got = found_nearest(forest.nearest(spark.createDataFrame(rows, VECTORS).repartition(4), budget=1300))
    want = brute_nearest(rows)
    truth = defaultdict(dict)
    for q, _, i, s in want:
        truth[q][i] = s
    hits = sum(i in truth[q] for q, _, i, _ in got)
    assert len(got) == len(want)
    assert hits / len(want) >= 0.9
    assert all(truth[q][i] == s for q, _, i, s in got if i in truth[q])


def test_crowds_below_the_counted_signs(spark, monkeypatch):
    """Near copies share every counted sign: trees go on alone, crowded cells are dealt out in parts, and nothing is lost."""
    from tidelog.llm import forest

    rng = np.random.default_rng(3)
    one = rng.standard_normal(16)
    rows = [(k, (one + 1e-7 * rng.standard_normal(16)).tolist(), 0) for k in range(900)] + [(5000 + k, rng.standard_normal(16).tolist(), 0) for k in range(300)]
    monkeypatch.setattr(forest, "RUN_ROWS", 100)
    got = found_nearest(forest.nearest(spark.createDataFrame(rows, VECTORS), budget=1 << 14))
    assert got == brute_nearest(rows)
    few = found_nearest(forest.nearest(spark.createDataFrame(rows, VECTORS), budget=600))
    assert len(few) == len(got)
