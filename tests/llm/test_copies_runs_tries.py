"""Exact dedup, periodic runs and the prefix trie on small tables, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from meterlens.llm import exact, hot_keys, periodic, prefix_trie, queries
from pyspark.sql import functions as F


# --- exact dedup
@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("aaaabbcdefgh"), max_size=60), st.integers(1, 5))
def test_counters_are_too_low_by_a_share_at_most(values, counters):
    summary = exact.MisraGries(counters)
    for i in range(0, len(values), 7):
        summary.add(iter(Counter(values[i : i + 7]).items()))
        assert len(summary.counts) <= counters
    for value, n in Counter(values).items():
        assert n - len(values) / (counters + 1) <= summary.counts.get(value, 0) <= n
    assert all(v in summary.frequent() for v, n in Counter(values).items() if n > 2 * len(values) / (counters + 1))


ROWS = [
    (1, "A text"), (2, "a TEXT"), (9, "a text"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 300_000), (8, "X" * 300_000),
    (9, "a text"), (10, " a text"), (None, "none"), (None, "NONE"), (11, "one"),
] + [(100 + i, "Many copies" if i % 2 else "many copies") for i in range(60)]


@pytest.mark.parametrize("counters", [1, 3, 4095])
def test_copies(docs, counters):
    made = docs(*ROWS).withColumns({"digest": F.lit("x"), "row": F.lit(1), "keep": F.lit(2), "_keep": F.lit(3)})
    rows = exact.copies(made, counters=counters).collect()
    want = brute.equal_texts(ROWS)
    by_text = defaultdict(list)
    for r in rows:
        by_text[bytes(r.digest).hex()].append(r)
    assert len(rows) == len(ROWS) and len(by_text) == len(want)
    for text, (ids, keep) in want.items():
        group = by_text[hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(str(r.id) for r in group) == sorted(map(str, ids))
        assert all((r.keep_id, r.group_size) == (keep, len(ids)) for r in group)
        assert [r.id for r in group if r.kept] == [keep]
    left = exact.drop_copies(made, counters=counters)
    assert left.columns == made.columns
    assert Counter((r.doc_id, (r.text or "").lower()) for r in left.collect()) == Counter((keep, t.lower()) for t, (_, keep) in want.items())


def test_copies_of_an_empty_table(docs):
    assert exact.copies(docs((1, "a")).where("false")).count() == 0
    assert exact.drop_copies(docs((1, "a")).where("false")).count() == 0


def test_hot_digests_are_few_and_complete(docs):
    rows = [(i, f"text {i}") for i in range(300)] + [(1000 + i, "hot") for i in range(200)] + [(2000 + i, "warm") for i in range(40)]
    made = exact._digests(docs(*rows, parts=7), "doc_id", "text")
    found = {r["size"] for r in exact.frequent(made, 50).collect()}
    assert {200, 40} <= found
    assert exact.frequent(made, 3).count() <= 4


def test_join_groups_is_the_plain_join(spark):
    rows = spark.createDataFrame([(i % 7 if i < 100 else 7, i) for i in range(160)], "k long, v long")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    want = sorted(map(tuple, rows.join(groups, "k").select("k", "v", "n", "top").collect()))
    for share in (1, 4, 100):
        assert sorted(map(tuple, hot_keys.join_groups(rows, groups, ["k"], "n", share).select("k", "v", "n", "top").collect())) == want


# --- periodic runs
def coded(tokens):
    known = {}
    return np.array([known.setdefault(t, len(known)) for t in tokens], np.int64)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=7))
def test_runs(parts):
    tokens = list("".join(x * n for x, n in parts))
    assert sorted(periodic.runs(coded(tokens)), key=lambda r: (r[0], r[2])) == brute.periodic_runs(tokens)


def test_long_runs():
    r = random.Random(3)
    for q in (1, 2, 3, 5, 8, 17, 64, 100):
        unit = [f"u{r.randrange(6)}" for _ in range(q - 1)] + ["end"]
        tokens = [f"x{i}" for i in range(11)] + (unit * 9)[: 4 * q + q // 2 + 6] + ["y"] + (unit * 4)[: 4 * q - 1] + ["z"]
        assert sorted(periodic.runs(coded(tokens)), key=lambda r: (r[0], r[2])) == brute.periodic_runs(tokens)
    assert periodic.runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert periodic.runs(np.arange(1000)) == [] and periodic.runs(np.zeros(0, np.int64)) == []


def test_collapse(docs):
    rows = [(1, "a b a b a b a b c"), (2, None), (3, ""), (4, " \t\n"), (5, "É é É é É é É é É"), (6, "x " * 200_000), (1, "a b a b a b a b c"),
            (7, "w w w w w w w w end"), (8, "A a A a A a"), (None, "q " * 6)]
    made = docs(*rows).withColumns({"start": F.lit(1), "Runs": F.lit(2)})
    out = periodic.collapse(made)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "start", "runs"]
    got = Counter((r.doc_id, r.text, tuple(map(tuple, r.runs)), r.start) for r in out.collect())
    want = Counter()
    for doc, text in rows:
        tokens = (text or "").encode().split()
        found = brute.periodic_runs(tokens) if len(tokens) < 1000 else [(0, len(tokens), 1)]
        want[doc, b" ".join(brute.collapsed(tokens, found)).decode(), tuple(found), 1] += 1
    assert got == want
    assert periodic.collapse(made.where("false")).count() == 0


# --- prefix trie
FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table_of(spark, conversations, parts=3):
    rows = [(c, i * 3 - 4, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)


def branching(seed, n):
    r = random.Random(seed)
    return {c * 3 - 7: [(r.choice("ua"), "é" * r.randrange(3)) for _ in range(r.randrange(1, 7))] for c in range(n)}


@pytest.mark.parametrize("cells", [prefix_trie.MOST_CELLS, 8])
def test_trie(spark, cells):
    made = branching(1, 70) | {1000 + i: [("u", "same"), ("a", "again")] for i in range(25)}
    given = prefix_trie.turns(table_of(spark, made))
    assert {tuple(r[f] for f in FIELDS) for r in prefix_trie.nodes(given, cells).collect()} == brute.trie(made)


def test_trie_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    long = [("u", f"t{i}") for i in range(50)]
    made = {1: long, 2: long[:33] + [("a", "x")] * 20, 3: long[:16], 4: long[:17] + [("a", "z")], 5: [("u", "t0")] * 24, 6: long}
    rows = prefix_trie.trie(table_of(spark, made, 5)).collect()
    assert len(rows) == len({(r.conv_id, r.depth) for r in rows})
    assert {tuple(r[f] for f in FIELDS) for r in rows} == brute.trie(made)


def test_trie_of_odd_rows(spark):
    rows = [(1, 2, "u", "b"), (1, None, None, "a"), (1, 3, "u", None), (None, 1, "u", "lost"), (2, 1, "", "a"), (2, 5, "u", "b"), (2, 9, "u", ""),
            (-3, 1, "u", "x" * 100_000), (-3, 1, "u", "x" * 100_000)]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"k1": F.lit(1), "depth": F.lit("d"), "n": F.lit(2)})
    same = [("", "a"), ("u", "b"), ("u", "")]
    want = brute.trie({1: same, 2: same, -3: [("u", "x" * 100_000)] * 2})
    assert {tuple(r[f] for f in FIELDS) for r in prefix_trie.trie(made).collect()} == want
    assert prefix_trie.trie(made.where("false")).count() == 0


def test_rebuilt_trie(spark):
    made = branching(5, 60) | {c: [("u", "hello")] for c in (400, 403, 601)}
    given = queries._rebuilt(prefix_trie.turns(table_of(spark, made)))
    want = brute.trie(brute.rebuilt(made))
    assert any(x[1] == 0 and x[7] != hashlib.sha256(b"").hexdigest() for x in want), "some conversation has no turn"
    assert {tuple(r[f] for f in FIELDS) for r in prefix_trie.nodes(given).collect()} == want


def test_screened_tails_are_not_shuffled(spark):
    made = {c: [("u", f"{c} {i}") for i in range(5)] for c in range(200)}
    prefixes = prefix_trie._prefixes(prefix_trie.turns(table_of(spark, made)).items)
    assert prefix_trie._screened(prefixes, prefix_trie.MOST_CELLS).where("not alone").count() < 100


# --- the queries against brute force
SF = "/root/testdata/sf0.001"


def test_run_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    some = 0
    for d in rows:
        tokens = brute.cycled(d.doc_id, [w.decode() for w in (d.text or "").encode().split()])
        r = got[d.doc_id]
        runs = [(x[0], x[1], x[2]) for x in brute.periodic_runs(tokens)] if len(tokens) < 1500 else None
        if runs is None:
            continue
        some += bool(runs)
        assert r.n_runs == len(runs) and r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(brute.collapsed(tokens, runs)))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert some > 5
