"""Conversation trie against a brute-force trie, with lent turns, nulls, ties, copies and spilled queues."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from playlake.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, d == len(turns)))
    out = []
    for node, held in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(all(m[: len(n)] != n or len(m) <= len(n) for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        last = ",".join(str(c) for c, end in held if end)
        parent = members[node[:-1]][0][0] if node else None
        out.append((held[0][0], len(node), parent, len(held), len(kids), leaves, saved, hashlib.sha256(last.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n, words=3):
    rng = random.Random(seed)
    said = [f"say {i}" for i in range(words)] + ["é" * 3, "", None]
    rows = []
    for c in range(n):
        if rng.random() < 0.9:
            for t in range(rng.randint(1, 12)):
                rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", "user", None]), rng.choice(said)))
    rng.shuffle(rows)
    return rows


def got(spark, docs):
    found = P.trie(spark, docs)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"SHARD": 3, "GROWTH": 2, "HELD": 2, "STEP": 3, "PIECE": 2}])
def test_equals_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(P, name, value)
    rows = corpus(5, 60)
    assert got(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_common_first_turn_and_copies(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 10)
    rows = [(5 * i, t, "user", f"turn {t}") for i in range(80) for t in range(3)] + [(1000 + 5 * i, 0, "user", "turn 0") for i in range(40)]
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(7, 0, "user", "a"), (8, 0, "user", "b"), (13, 0, "user", "c"), (14, 0, "user", "c")]
    found = got(spark, spark.createDataFrame(rows, SCHEMA))
    assert found == brute(rows)
    assert any(r[1] == 0 for r in found)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 1, "user", "x"), (5, 1, "user", "x"), (5, 1, "assistant", "x"), (10, None, "", "")]
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_long_conversation_spans_blocks_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(P, "STEP", 16)
    rows = [(c, t, "user", f"t{t // 3}" * 50) for c in (20, 25) for t in range(200 + c)]
    assert got(spark, spark.createDataFrame(rows, SCHEMA).repartition(8)) == brute(rows)


def test_clashing_columns_and_very_long_text(spark):
    rows = [(5, 0, "user", "long " * 200_000), (10, 0, "user", "long " * 200_000), (15, 0, "user", "short")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("c", "depth", "n", "bytes", "pid", "place", "tie", "top", "unit", "parent"):
        docs = docs.withColumn(name, F.lit("x"))
    assert got(spark, docs) == brute(rows)


def test_empty_table(spark):
    assert got(spark, spark.createDataFrame([], SCHEMA)) == []


def test_queue_spills_and_keeps_order():
    rng = random.Random(2)
    sent = [(-rng.randint(0, 5), rng.randint(0, 30), 1, rng.randint(1, 9), rng.randint(0, 9)) for _ in range(3000)]
    queue, want = P.Queue(held=64), defaultdict(lambda: [0, 0, 0])
    for m in sent:
        queue.push(m)
        for k in range(3):
            want[m[:2]][k] += m[2 + k]
    assert len(queue.runs) > 10
    assert {k: list(queue.take(*k)) for k in sorted(want)} == dict(want)
