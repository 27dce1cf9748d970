"""Pairs by prefixes against brute force, and what becomes of large buckets."""

import random

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import hyperminhash as H
from playlake.llm import prefix_pairs as P
from tests.llm.test_hyperminhash import SCHEMA, brute, corpus

SETS = "doc_id long, label long, alone boolean, shingles binary"


def row(doc, label, tokens, alone=None):
    packed = np.array([hash((7, t)) % (1 << 64) for t in sorted(tokens)], np.uint64)
    return doc, label, doc == label if alone is None else alone, np.sort(packed).tobytes()


def found(spark, rows, pct=80, block=4000):
    sets = spark.createDataFrame(rows, SETS).repartition(3, "doc_id")
    prefix = P.prefixes(P.shared(P.dealt(sets, 10), 10), pct)
    return {(r.a, r.b) for r in P.meetings(prefix.join(P.tokens(prefix), "token"), pct, block).collect()}


def alike(sets, pct=80):
    return {
        (min(a, b), max(a, b))
        for i, (a, l_a, s) in enumerate(sets) for b, l_b, t in sets[i + 1:]
        if l_a != l_b and s and t and 100 * len(s & t) >= pct * len(s | t)
    }


@pytest.mark.parametrize("block", [4000, 3])
def test_no_similar_pair_is_left_out(spark, block):
    rng = random.Random(3)
    sets = []
    for _ in range(25):
        base = rng.sample(range(300), rng.randint(1, 60))
        for _ in range(rng.randint(1, 6)):
            own = {t if rng.random() > 0.06 else rng.randrange(300) for t in base} | set(range(1000, 1000 + rng.choice([0, 0, 8])))
            doc = len(sets) - 20  # ids may be negative
            sets.append((doc, doc, own))
    sets = [(d, sets[i - 1][0] if i % 7 == 0 and i else label, s) for i, (d, label, s) in enumerate(sets)]
    sets.append((sets[3][0], sets[3][1], {1, 2, 3}))  # one document with two sets
    sets.append((900, 900, set()))
    labels = [label for _, label, _ in sets]
    rows = [row(d, label, s, alone=labels.count(label) == 1) for d, label, s in sets]
    want = alike(sets)
    got = found(spark, rows + rows[:10], block=block)
    assert len(want) > 20 and want <= got and len(got) < 3 * len(want)


def test_a_passage_of_many_sets_brings_no_pairs(spark):
    rows = [row(d, d, {*range(20), *range(100 * d, 100 * d + 8)}) for d in range(1, 60)]
    assert found(spark, rows) == set()


def test_members_of_one_component_are_no_pairs(spark):
    rows = [row(d, 1, {*range(50), 1000 + d}) for d in range(1, 30)] + [row(50, 50, {*range(50)}), row(51, 51, set())]
    assert found(spark, rows) == {(d, 50) for d in range(1, 30)}


def members(monkeypatch):
    """Rows that the next runs compare in blocks."""
    seen, real = [], H._large_pairs

    def spy(*args):
        seen.append(next(x for x in args if isinstance(x, DataFrame)).where(F.col("n") > H.SMALL).count())
        return real(*args)

    monkeypatch.setattr(H, "_large_pairs", spy)
    return seen


def test_a_shared_passage_is_not_compared_in_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(d, f"{passage}\n{' '.join(f'o{rng.randrange(10**6)}' for _ in range(12))}", "s") for d in range(120)]
    near = [(1000 + d, f"{rows[d][1]} end", "s") for d in range(0, 120, 9)] + corpus(5, 5, 3, 2)
    rows += [(d if d >= 1000 else d + 5000, t, s) for d, t, s in near]
    seen = members(monkeypatch)
    got = H.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), size=4).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)
    assert seen == [0]


def test_crowds_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "SMALL", 3)
    monkeypatch.setattr(H, "BLOCK", 7)
    rng = random.Random(6)
    rows = [(d, " ".join(rng.sample([f"w{i}" for i in range(60)], 50)), "s") for d in range(70)]
    seen = members(monkeypatch)
    got = H.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), size=1).collect()
    want = brute(rows, size=1)
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) > 1
    assert seen[0] > 0
