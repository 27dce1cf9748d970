"""Similarity join by adaptive prefixes against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlake.llm import shingle_join as S
from tests.llm.test_hyperminhash import SCHEMA, brute, shingles


def corpus(seed, groups, copies, edits, length):
    """Families of texts that differ in a few words, so that many pairs lie near the threshold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    passage = rng.choices(words, k=40)
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(3, length))
        if rng.random() < 0.3:
            base = base + passage
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice([*words, "NEW", f"u{rng.random()}"])
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(text), "s"))
    rng.shuffle(rows)
    return rows


def got(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    found = S.similar_sets(spark, docs, **kw)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return found.collect()


def same(rows, found, size=4, pct=85):
    want = brute(rows, size, pct)
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == sorted((d, want[d]) for d, *_ in rows)
    sizes = sorted((d, len(shingles(t, size))) for d, t, *_ in rows)
    assert sorted((r["doc_id"], r["n_shingles"]) for r in found) == sizes


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"SMALL": 2, "BLOCK": 3, "LEAST_FREQUENT": 5}), (3, {"SMALL": 1, "BLOCK": 2, "LEAST_FREQUENT": 2})])
def test_equals_brute_force(spark, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(S, name, value)
    rows = corpus(seed, 25, 9, 4, 90)
    same(rows, got(spark, spark.createDataFrame(rows, SCHEMA).repartition(3)))


def test_other_size_and_threshold(spark):
    rows = corpus(4, 20, 6, 6, 60)
    same(rows, got(spark, rows, size=2, pct=60), 2, 60)


def test_pairs_exactly_on_the_threshold(spark):
    words = [f"x{i}" for i in range(200)]
    rows = []
    for k in range(20):  # one shingle size, sets of numbers: 20 - d of 20 shared with d more on each side
        d = k % 4
        base = words[:40 - d] + [f"only{k}_{i}" for i in range(d)]
        rows.append((k, " ".join(base), "s"))
    same(rows, got(spark, rows, size=1), 1, 85)


def test_one_large_family_and_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL", 4)
    monkeypatch.setattr(S, "BLOCK", 20)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    base, passage = rng.choices(words, k=120), rng.choices(words, k=60)
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.randint(1, 5)):
            text[rng.randrange(120)] = f"v{rng.random()}"
        rows.append((i, " ".join(text), "s"))
    rows += [(100 + i, " ".join(passage + rng.choices(words, k=rng.randint(0, 200))), "s") for i in range(60)]
    same(rows, got(spark, rows))


def test_edge_cases(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, " \n\t", "s"), (4, "one two", "s"), (5, "One\nTWO", "s"), (6, "one", "s"), (7, "one two three", "s"), (8, None, "s")]
    same(rows, got(spark, rows))


def test_repeated_ids_and_rows(spark):
    text = " ".join(f"a{i}" for i in range(30))
    other = " ".join(f"b{i}" for i in range(30))
    rows = [(1, text, "s")] * 5 + [(2, text, "s"), (2, other, "s"), (3, other, "s"), (4, "alone here", "s")] + [(9, other + " c", "s")] * 3
    same(rows, got(spark, spark.createDataFrame(rows, SCHEMA).repartition(6)))


def test_row_without_id_links_nothing(spark):
    text = " ".join(f"a{i}" for i in range(30))
    found = {r["doc_id"]: r["component_id"] for r in got(spark, [(None, text, "s"), (2, text, "s"), (3, "b c", "s")])}
    assert found == {None: None, 2: 2, 3: 3}


def test_very_long_text_clashing_columns_and_empty_table(spark):
    long = [f"w{i * i % 9973}" for i in range(120_000)]
    rows = [(1, " ".join(long), "s"), (2, " ".join([*long, "end"]), "s"), (3, "short text", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("n", "digest", "token", "held", "key", "slice", "sid", "prefix"):
        docs = docs.withColumn(name, F.lit("x"))
    found = {r["doc_id"]: r["component_id"] for r in got(spark, docs)}
    assert found == {1: 1, 2: 1, 3: 3}
    assert got(spark, []) == []


def test_longer_prefixes_ask_for_more_matches():
    held = np.array([2] * 5 + [900] * 20)
    p, listed = S._choose(60, 5, held, 85)
    assert S._need(np.array([60]), np.array([60]), np.array([p]), np.array([p]), 85)[0] > p - 60 + 51
    assert listed == p - 5
    assert S._choose(60, 10, np.array([2] * 50), 85) is None  # ten unique shingles, nine may be lacking
    cheap, dear = (S._choose(60, 0, np.full(60, h), 85)[0] for h in (2, 2000))
    assert cheap >= 10 and dear >= 10
