"""Near duplicates against brute force over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from playlake.llm import hyperminhash as H
from playlake.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def shingles(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return set()
    return {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, size=4, pct=80):
    sets = {}
    for d, t, *_ in rows:
        sets.setdefault(d, []).append(shingles(t, size))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(s and t and 100 * len(s & t) >= pct * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d in ids}


def corpus(seed, groups, copies, edits, length=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(3, length))
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(own).title() if rng.random() < 0.2 else "\n".join(own), "s"))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("case", [(1, 60, 4, 3), (2, 3, 40, 6), (3, 2, 60, 2)])
def test_components_equal_brute_force(spark, case):
    rows = corpus(*case)
    rows += [(9001, None, "s"), (9002, "", "s"), (9003, " \t\n", "s"), (9004, "one", "s"), (9005, "ONE", "s"), (9006, "é É", "s")]
    got = H.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), size=4).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert {r.doc_id: r.n_shingles for r in got} == {d: len(shingles(t, 4)) for d, t, _ in rows}


def test_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "SMALL", 3)
    monkeypatch.setattr(H, "BLOCK", 5)
    rows = corpus(7, 2, 70, 7, 45)
    got = H.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), size=4).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_thinned_sets_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(H, "SMALL", 3)
    monkeypatch.setattr(H, "THIN", 32)
    rows = corpus(8, 2, 50, 4, 90)
    got = H.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), size=4).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_empty_table_repeated_rows_and_missing_ids(spark):
    empty = H.near_duplicates(spark, spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(1, text, "x"), (1, text, "x"), (2, text, "y"), (None, text, "z"), (3, "other words here and more", None)]
    got = H.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)
    ]


def test_keep_one_keeps_columns_that_clash(spark):
    text = " ".join(f"a{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, text), (None, text)], "doc_id long, text string")
    docs = docs.withColumn("component_id", F.lit("own")).withColumn("kept", F.lit(7)).withColumn("sketch", F.lit(b"x"))
    got = H.keep_one(spark, docs)
    assert got.columns == docs.columns and sorted(r.doc_id or 0 for r in got.collect()) == [0, 1]


def test_estimate_is_close_and_corrected():
    import numpy as np

    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, 4000, np.uint64)
    other = np.concatenate([base[:3200], rng.integers(0, 1 << 64, 100, np.uint64)])
    a, b = (H.registers(np.zeros(len(v), np.int64), v, 1) for v in (base, other))
    est, used = H.estimate(a, b, np.int64(len(base)), np.int64(len(other)))
    assert used[0] == H.REGISTERS and abs(est[0] - 3200 / 4100) < 0.12


def test_connected_components_on_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5)]
    got = connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_estimates_five_deviations_short_are_still_confirmed():
    import numpy as np
    import pandas as pd

    used = np.array([H.REGISTERS])
    est = 0.8 - 5 * np.sqrt(0.8 * 0.2 / used)
    assert H._allowed(est, used, np.array([1000]), np.array([1000]), 0.8).all()

    # two sets thinned to half, 500 hashes each: with 416 shared the estimate is 5.3 deviations short, with 400 8.2
    def joined(shared):
        one, two = np.arange(500, dtype=np.uint64), np.arange(500, dtype=np.uint64) + np.uint64(500 - shared)
        x = pd.DataFrame({
            "rep": [1, 2], "label": [1, 2], "own": [0, 0], "i": [0, 0], "j": [0, 0], "n_shingles": [1000, 1000], "level": [1, 1],
            "thin": [H._pack(one), H._pack(two)],
        })
        return H._joining(x, 80)

    assert joined(416) == [(1, 2)] and joined(400) == []


def test_thinned_margin_covers_the_sampling_error():
    import numpy as np
    import pandas as pd

    # sets of 10,000 at similarity just above 0.8; thinning to a quarter keeps few of the shared hashes and more of the others
    one = np.concatenate([np.arange(2150), np.arange(3000, 3340)]).astype(np.uint64)
    two = np.concatenate([np.arange(2150), np.arange(4000, 4340)]).astype(np.uint64)
    x = pd.DataFrame({
        "rep": [1, 2], "label": [1, 2], "own": [0, 0], "i": [0, 0], "j": [0, 0], "n_shingles": [10000, 10000], "level": [2, 2],
        "thin": [H._pack(one), H._pack(two)],
    })
    assert H._joining(x, 80) == [(1, 2)]


def test_blocks_link_by_whole_hashes(spark):
    """Two sets that agree in the upper bits of a hash only are not alike, and do not hide a true link."""
    import numpy as np
    import pandas as pd

    base = np.arange(1, 101, dtype=np.uint64) << np.uint64(50)
    near = base.copy()
    near[80:] += np.uint64(1)  # upper bits as in base
    true = base.copy()
    true[95:] += np.uint64(1) << np.uint64(45)
    rows = [(k, f.tobytes(), i) for i, (k, f) in enumerate(((1, base), (2, near), (3, true)))]
    x = pd.DataFrame({"rep": [r[0] for r in rows], "thin": [r[1] for r in rows], "n_shingles": 100, "level": 0, "label": [10, 20, 20], "own": 0, "i": 0, "j": 0})
    assert H._joining(x, 80) == [(1, 3)]
