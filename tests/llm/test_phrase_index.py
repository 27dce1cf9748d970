"""Benchmark hits against brute force over all windows of all texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from playlake.llm import phrase_index as P

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    windows = {}
    for i, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k: k + size]), set()).add(str(i))
    out = []
    for d, text in docs:
        w = words_of(text)
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := tuple(w[k: k + n])) in windows:
                    hit[k: k + n] = [True] * n
                    found |= windows[own]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d if d is not None else -1, len(w), sum(hit), len(found), sha, any(hit)))
    return sorted(out)


def tables(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "the", "É", "naïve", "x9", "of"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 7, 12, 20])))) for i in range(25)]
    items += [(100, items[3][1].upper()), (101, None), (102, ""), (103, " . "), (104, "a a a a a a a a"), (105, "nowhere else")]
    docs = []
    for d in range(90):
        own = []
        for _ in range(rng.randint(0, 4)):
            own += rng.choices(vocabulary, k=rng.randint(0, 12))
            if rng.random() < 0.4:
                w = (rng.choice(items)[1] or "").split()
                a = rng.randint(0, max(0, len(w) - 4))
                own += w[a:]
        docs.append((d, "".join(w + rng.choice([" ", ", ", "--", "\x00", "\n"]) for w in own)))
    docs += [(500, None), (501, ""), (502, "!!"), (None, items[5][1]), (None, "clean words only"), (7, items[6][1]), (503, "a " * 40)]
    return docs, items


def run(spark, docs, items, size):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("term", F.lit("own"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("phrase", F.lit(1))
    rows = P.decontaminate(spark, d, i, size).drop("sig").collect()
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in rows)


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 10), (3, 1)])
def test_hits_equal_brute_force(spark, seed, size, monkeypatch):
    monkeypatch.setattr("playlake.llm.words.SLICE_ROWS", 8)
    docs, items = tables(seed)
    got = run(spark, docs, items, size)
    monkeypatch.setattr(P, "PHRASES", 40)
    assert run(spark, docs, items, size) == got  # looked up in several blocks of phrases
    assert got == brute(docs, items, size) and any(r[5] for r in got) and not all(r[5] for r in got)


def test_empty_tables(spark):
    docs, items = tables(4)
    assert run(spark, [], items, 4) == []
    assert run(spark, docs, [], 4) == brute(docs, [], 4)


def test_only_contaminated_rows_go(spark):
    docs, items = tables(5)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("sig", F.lit(3)).withColumn("block", F.lit("b"))
    got = P.drop_contaminated(spark, d, spark.createDataFrame(items, "item_id long, text string"), 4)
    assert got.columns == d.columns
    flags = [r[5] for r in (brute([x], items, 4)[0] for x in docs)]
    want = sorted((x[0] or -1, x[1] or "") for x, bad in zip(docs, flags, strict=True) if not bad)
    assert sorted((r.doc_id or -1, r.text or "") for r in got.collect()) == want


def test_proximity_finds_scattered_terms(spark):
    docs = [(1, "red x x blue x green"), (2, "green red blue"), (3, "red x x x x x x x blue green"), (4, "red blue"), (5, "blue"), (6, "green red")]
    index = P.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).cache()
    phrases = spark.createDataFrame([("p", ["red", "blue", "green"])], "phrase string, terms array<string>")
    found = P.matches(spark, index, phrases, span=6).join(P.documents_of(index), ["block", "ord"])
    assert sorted(r.doc_id for r in found.collect()) == [1, 2]
