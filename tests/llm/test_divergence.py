"""Source divergence against brute force, with copies, empty values and clashing columns."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from playlake.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def brute(rows, least, top):
    docs = [(lang or "", source or "", terms(text)) for _, text, lang, source in rows]
    df, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, t in docs:
        df[lang].update(set(t))
        count[lang, source].update(t)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = sorted({d[1] for d in docs if d[0] == lang})

        def share(held):
            total = sum(held[t] for t in kept)
            return {t: 1 + 10 ** 9 * (held[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(count[lang, s]) for s in sources}
        q = share(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(p[s][t] - q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", over, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"Wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["été", "ÉTÉ", "naïve", "日本", "x"]
    copies = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(4)]
    rows = []
    for i in range(n):
        text = rng.choice(copies) if rng.random() < 0.4 else rng.choice([None, "", "12 34!", " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))])
        rows.append((i, text, rng.choice(["de", "fr", "fr", None]), rng.choice(["a", "b", "b", "B", "z9", "", None])))
    return rows


def got(spark, docs):
    found = D.audit(spark, docs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("blocks", [{}, {"SIDE": 2, "TERMS": 7, "_CELLS": 50, "CHUNKS": 2}])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(D, "LEAST_DOCS", 12)
    monkeypatch.setattr(D, "TOP", 5)
    for name, value in blocks.items():
        monkeypatch.setattr(D, name, value)
    rows = corpus(3, 400)
    assert got(spark, spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows, 12, 5)


def test_copies_count_in_every_source(spark, monkeypatch):
    monkeypatch.setattr(D, "LEAST_DOCS", 3)
    rows = [(1, "alpha beta", "en", f"s{i % 7}") for i in range(60)] + [(2, "alpha gamma", "en", "s1")] * 3
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == brute(rows, 3, 50)


def test_copies_become_one_class(spark):
    rows = [(i, "one text", "en", f"s{i % 5}") for i in range(50)] + [(50, "one text", "de", "s0")]
    classes = D.collapse(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({(r["lang"], bytes(r["digest"])) for r in classes}) == 2
    held = [(r["lang"], h["source"], h["n"]) for r in classes for h in r["held"]]
    assert sorted(held) == [("de", "s0", 1), *[("en", f"s{i}", 10) for i in range(5)]]


def test_groups_without_terms(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "one", "en", "b")]
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_very_long_text_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(D, "LEAST_DOCS", 1)
    long = " ".join(f"t{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(300_000))
    rows = [(1, long, "en", "a"), (2, "tab tbb", "en", "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "n", "docs", "digest", "held", "rank", "item", "value", "part", "p"):
        docs = docs.withColumn(name, F.lit("x"))
    assert got(spark, docs) == brute(rows, 1, 50)


def test_empty_table(spark):
    assert got(spark, spark.createDataFrame([], SCHEMA)) == []
