"""Repeated spans against brute force over all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from playlake.llm import debruijn as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """{doc_id: (n_words, n_removed, kept words)} for distinct doc_ids."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i: i + size])
            if window in seen:
                gone[i: i + size] = [True] * size
            seen.add(window)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[d] = (len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    return out


def corpus(seed, size):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "\x00", "w x", " ", "the", "end."] + [f"w{i}" for i in range(40)]
    passages = [rng.choices(vocabulary, k=rng.randint(size - 2, 3 * size)) for _ in range(6)]
    rows = []
    for d in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(0, 15))
            if rng.random() < 0.1:
                words += ["a"] * rng.randint(1, 3 * size)
        rows.append((d * 3, "".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "one"), (1004, rows[5][1]), (-7, rows[9][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,size,gram", [(1, 8, 3), (2, 20, 7), (3, 4, 4), (4, 5, 2)])
def test_digests_equal_brute_force(spark, seed, size, gram, monkeypatch):
    monkeypatch.setattr("playlake.llm.words.SLICE_ROWS", 9)
    rows = corpus(seed, size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in D.remove_repeats(spark, docs, size, gram, digest=True).collect()}
    assert got == {d: x[:3] for d, x in brute(rows, size).items()}
    assert sum(x[1] for x in got.values()) > 100


def test_text_keeps_what_is_not_covered(spark):
    rows = corpus(5, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("own")).withColumn("sig", F.col("doc_id"))
    got = D.remove_repeats(spark, docs, 8, 3)
    assert got.columns == docs.columns
    want, texts = brute(rows, 8), dict(rows)
    for r in got.collect():
        assert WORD.findall(r.text or "") == want[r.doc_id][3] and r.spans == "own" and r.sig == r.doc_id
        if not want[r.doc_id][1]:
            assert r.text == texts[r.doc_id]


def test_spans_name_their_sources(spark):
    base = [f"w{i}" for i in range(70)]
    rows = [(1, " ".join(base)), (2, " ".join(["x", "y", *base[5:60], "z"])), (3, " ".join(base[40:]))]
    got = D.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.start, r.len, r.src_doc, r.src_start) for r in got) == [(2, 2, 36, 1, 5), (3, 0, 11, 1, 40)]


def test_repeated_ids_missing_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (2, "quite another text")]
    got = D.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, text), (1, text), (1, text), (2, "more"), (2, "quite another text")])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert D.remove_repeats(spark, none).count() == 0 and D.remove_repeats(spark, none, digest=True).count() == 0


def test_very_long_text(spark):
    text = " ".join(str(i % 997) for i in range(60_000))
    rows = [(1, text), (2, "short")]
    got = {r.doc_id: r.n_removed for r in D.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), digest=True).collect()}
    assert got == {1: 60_000 - 997, 2: 0}


def test_edges_of_a_frequent_phrase_are_dealt_to_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(D, "HOT_EDGES", 50)
    monkeypatch.setattr("playlake.llm.words.SLICE_ROWS", 40)
    rng = random.Random(6)
    phrase = [f"often{k}" for k in range(9)]
    rows = corpus(6, 20)
    for d in range(200):  # a phrase between words that differ, and a few passages that hold it
        around = [[f"w{rng.randrange(5000)}" for _ in range(15)] for _ in range(2)]
        rows.append((2000 + d, " ".join([*around[0], *phrase, *around[1]])))
        if d % 20 == 0:
            rows.append((3000 + d, rows[-1][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    hot = D.hot_minimizers(docs).toPandas().sort_values("anchor")
    assert len(hot) and hot["parts"].max() > 3
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in D.remove_repeats(spark, docs, digest=True).collect()}
    assert got == {d: x[:3] for d, x in brute(rows, 20).items()}
    plain = D.edge_runs(docs).groupBy("anchor").agg(F.sum(F.length("windows")).alias("n")).agg(F.max("n")).first()[0]
    split = D.edge_runs(docs, hot=(hot["anchor"].to_numpy(), hot["parts"].to_numpy()))
    assert 3 * split.groupBy("anchor").agg(F.sum(F.length("windows")).alias("n")).agg(F.max("n")).first()[0] < plain


def test_equal_rows_of_one_document_keep_their_spans_once(spark):
    words = [f"w{i}" for i in range(60)]
    first, later = " ".join(words), " ".join(["x"] + words[:40] + ["y"])
    docs = spark.createDataFrame([(1, first)] + [(2, later)] * 50, "doc_id long, text string").repartition(4)
    spans = D.repeated_spans(docs).collect()
    assert [(r.doc_id, r.start, r.len, r.src_doc, r.src_start) for r in spans] == [(2, 1, 21, 1, 0)]
    got = D.remove_repeats(spark, docs, digest=True).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in got) == [(1, 0, 0)] + [(2, 40, 1)] * 50
