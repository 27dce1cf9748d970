"""Held-out decisions on texts whose bad words the test put in, and the shape of the model."""

import random

import numpy as np
from pyspark.sql import functions as F

from playlake.llm import toxicity as T

BAD = ["vileword", "slurword", "badword"]


def rows(seed, n=600):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "th an on re st er".split() for b in "ing ed ly ou ea".split()]
    docs, truth = [], {}
    for d in range(n):
        w = rng.choices(words, k=rng.randint(20, 200)) + [f"rare{rng.randrange(5000)}" for _ in range(20)]
        w = [x if x.isalpha() else "".join(chr(97 + int(c)) if c.isdigit() else c for c in x) for x in w]
        truth[d] = rng.random() < 0.15
        if truth[d]:
            for _ in range(rng.randint(2, 8)):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        docs.append((d, " ".join(w)))
    return docs, truth


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("severity", F.lit("own")).withColumn("toxic", F.lit(7)),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_unlabelled_toxic_rows_are_found_and_clean_ones_left(spark):
    docs, truth = rows(1)
    docs += [(9000, None), (9001, ""), (None, "vileword badword slurword"), (9002, "clean " * 30_000)]
    labels = [(d, 1, int(truth[d])) for d in range(300)] + [(5, 0, None), (None, 1, 1), (77777, 1, 1), (3, 1, int(truth[3]))]
    d, y = frames(spark, docs, labels)
    kept = T.drop_toxic(spark, d, y)
    assert kept.columns == d.columns
    gone = {r[0] for r in docs} - {r.doc_id for r in kept.collect()}
    bad = {i for i, toxic in truth.items() if toxic} | {None}
    assert gone <= bad and len(gone) >= 0.95 * len(bad)  # no clean row goes
    scored = T.score(d, T.train(spark, d, y)).collect()
    assert len(scored) == len(docs)
    for r in scored:
        assert 0 <= r.severity <= T.GRADES and r.p1 >= r.p2 >= r.p3 and abs(r.severity - (r.p1 + r.p2 + r.p3)) < 1e-9
        assert r.toxic == (r.doc_id in gone)


def test_without_both_labels_nothing_is_rejected(spark):
    docs, _ = rows(2, 20)
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1)]):
        d, y = frames(spark, docs, labels)
        assert T.drop_toxic(spark, d, y).count() == 20
    d, y = frames(spark, [], [])
    assert T.drop_toxic(spark, d, y).count() == 0


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(1)
    x = rng.random((800, 6)) < 0.4
    latent = x @ np.array([3.0, 2.0, 1.0, 0, 0, 0]) + rng.logistic(0, 0.5, 800)
    grade = (latent > 1.5).astype(int) + (latent > 3.0) + (latent > 4.5)
    w, theta = T.fit([np.flatnonzero(r) for r in x], grade, 6)
    assert (np.diff(theta) > 0).all() and w[0] > w[1] > w[2] > abs(w[3:]).max()
    model = T.Model({f"w{i}x": v for i, v in enumerate(w)}, theta.tolist())
    assert (np.diff(model.severity(["none", None]), axis=1) <= 0).all()
