"""Held-out accuracy, rejection and the defined cases of language prediction."""

import random
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from playlake.llm import langid as L

SYLLABLES = {
    "en": "the th ing er ou and tion ly".split(), "fr": "é le que eux oi la ment tre".split(),
    "de": "ü sch ung ein keit pf der lich".split(), "es": "ñ ción os la ll que es mente".split(),
}


def rows(seed, n=400):
    rng = random.Random(seed)
    out = []
    for d in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 120))]
        out.append((d, " ".join(words), lang if rng.random() < 0.9 else None, lang))
    return out


def run(spark, data):
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, truth string").withColumn("source", F.lit("x"))
    return L.languages(spark, docs.withColumn("buckets", F.lit(1)))


def test_held_out_rows_are_predicted(spark):
    data = rows(1) + [(9000, None, "en", None), (9001, "", "en", None), (9002, "12 34 !?", "fr", None), (None, "the and ing", "en", None), (9003, "тест", "en", None)]
    got = run(spark, data).collect()
    truth = {d: t for d, _, _, t in data}
    assert len(got) == len(data)
    held = [r for r in got if r.held_out and truth.get(r.doc_id)]
    assert len(held) > 60 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {9000, 9001, 9002} and all(r.rejected for r in got if r.doc_id in und)
    assert next(r for r in got if r.doc_id is None).lang_pred == "en"


def test_held_out_labels_are_never_learned(spark):
    data = rows(2)
    changed = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else lang, x) for d, t, lang, x in data]
    first = sorted(tuple(r) for r in run(spark, data).collect())
    assert sorted(tuple(r) for r in run(spark, changed).collect()) == first


def test_without_labels_and_without_rows(spark):
    got = run(spark, [(d, t, None, x) for d, t, _, x in rows(3, 20)]).collect()
    assert {r.lang_pred for r in got} == {"und"} and {r.score for r in got} == {0.0}
    assert run(spark, []).count() == 0


def test_subwords_do_not_cross_texts_or_words():
    one = pa.array(["ab cd", "Xy"])
    of, bucket = L.subwords(one)
    apart = [sorted(L.subwords(pa.array([t]))[1].tolist()) for t in ("ab cd", "Xy")]
    assert [sorted(bucket[of == k].tolist()) for k in (0, 1)] == apart
    assert sorted(L.subwords(pa.array(["ab  12 cd!"]))[1].tolist()) == apart[0]
    assert sorted(L.subwords(pa.array(["xY"]))[1].tolist()) == apart[1]


def test_letters_of_any_script():
    assert L.has_letter(pa.array(["a", "1", "é", "😀", "²", "漢", "", None])).tolist() == [True, False, True, False, False, True, False, False]


def test_training_rows_are_bounded_when_one_id_repeats(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_ROWS", 20)
    data = [(1, f"the thing {'er' * k}", "en", "en") for k in range(60)] + [(1, "the same row", "en", "en")] * 30 + rows(5, 10)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, truth string").repartition(4)
    got = L.training_counts(docs, F.lit(True)).collect()
    assert len(got) == 20 and len({(r.doc_id, r.sig) for r in got}) == 20
    few = spark.createDataFrame([(1, "the same row", "en", "en")] * 30, docs.schema).repartition(4)
    assert L.training_counts(few, F.lit(True)).count() == 1
