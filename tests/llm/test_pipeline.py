"""The pipeline's stages against brute-force versions, each on its own input."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

import corpus_pipeline as C
from playlake.llm import common, toxicity
from tests.llm.test_debruijn import WORD
from tests.llm.test_debruijn import brute as spans_by_force
from tests.llm.test_hyperminhash import brute as components_by_force
from tests.llm.test_phrase_index import brute as leaks_by_force
from tests.llm.test_toxicity import BAD


def tables(spark, folder):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "th an on".split() for b in "ing ed ly ou".split() for c in "er st re al um".split()]
    items = [(i, " ".join(rng.choices(vocabulary, k=25))) for i in range(4)]
    passage = rng.choices(vocabulary, k=60)
    docs = []
    for d in range(240):
        words = rng.choices(vocabulary, k=rng.randint(30, 120))
        if d % 12 == 0:
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        if d % 15 == 1:
            words[10:10] = items[d % 4][1].split()[3:20]
        if d % 9 == 2:
            words[5:5] = passage
        docs.append((d, " ".join(words), "en", "s", 0))
    for d in range(240, 300):
        words = docs[rng.randrange(240)][1].split()
        words[rng.randrange(len(words))] = "changed"
        docs.append((d, " ".join(words), "en", "s", 0))
    docs += [(400, None, None, None, None), (401, "", "en", "s", 0), (402, "short", "fr", "s", 5)]
    docs = [(d, t, lang, s, n if t is None else len(t)) for d, t, lang, s, n in docs]
    labels = [(d, 1, int(d % 12 == 0)) for d in range(0, 240, 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_each_stage_equals_its_brute_force(spark, tmp):
    docs, items = tables(spark, tmp)
    frame = common.table(spark, tmp, "documents")
    rows = {r[0]: r for r in docs}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, frame, tmp)
        if name != "sentencepiece":
            assert out.columns == frame.columns
        stage_rows = out.collect()
        own = {r.doc_id: tuple(r) for r in stage_rows}
        assert len(own) == len(stage_rows)
        if name == "toxicity":
            model = toxicity.train(spark, frame, common.table(spark, tmp, "labels"))
            assert set(own) == {d for d, r in rows.items() if model.severity([r[1]]).sum() < toxicity.REJECT}
            clean = {d for d, r in rows.items() if not set((r[1] or "").split()) & set(BAD)}
            assert clean <= set(own) and len(set(own) - clean) <= 2 < len(rows) - len(own)
        elif name == "near_duplicates":
            groups = components_by_force(list(rows.values()), size=5)
            assert set(own) == {d for d, c in groups.items() if c == d} and len(own) < len(rows)
        elif name == "substring_dedup":
            want = spans_by_force([(d, r[1]) for d, r in rows.items()], 20)
            assert set(own) == set(rows) and sum(w[1] for w in want.values()) > 0
            for d, r in own.items():
                assert WORD.findall(r[1] or "") == want[d][3] and r[2:4] == rows[d][2:4]
                assert r[4] == (None if r[1] is None else len(r[1]))
                assert want[d][1] or r[1] == rows[d][1]
        elif name == "decontamination":
            flags = {r[0]: r[5] for r in leaks_by_force([(d, r[1]) for d, r in rows.items()], items, 10)}
            assert set(own) == {d for d in rows if not flags[d]} and len(own) < len(rows)
        else:
            assert {d: r[1] for d, r in own.items()} == {d: len(library.encode(r[1] or "")) for d, r in rows.items()}
        if name not in ("substring_dedup", "sentencepiece"):
            assert all(own[d] == rows[d] for d in own)
        rows = own
        out.write.parquet(f"{tmp}/out{k}")
        frame = spark.read.parquet(f"{tmp}/out{k}")


def test_run_applies_all_stages_and_cleans_up(spark, tmp):
    tables(spark, tmp)
    before = common.mark()
    got = C.run(spark, tmp)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < got.count() < 300
    assert common.mark() == before


@pytest.fixture
def batch_setting(spark):
    """The name of the setting that bounds Arrow batches, which starts at Spark's own value and gets its old one back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.unset(key)
    yield key
    spark.conf.set(key, old)


def test_stages_send_whole_texts_in_bounded_batches(spark, tmp, batch_setting):
    tables(spark, tmp)
    docs = spark.range(0, 30, 1, 1).selectExpr("id doc_id", "repeat('word ', 200000) text")
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    for _, stage in C.STAGES:
        spark.conf.unset(batch_setting)
        stage(spark, common.table(spark, tmp, "documents"), tmp)
        got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(got) >= 30_000_000 and max(got) < 14 << 20


def test_a_batch_size_that_the_user_has_set_stays(spark, batch_setting):
    spark.conf.set(batch_setting, "3m")
    common.bound_batches(spark)
    assert spark.conf.get(batch_setting) == "3m"
