"""Counts against the library's ids."""

import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playlake.llm import piece_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "   a", "a   ", "\n\n \n", "don't we'll I'VE 's", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext",
       "x²½ Ⅷ 123", "é́ naïve", "漢字 かな", "😀👩‍👧", "\x00\x1c\x1f\x85 ", "　 ​", "a" * 3000, " " * 300, "#$%&' ''ll"]


def whole(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def own(text):
    found, total = C.pre_tokens(text, C.specials(PATH))
    return total + sum(C.pieces(PATH, p) for p in found)


def test_odd_texts():
    for text in ODD:
        assert own(text) == whole(text), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab 's\n\t1<|endoftext>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    assert own(text) == whole(text)


def rows():
    rng = random.Random(2)
    out = list(enumerate([*ODD, *(" ".join(rng.choices(ODD, k=20)) for _ in range(60))]))
    return out + [(500, None), (None, "no id"), (3, "again"), (3, "again"), (600, "word " * 600)]


def run(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3).withColumn("pre", F.lit("own"))
    got = C.token_counts(spark, docs, PATH).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got)


def want():
    out = [(-1 if d is None else d, len((t or "").encode()), whole(t or "")) for d, t in rows()]
    return sorted((d, b, n, n > 512) for d, b, n in out)


def test_rows_equal_the_library(spark):
    assert run(spark) == want()


def test_tail_alone_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(C, "HEAD", 3)
    monkeypatch.setattr("playlake.llm.words.SLICE_ROWS", 5)
    assert run(spark) == want()


def test_empty_table(spark):
    assert C.token_counts(spark, spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
