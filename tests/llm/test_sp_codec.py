"""Ids and decoded texts against the library; spans and the character map against properties."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playlake.llm import sp_codec as S
from playlake.llm import words as W

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", "   a", "a   ", "▁", "▁▁x", "<s>", "<0x41>", "<unk> </s>", "\x00", "a\x00b", "\n\n\n", "\t", "é", "é",
       "漢字かな", "😀👩‍👩‍👧", "​", "﻿x", "a" * 3000, " " * 300, "ab " * 500, "\r\n", " x", "ﬁ ½ ①"]


def check(text):
    codec = S.codec(MODEL)
    ids, spans = codec.encode(text)
    assert ids == LIBRARY.encode(text)
    assert codec.decode(ids) == LIBRARY.decode(ids)
    raw = text.encode()
    if ids:
        assert spans[0, 0] == 0 and spans[-1, 1] == len(raw) and (spans[1:, 0] == spans[:-1, 1]).all()
        for i, (a, b) in zip(ids, spans, strict=True):
            own = codec.surface[i]
            assert raw[a:b].replace(S.SPACE.encode(), b" ") in (own, own[1:] if own[:1] == b" " else own)


def test_odd_texts():
    for text in ODD:
        check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab the.\n▁ é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    check(text)


def test_spark_rows_equal_the_library(spark):
    rng = random.Random(3)
    rows = list(enumerate([*ODD, None, *(" ".join(rng.choices(ODD, k=9)) for _ in range(50))])) + [(None, "x"), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.spanned) for r in S.digests(docs, MODEL).collect())
    want = []
    for d, t in rows:
        ids = LIBRARY.encode(t or "")
        want.append((d or -1, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)), len((t or "").encode())))
    assert got == sorted(want)


def test_round_trip(spark):
    rows = list(enumerate(ODD)) + [(99, None)]
    back = S.decode(S.encode(spark.createDataFrame(rows, "doc_id long, text string"), MODEL), MODEL).collect()
    assert {r.doc_id: r.text for r in back} == {d: (t or "").replace("▁", " ") for d, t in rows}
    assert S.digests(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0


def trie(entries):
    """A double array over the given byte strings, laid out one node after the other (for the test only)."""
    units, strings, values = [0] * 65536, b"", {}
    for key, new in entries.items():
        values[key] = len(strings)
        strings += new + b"\0"
    used, free = {0}, [256]

    def place(node, prefix):
        nexts = sorted({k[len(prefix)] for k in entries if len(k) > len(prefix) and k.startswith(prefix)})
        base = free[0]
        free[0] += 256
        low = node ^ base
        # large offsets are stored shifted by eight
        assert low & 0xFF == 0 or low < 1 << 21
        offset = (low << 10) if low < 1 << 21 else (low >> 8 << 10) | 0x200
        units[node] |= offset | ((1 << 8) if prefix in values else 0)
        if prefix in values:
            units[base] = 0x80000000 | values[prefix]
        for c in nexts:
            units[base ^ c] |= c
            used.add(base ^ c)
            place(base ^ c, prefix + bytes([c]))

    place(0, b"")
    data = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(data)) + data + strings


def test_character_map_takes_the_longest_prefix_and_keeps_the_source():
    entries = {"ﬁ".encode(): b"fi", b"a": b"b", b"abc": b"Z", "é".encode(): "é".encode(), b"\t": b" "}
    normal = S.Normalizer(trie(entries), dummy_prefix=True, squeeze=False, escape=True)
    text, source = normal("abcab\tﬁéq")
    assert text == "▁Zbb▁fiéq"
    raw = text.encode()
    assert len(source) == len(raw) + 1 and source[-1] == len("abcab\tﬁéq".encode())
    assert source.tolist() == [0, 0, 0, 0, 3, 4, 5, 5, 5, 6, 6, 9, 9, 9, 11, 12]


def test_squeezing_keeps_single_inner_spaces():
    normal = S.Normalizer(b"", dummy_prefix=True, squeeze=True, escape=True)
    text, source = normal("  a   b ")
    assert text == "▁a▁b" and source.tolist() == [2, 2, 2, 2, 3, 3, 3, 6, 8]
    assert normal("   ")[0] == ""


def test_a_worker_keeps_neither_chunks_nor_powers_when_its_task_ends():
    codec = S.codec(MODEL)
    W.powers(10, W._MUL)
    batch = pa.record_batch({"text": [t for t in ODD for _ in range(40)]})
    parts, remembered = [], []
    for part in S._slices(iter([batch]), codec):
        parts += [codec.encode(t)[0] for t in part.column("text").to_pylist()]
        remembered.append(len(codec.young))
    assert parts == [LIBRARY.encode(t) for t in ODD for _ in range(40)] and len(remembered) > 1 and min(remembered) > 0
    assert not codec.young and not codec.old and codec.held == 0 and W._powers.cache_info().currsize == 0
    check("still the same")


def test_alignment_takes_four_bytes_a_place():
    source = S.codec(MODEL).normalizer.normalise("a b")[1]
    assert source.dtype == np.int32 and source.tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 3]
