"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playlake.llm import (
    debruijn,
    divergence,
    html_templates,
    hyperminhash,
    langid,
    line_frequency,
    perspectives,
    phrase_index,
    piece_counts,
    prefix_trie,
    shingle_join,
    sp_codec,
    toxicity,
)
from playlake.llm.common import table
from playlake.llm.oracles import ORACLE  # noqa: F401  (the others are tested against brute force, the libraries or held-out rows)


def op1_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extract(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.render(spark, table(spark, sf_dir, "conversations"))


def op4_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(spark, table(spark, sf_dir, "documents"), size=20, digest=True).drop("n_spans")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(spark, table(spark, sf_dir, "documents"))


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.quality(spark, table(spark, sf_dir, "documents"))


def op8_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("sig")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(spark, table(spark, sf_dir, "documents"), size=4, threshold_pct=80)


def op11_adaptive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_sets(spark, table(spark, sf_dir, "documents"), size=4, pct=85)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark, table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_templates, op2_toxicity, op3_perspectives, op4_sentencepiece_codec, op5_debruijn_spans, op6_language_id,
        op7_line_frequency, op8_phrase_index, op9_token_counts, op10_hyperminhash,
        op11_adaptive_prefixes, op12_source_divergence, op13_prefix_trie,
    )
}
