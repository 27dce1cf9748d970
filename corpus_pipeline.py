"""From documents to a cleaned, tokenised corpus in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents:

1. ``toxicity`` drops documents whose expected severity reaches the rejection level;
2. ``near_duplicates`` keeps one document of each group (five-word shingles, similarity 0.8);
3. ``substring_dedup`` cuts words covered by 20-word windows that start earlier in the corpus;
4. ``decontamination`` drops documents that hold a 10-word window of a benchmark item;
5. ``sentencepiece`` encodes what is left, decodes it again, and returns the digests.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import debruijn, hyperminhash, phrase_index, sp_codec, toxicity
from playlake.llm import common
from playlake.session import ensure_checkpoint_dir

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.bound_batches(spark)
    return toxicity.drop_toxic(spark, docs, common.table(spark, sf_dir, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.bound_batches(spark)
    return hyperminhash.keep_one(spark, docs, size=5, threshold_pct=80)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the text that is left; a text left as it was keeps its n_chars."""
    common.bound_batches(spark)
    cut = debruijn.remove_repeats(spark, docs.withColumn("_full", F.length("text")), size=20)
    same = F.length("text").eqNullSafe(F.col("_full"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return cut.drop("_full")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.bound_batches(spark)
    return phrase_index.drop_contaminated(spark, docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.bound_batches(spark)
    return sp_codec.digests(docs, MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("substring_dedup", cut_repeated_spans),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode),
]

#: SQL expresses neither the trained stage nor the encoding; tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; intermediate tables are deleted once the next stage is written."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        since = common.mark()
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        common.clean(spark, since)
        docs = spark.read.parquet(path)
    return docs
