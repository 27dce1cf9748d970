"""ENR-2 with a ledger: a reply that was paid for is stored before anything can lose it.

The ledger is a Parquet table with one row for each (model, prompt), keyed by the SHA-256 of both. A run calls the
classifier only for keys the ledger lacks, in waves; a wave's replies are appended when it ends. A classifier that
raises ends its task's calls, not the wave: replies made before are stored, and only then is the error raised. A lost
executor repeats at most its part of one wave.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.operators.enrich import Classifier
from playlake.schemas import CLASSIFIER_OUTPUT
from playlake.session import scratch_path

REPLY = [f for f in CLASSIFIER_OUTPUT.fields if f.name != "media_id"]
LEDGER = T.StructType([T.StructField("key", T.StringType()), T.StructField("model", T.StringType()), *REPLY,
                       T.StructField("answered_at", T.TimestampType())])
_ATTEMPT = T.StructType([T.StructField("key", T.StringType()), *REPLY, T.StructField("error", T.StringType())])


class ClassifierFailed(RuntimeError):
    """The classifier raised, or left prompts without a reply; what it answered before is in the ledger."""


def prompt_key(model: str, prompt: Column) -> Column:
    """SHA-256 of the model's name, its length before it, and the prompt; NULL counts as the empty prompt."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}"), F.coalesce(prompt, F.lit(""))), 256)


def replies(spark: SparkSession, path: str) -> DataFrame:
    """One row for each key: the earliest reply, if two runs at once called for the same prompt. No ledger: no rows."""
    try:
        stored = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], LEDGER)
    first = F.min(F.struct("answered_at", *[f.name for f in REPLY])).alias("r")
    return stored.groupBy("key", "model").agg(first).select("key", "model", *[f"r.{f.name}" for f in REPLY], "r.answered_at")


def _attempt(classifier: Classifier, batch_rows: int):
    names = [f.name for f in REPLY]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = None
        for batch in batches:
            for at in range(0, len(batch), batch_rows):
                part = batch.iloc[at:at + batch_rows]
                answers: dict[int, tuple] = {}
                if failed is None:
                    try:
                        given = classifier(part[["media_id", "prompt"]].reset_index(drop=True))
                        answers = {row[0]: row[1:] for row in given[["media_id", *names]].itertuples(index=False, name=None)}
                    except Exception as e:  # noqa: BLE001 - kept as a value; the run raises once replies are stored
                        failed = f"{type(e).__name__}: {e}"
                rows = [(key, *answers[at_id], None) if at_id in answers else (key, *[None] * len(names), failed or "no reply")
                        for key, at_id in zip(part["key"], part["media_id"], strict=True)]
                yield pd.DataFrame(rows, columns=["key", *names, "error"], dtype=object)

    return run


def classify(cands: DataFrame, classifier: Classifier, model: str, path: str, batch_rows: int = 100, waves: int = 8) -> DataFrame:
    """Rows of CLASSIFIER_OUTPUT for every row of ``cands`` (media_id, prompt), answered from the ledger at ``path``.

    Equal prompts are called for once, under the smallest media_id of those that ask; a prompt whose media_ids are all NULL
    is called for under -1. Rows that repeat keep their number. The classifier gets at most ``batch_rows`` rows a call.
    If calls fail, ``ClassifierFailed`` is raised after the wave's good replies are stored, and the next run calls for
    the missing prompts only. An empty ``cands`` calls for nothing and adds nothing.
    """
    spark = cands.sparkSession
    keyed = cands.select("media_id", "prompt").withColumn("key", prompt_key(model, F.col("prompt")))
    asked = keyed.groupBy("key").agg(F.coalesce(F.min("media_id"), F.lit(-1)).cast("long").alias("media_id"),
                                     F.coalesce(F.any_value("prompt"), F.lit("")).alias("prompt"))
    todo = asked.join(replies(spark, path).select("key"), "key", "left_anti")
    work = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    wave = F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.lit(waves)).cast("int")
    todo.withColumn("wave", wave).write.partitionBy("wave").parquet(f"{work}/todo")
    try:
        for (number,) in sorted(spark.read.schema(_todo()).parquet(f"{work}/todo").select("wave").distinct().collect()):
            part = spark.read.schema(_todo()).parquet(f"{work}/todo").filter(F.col("wave") == number).drop("wave")
            part.mapInPandas(_attempt(classifier, batch_rows), _ATTEMPT).write.parquet(f"{work}/wave-{number}")
            tried = spark.read.schema(_ATTEMPT).parquet(f"{work}/wave-{number}")
            good = tried.filter(F.col("error").isNull())
            good.select("key", F.lit(model).alias("model"), *[f.name for f in REPLY],
                        F.current_timestamp().alias("answered_at")).write.mode("append").parquet(path)
            bad = tried.groupBy().agg(F.count("error").alias("n"), F.min("error").alias("why")).first()
            if bad["n"]:
                raise ClassifierFailed(f"{bad['n']} prompts of wave {number} have no reply: {bad['why']}")
    finally:
        _delete(spark, work)
    held = replies(spark, path).filter(F.col("model") == model)
    return keyed.join(held, "key").select(*[f.name for f in CLASSIFIER_OUTPUT.fields])


def _todo() -> T.StructType:
    return T.StructType([T.StructField("key", T.StringType()), T.StructField("media_id", T.LongType()),
                         T.StructField("prompt", T.StringType()), T.StructField("wave", T.IntegerType())])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
