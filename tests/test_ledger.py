"""The ledger of replies: nothing answered is asked again."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from playlake.operators import ledger


def counting(log, fail_on=None, flag=None):
    """Replies with the prompt in brackets; writes down every media_id asked; raises on ``fail_on`` until ``flag`` exists."""
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        if fail_on is not None and fail_on in set(batch["media_id"]) and not os.path.exists(flag):
            raise ValueError("quota")
        with open(log, "a") as f:
            f.write("".join(f"{m}\n" for m in batch["media_id"]))
        return pd.DataFrame({"media_id": batch["media_id"], "raw_response": "[" + batch["prompt"] + "]", "latency_ms": 5,
                             "input_tokens": batch["prompt"].str.len(), "output_tokens": 1})

    return run


def asked(log):
    return [int(x) for x in open(log).read().split()] if os.path.exists(log) else []


def test_a_failed_run_is_resumed_for_missing_rows_only(spark, tmp):
    log, flag, path = (os.path.join(tmp, x) for x in ("log", "flag", "ledger"))
    cands = spark.range(1, 1001, 1, 1).select(F.col("id").alias("media_id"), F.concat(F.lit("p"), "id").alias("prompt"))
    model = counting(log, 500, flag)
    with pytest.raises(ledger.ClassifierFailed, match="quota"):
        ledger.classify(cands, model, "m", path, batch_rows=10, waves=2)
    first = asked(log)
    stored = ledger.replies(spark, path).count()
    assert stored == len(first) == len(set(first)) > 0
    open(flag, "w").close()
    out = ledger.classify(cands, model, "m", path, batch_rows=10, waves=2)
    assert out.count() == 1000 and out.filter("raw_response = concat('[p', media_id, ']')").count() == 1000
    assert sorted(asked(log)) == list(range(1, 1001))  # each once, over both runs
    ledger.classify(cands, model, "m", path)
    assert len(asked(log)) == 1000
    ledger.classify(cands.limit(3), model, "other", path)
    assert len(asked(log)) == 1003  # another model has its own replies


def test_equal_null_and_repeated_prompts(spark, tmp):
    log, path = os.path.join(tmp, "log"), os.path.join(tmp, "ledger")
    rows = [(3, "same"), (2, "same"), (2, "same"), (4, None), (None, "alone"), (5, ""), (6, "x" * 200000)]
    cands = spark.createDataFrame(rows, "media_id long, prompt string").withColumn("key", F.lit("clash")).withColumn("model", F.lit(1))
    out = ledger.classify(cands, counting(log), "m", path).collect()
    assert sorted(asked(log)) == [-1, 2, 4, 6]
    got = sorted(((r.media_id or 0, r.raw_response[:6]) for r in out))
    assert got == [(0, "[alone"), (2, "[same]"), (2, "[same]"), (3, "[same]"), (4, "[]"), (5, "[]"), (6, "[xxxxx")]


def test_empty_input_and_missing_replies(spark, tmp):
    path = os.path.join(tmp, "ledger")
    none = spark.createDataFrame([], "media_id long, prompt string")
    assert ledger.classify(none, counting(os.path.join(tmp, "log")), "m", path).count() == 0
    cands = spark.createDataFrame([(1, "a"), (2, "b")], "media_id long, prompt string").coalesce(1)

    def only_first(batch):
        return counting(os.path.join(tmp, "log"))(batch)[lambda d: d["media_id"] == 1]

    with pytest.raises(ledger.ClassifierFailed, match="no reply"):
        ledger.classify(cands, only_first, "m", path)
    assert ledger.replies(spark, path).count() <= 1


def test_two_runs_at_once_give_one_reply_a_key(spark, tmp):
    path = os.path.join(tmp, "ledger")
    key = ledger.prompt_key("m", F.lit("a"))
    for at, reply in (("2025-01-02", "late"), ("2025-01-01", "early")):
        spark.range(1).select(key.alias("key"), F.lit("m").alias("model"), F.lit(reply).alias("raw_response"), F.lit(1).cast("long").alias("latency_ms"),
                              F.lit(1).cast("long").alias("input_tokens"), F.lit(1).cast("long").alias("output_tokens"),
                              F.lit(at).cast("timestamp").alias("answered_at")).write.mode("append").parquet(path)
    cands = spark.createDataFrame([(7, "a")], "media_id long, prompt string")
    assert [r.raw_response for r in ledger.classify(cands, None, "m", path).collect()] == ["early"]
