"""SNK-3 / STR-11 on paths: only the buckets of incoming keys are rewritten, commits are one rename."""

import os
import random

import pytest
from pyspark.sql import functions as F

from playlake.sources import bronze

def order():
    return [F.col("ver").desc()]

SCHEMA = "k long, v string, ver long"


def files(base):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, ns in os.walk(f"{base}/data") for n in ns if n.endswith(".parquet")}


def named(spark, base):
    return bronze._manifest(spark, base, bronze.current_version(spark, base))["parts"]


def test_ten_keys_into_a_million_rows_rewrite_ten_buckets(spark, tmp):
    base = os.path.join(tmp, "t")
    rows = spark.range(1_000_000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).cast("long").alias("ver"))
    bronze.upsert_path(spark, base, rows, ["k"], order(), buckets=128)
    before, parts = files(base), named(spark, base)
    assert len(parts) == 128
    keys = list(range(5, 1_000_000, 111_111)) + [2_000_000]
    bronze.upsert_path(spark, base, spark.createDataFrame([(k, "new", 1) for k in keys], SCHEMA), ["k"], order())
    after = files(base)
    assert {f: after[f] for f in before} == before  # no old file was touched
    changed = [b for b, folder in named(spark, base).items() if folder != parts[b]]
    assert 1 <= len(changed) <= 10
    assert len({f for f in after if f not in before}) <= 2 * len(changed)
    table = bronze.read_versioned(spark, base)
    assert table.count() == 1_000_001 and sorted(r.k for r in table.filter("v = 'new'").collect()) == sorted(keys)


def test_lost_writer_leaves_the_old_table(spark, tmp, monkeypatch):
    base = os.path.join(tmp, "t")
    bronze.upsert_path(spark, base, spark.createDataFrame([(1, "a", 0), (2, "b", 0)], SCHEMA), ["k"], order())

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(bronze, "_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            bronze.upsert_path(spark, base, spark.createDataFrame([(1, "lost", 9)], SCHEMA), ["k"], order())
    assert sorted(map(tuple, bronze.read_versioned(spark, base).collect())) == [(1, "a", 0), (2, "b", 0)]
    assert bronze.upsert_path(spark, base, spark.createDataFrame([(1, "c", 9)], SCHEMA), ["k"], order()) == 1
    assert sorted(map(tuple, bronze.read_versioned(spark, base).collect())) == [(1, "c", 9), (2, "b", 0)]
    assert any("data/" in p for p in bronze.vacuum(spark, base, keep=1))
    assert sorted(map(tuple, bronze.read_versioned(spark, base).collect())) == [(1, "c", 9), (2, "b", 0)]
    assert bronze.vacuum(spark, base, keep=1) == []


def test_two_writers_of_one_version(spark, tmp):
    base = os.path.join(tmp, "t")
    bronze.upsert_path(spark, base, spark.createDataFrame([(1, "a", 0)], SCHEMA), ["k"], order())
    with pytest.raises(RuntimeError, match="another writer"):
        bronze._commit(spark, base, 0, {})
    with pytest.raises(ValueError, match="keyed by"):
        bronze.upsert_path(spark, base, spark.createDataFrame([(1, "a", 0)], SCHEMA), ["v"], order())


def test_random_upserts_equal_a_dictionary(spark, tmp):
    base, rng, want = os.path.join(tmp, "t"), random.Random(4), {}
    for step in range(5):
        rows = [(rng.randint(0, 40), f"s{step}", i) for i in range(rng.randint(0, 25))]
        bronze.upsert_path(spark, base, spark.createDataFrame(rows, SCHEMA), ["k"], order(), buckets=7)
        for k, v, ver in sorted(rows, key=lambda r: r[2]):
            want[k] = (k, v, ver)
        assert sorted(map(tuple, bronze.read_versioned(spark, base).collect())) == sorted(want.values())
    assert bronze.read_versioned(spark, base, version=0) is not None


def test_two_keys_and_nulls(spark, tmp):
    base, schema = os.path.join(tmp, "t"), "a long, b string, v string, ver long"
    bronze.upsert_path(spark, base, spark.createDataFrame([(1, "x", "p", 0), (1, None, "q", 0)], schema), ["a", "b"], order())
    bronze.upsert_path(spark, base, spark.createDataFrame([(1, "x", "r", 1)], schema), ["a", "b"], order())
    assert sorted((r.b or "", r.v) for r in bronze.read_versioned(spark, base).collect()) == [("", "q"), ("x", "r")]
