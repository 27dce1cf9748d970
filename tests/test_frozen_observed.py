"""Fingerprints by key bucket, drift from them, and checks measured on the write."""

import os

from pyspark.sql import functions as F

from playlake.operators import frozen, observed, quality


def prints(df, keys=("a",), digits=1):
    return sorted(tuple(r) for r in frozen.bucket_prints(df, list(keys), digits).collect())


def test_values_cannot_change_places(spark):
    schema = "a string, b string"
    one = spark.createDataFrame([("1\nb=2", "3")], schema)
    two = spark.createDataFrame([("1", "2\nb=3")], schema)
    assert {p[2] for p in prints(one, ["b"])} != {p[2] for p in prints(two, ["b"])}
    texts = [("", None), (None, ""), ("!;b", None), ("a=1:x;", "y"), (None, None), ("1:x", "y"), ("x;b=1:y", "")]
    rows = spark.createDataFrame(texts, schema).select(frozen.row_text(["a", "b"]).alias("t"))
    assert rows.distinct().count() == len(texts)


def test_prints_ignore_order_and_add_up(spark):
    rows = [(i % 50, None if i % 7 == 0 else f"v{i % 13}") for i in range(400)]
    whole = spark.createDataFrame(rows, "a int, b string")
    assert prints(whole) == prints(whole.repartition(7).orderBy(F.desc("b")))
    part = lambda lo, hi: frozen.bucket_prints(spark.createDataFrame(rows[lo:hi], "a int, b string"), ["a"], 1)
    assert sorted(map(tuple, frozen.combine(part(0, 150).unionByName(part(150, 400))).collect())) == prints(whole)
    assert prints(whole.limit(0)) == []


def test_drift_reads_unequal_buckets_only(spark, tmp):
    path = os.path.join(tmp, "golden")
    rows = [(i, f"t{i}", None if i % 9 == 0 else i / 3) for i in range(300)] + [(None, "no key", 1.0), (7, "t7", 7 / 3)]
    schema = "a int, b string, c double"
    table = spark.createDataFrame(rows, schema)
    frozen.freeze(table, ["a"], path)
    assert frozen.drift(spark, path, table.repartition(5), ["a"]).count() == 0
    changed = [(a, "new" if a == 5 else b, c) for a, b, c in rows if a != 11] + [(1000, "more", None)] * 3
    actual = spark.createDataFrame(changed, schema)
    got = frozen.drift(spark, path, actual, ["a"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, quality.drift(table, actual).collect())) and got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    wanted = {r[0] for r in spark.createDataFrame([(5,), (11,), (1000,)], "a int").select(frozen.key_bucket(["a"])).collect()}
    assert "PartitionFilters: [_bucket" in plan and all(w in plan for w in wanted)
    assert {r[0] for r in frozen.unequal(frozen.bucket_prints(table, ["a"]), frozen.bucket_prints(actual, ["a"])).collect()} == wanted
    assert "Scan parquet" not in frozen.drift(spark, path, table, ["a"])._jdf.queryExecution().executedPlan().toString()  # equal: no rows read


def test_checks_on_the_write(spark, tmp):
    path = os.path.join(tmp, "mart")
    df = spark.createDataFrame([(1, 5.0), (2, None), (None, 50.0), (2, 7.0)], "k int, v double").repartition(3)
    rules = {"v_bound": F.col("v").between(0, 10)}
    out = observed.write(df, path, "mart", ["k", "v"], rules)
    assert [(r.test, r.column_name, r.failures, r.passed) for r in out.orderBy("test_order").collect()] == [
        ("not_null", "k", 1, False), ("not_null", "v", 1, False), ("bounds", "v_bound", 2, False)]
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and quality.bounds_checks(stored, rules).first().v_bound == 2
    full = observed.suite(out, [quality.Check("unique", "mart", "k", stored)]).orderBy("test_order").collect()
    assert [(r.test_order, r.test, r.failures) for r in full][-1] == (3, "unique", 1)
    empty = observed.write(df.limit(0), path, "mart", ["k"], rules).collect()
    assert all(r.passed and r.failures == 0 for r in empty) and len(empty) == 2
    assert observed.write(df, path, "mart").count() == 0
