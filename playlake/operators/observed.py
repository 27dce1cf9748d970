"""DQ-2 / DQ-7 measured while a table is written: null checks and bounds cost no scan of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from playlake.operators.quality import Check, run_suite

RESULT = "test_order int, test string, model string, column_name string, failures long, passed boolean"


def write(df: DataFrame, path: str, model: str, not_null: Sequence[str] = (), rules: dict[str, Column] | None = None,
          mode: str = "overwrite") -> DataFrame:
    """Write ``df`` and return a row per check, as ``quality.run_suite`` does; rules are tests of kind 'bounds'.

    A rule that is NULL for a row fails there, as in ``quality.bounds_checks``. The counts are taken by the tasks that write the
    rows. A table without rows passes all its checks. Without checks the result has no rows.
    """
    checks = [("not_null", c, F.count_if(F.col(f"`{c.replace('`', '``')}`").isNull())) for c in not_null]
    checks += [("bounds", name, F.count_if(~F.coalesce(rule, F.lit(False)))) for name, rule in (rules or {}).items()]
    spark = df.sparkSession
    if not checks:
        df.write.mode(mode).parquet(path)
        return spark.createDataFrame([], RESULT)
    seen = Observation()
    df.observe(seen, *[count.alias(f"c{i}") for i, (_, _, count) in enumerate(checks)]).write.mode(mode).parquet(path)
    counts = seen.get
    return spark.createDataFrame(
        [(i, kind, model, name, counts.get(f"c{i}") or 0, not counts.get(f"c{i}")) for i, (kind, name, _) in enumerate(checks)], RESULT)


def suite(written: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """DQ-4 with the counts of ``write``: ``checks`` (unique, relationships) get their pass and follow the measured ones in order."""
    if not checks:
        return written
    rest = run_suite(checks)
    shift = written.groupBy().agg(F.count(F.lit(1)).cast("int")).first()[0]
    return written.unionByName(rest.withColumn("test_order", (F.col("test_order") + F.lit(shift)).cast("int")))
