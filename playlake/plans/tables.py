"""Readers for the driver's parquet tables."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The driver tables are read-only, so the scan relation (file listing and
# footer schema) is resolved once per session and path; every query still
# plans its own pruning and pushdown from it. A session's scans go with it.
_SCANS: weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    scans = _SCANS.setdefault(spark, {})
    if path not in scans:
        scans[path] = spark.read.parquet(path)
    return scans[path]
