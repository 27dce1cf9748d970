"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an under-partitioned input before CPU-heavy row work.

    A scan of files with few row groups yields few tasks, which leaves cores
    idle for whole-text regexes, hashing or JSON parsing. When the scan
    already has at least ``min_partitions`` (default: the cluster's default
    parallelism) partitions, as any large dataset does, this is a no-op and
    adds no shuffle. Planning the partition count runs no job.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (e.g. a remote client): leave as is
        return df
    return df if current >= target else df.repartition(target)
