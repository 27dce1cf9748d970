"""Global positions without a single-partition window (WIN-4, SRT-*, exact percentiles).

``row_number()`` over an un-partitioned window moves every row into one task.
Here the frame is range-partitioned on the full ordering (which must end in a
unique tie-break, so equal prefixes still split), sorted inside each
partition, numbered locally, and shifted by the row counts of the preceding
partitions. The offsets table has one row per partition, so broadcasting it
has a proven size bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_position(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "position",
    num_partitions: int | None = None,
    with_total: bool = False,
) -> DataFrame:
    """Add a dense 1-based ``name`` column following ``order`` across the whole frame.

    The range partition count defaults to the larger of the shuffle partition
    setting and the input's own partition count, so each range partition stays
    about the size of an input split (AQE cannot split an explicit range
    repartition later). The offsets table has one row per partition.
    """
    spark = df.sparkSession
    n = num_partitions or _partitions_for(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id()
    )
    # Range bounds come from sampling: pin them (and the ids) in reliable
    # storage so both uses below see the same partitioning, even after an
    # executor is lost.
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        name, (F.col("_off") + local + F.lit(1)).cast("long")
    )
    keep = [c for c in df.columns] + [name] + (["_total"] if with_total else [])
    return out.select(*keep)


def _partitions_for(df: DataFrame) -> int:
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        return max(base, df.rdd.getNumPartitions())
    except Exception:  # noqa: BLE001 - no RDD access (remote client)
        return base


def exact_percentile(df: DataFrame, value: str, p: float, alias: str | None = None) -> DataFrame:
    """Exact ``percentile(value, p)`` with linear interpolation, distributed.

    Equal values are counted first (combined on the map side), so only distinct
    values are sorted and stored. Rows with NULL ``value`` are ignored. Returns
    one row (NULL on no rows).
    """
    alias = alias or f"p{int(round(p * 100))}_{value}"
    counts = (
        df.select(F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
        .groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    )
    ranged = counts.repartitionByRange(F.col("_v")).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_pid").agg(F.sum("_n").alias("_s")).select(
        "_pid", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"),
        F.sum("_s").over(Window.partitionBy()).alias("_total"))
    within = Window.partitionBy("_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = ranged.withColumn("_cum", F.sum("_n").over(within)).join(F.broadcast(offsets), "_pid").select(
        "_v", "_n", (F.col("_off") + F.col("_cum")).alias("_last"), "_total")
    # the ranks lo and hi between which the percentile lies; a value holds the ranks (last - n, last]
    h = (F.col("_total") - 1).cast("double") * F.lit(float(p))

    def holds(rank: Column) -> Column:
        return (F.col("_last") - F.col("_n") < rank) & (rank <= F.col("_last"))

    lo, hi = F.floor(h) + 1, F.ceil(h) + 1
    return last.groupBy().agg(
        F.max(F.when(holds(lo), F.col("_v"))).alias("_lo"), F.max(F.when(holds(hi), F.col("_v"))).alias("_hi"),
        F.max(h - F.floor(h)).alias("_frac"),
    ).select((F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias(alias))
