"""DQ-5 / DQ-6 by key buckets: fingerprints that can be added up, and drift that reads only unequal buckets.

A row is written as ``name=length:value;`` (``name!;`` for NULL) for each column in order, which no other row of the
schema shares. A bucket's fingerprint is its row count and the exact sum of its rows' hashes, so the order and the layout of rows do not
matter and repeated rows count. Fingerprints of parts add up to those of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.operators import quality

ROWS, PRINTS = "rows", "prints"


def _name(c: str) -> Column:
    return F.col(f"`{c.replace('`', '``')}`")


def row_text(columns: Sequence[str]) -> Column:
    """All values of a row, each with its length before it."""
    parts = []
    for c in columns:
        v = _name(c).cast("string")
        parts.append(F.coalesce(F.concat(F.lit(f"{c}="), F.length(v).cast("string"), F.lit(":"), v, F.lit(";")), F.lit(f"{c}!;")))
    return F.concat(*parts)


def key_bucket(keys: Sequence[str], digits: int = 2) -> Column:
    """The first hex digits of the SHA-256 of the keys' text; 16 ** digits buckets, 65,536 at most."""
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    return F.substring(F.sha2(row_text(keys), 256), 1, digits)


def bucket_prints(df: DataFrame, keys: Sequence[str], digits: int = 2, bucket: str = "bucket") -> DataFrame:
    """One row per bucket that holds rows: ``bucket, n_rows, print``. No rows give none."""
    h = F.conv(F.substring(F.sha2(row_text(df.columns), 256), 1, 15), 16, 10).cast(T.DecimalType(38, 0))
    rows = df.select(key_bucket(keys, digits).alias(bucket), h.alias("_h"))
    return rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_h").cast("string").alias("print"))


def combine(prints: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Fingerprints of the union of parts whose fingerprints are stacked in ``prints``."""
    return prints.groupBy(bucket).agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("print").cast(T.DecimalType(38, 0))).cast("string").alias("print"))


def unequal(expected: DataFrame, actual: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Buckets whose fingerprints differ, or that only one side has; one small aggregation, no join."""
    both = expected.select(bucket, "n_rows", "print").unionByName(actual.select(bucket, "n_rows", "print"))
    return both.groupBy(bucket).agg(F.count(F.lit(1)).alias("_sides"), F.countDistinct("n_rows", "print").alias("_kinds")).filter(
        (F.col("_sides") != 2) | (F.col("_kinds") != 1)).select(bucket)


def freeze(df: DataFrame, keys: Sequence[str], path: str, digits: int = 2) -> None:
    """Store the rows by bucket and their fingerprints beside them. Rows whose keys are NULL share a bucket.

    A bucket is written by up to 8 tasks, by a hash of the whole row, so that a hot key spreads.
    """
    folder = path.rstrip("/")
    bucket = key_bucket(keys, digits)
    part = F.pmod(F.xxhash64(row_text(df.columns)), F.lit(8))
    df.withColumn("_bucket", bucket).repartition(F.col("_bucket"), part).write.mode("overwrite").partitionBy("_bucket").parquet(f"{folder}/{ROWS}")
    stored = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_bucket", T.StringType())])).parquet(f"{folder}/{ROWS}")
    bucket_prints(stored.drop("_bucket"), keys, digits).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{PRINTS}")


def drift(spark: SparkSession, path: str, actual: DataFrame, keys: Sequence[str], digits: int = 2) -> DataFrame:
    """The rows of ``quality.drift`` between the stored table and ``actual``.

    ``actual`` is read once for its fingerprints. Of the stored table only unequal buckets are read; if all are equal
    neither table's rows are read again. The list of unequal buckets (65,536 short texts at most) passes through the driver.
    """
    folder = path.rstrip("/")
    prints = spark.read.schema("bucket string, n_rows long, print string").parquet(f"{folder}/{PRINTS}")
    differ = sorted(r["bucket"] for r in unequal(prints, bucket_prints(actual, keys, digits)).collect())
    if not differ:
        return spark.createDataFrame([], T.StructType([*actual.schema.fields, T.StructField("side", T.StringType())]))
    schema = T.StructType([*actual.schema.fields, T.StructField("_bucket", T.StringType())])
    expected = spark.read.schema(schema).parquet(f"{folder}/{ROWS}").filter(F.col("_bucket").isin(differ)).drop("_bucket")
    return quality.drift(expected, actual.filter(key_bucket(keys, digits).isin(differ)))
