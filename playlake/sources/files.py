"""File sources and sinks: JSON lines, run records, golden CSVs, report JSON
(SRC-3, SRC-5, SRC-7, SNK-6, SNK-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.operators.quality import freeze
from playlake.schemas import RUN_RECORD


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False,
               with_seq: bool = False) -> DataFrame:
    """SRC-3: one JSON object per line with a declared schema.

    ``strict`` fails on the first malformed line (the eval's behaviour);
    otherwise malformed lines are dropped (the label server's behaviour).
    ``with_seq`` adds ``file`` and ``seq`` (increasing in line order within a
    file, assigned at the scan before any shuffle) so that "last line wins"
    (WIN-2) can be applied by sequence instead of by file order.
    """
    if strict:
        df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    else:
        with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
        df = (spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    if with_seq:
        df = df.withColumn("file", F.col("_metadata.file_path")).withColumn("seq", F.monotonically_increasing_id())
    if not strict:
        df = df.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    return df


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: every run record JSON document, unreadable ones skipped, newest first."""
    schema = T.StructType(RUN_RECORD.fields + [T.StructField("_corrupt", T.StringType())])
    df = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    return df.filter(F.col("_corrupt").isNull() & F.col("run_id").isNotNull()).drop("_corrupt").orderBy(
        F.col("run_id").desc()
    )


def read_golden_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC-7: frozen mart snapshot with header; empty fields read as NULL."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def write_golden_csv(mart: DataFrame, path: str, columns: list[str], sort: list[str]) -> None:
    """SNK-6 writer: the frozen columns as CSV, in the order of the typed keys.

    Rows are range-partitioned, so part files follow each other in order; a small
    mart comes out as one file.
    """
    ordered = mart.orderBy(*[F.col(c).asc_nulls_last() for c in sort])
    freeze(ordered, columns).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_report(doc: DataFrame, path: str) -> None:
    """SNK-7 writer: the one-row report document as JSON."""
    doc.coalesce(1).write.mode("overwrite").json(path)
