"""Data-quality tests, golden freeze/drift, fingerprints and gates (DQ-1..8, SNK-6, SET-4)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.functions import format4


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-1: key values that occur more than once (rows with a NULL key ignored)."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """DQ-2: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """DQ-3 / JON-6: child keys with no parent (NULL child keys are not orphans)."""
    c = child.filter(F.col(child_key).isNotNull())
    p = parent.select(F.col(parent_key).alias(child_key))
    return c.join(p, child_key, "left_anti")


@dataclass(frozen=True)
class Check:
    """One column test: kind is 'unique', 'not_null' or 'relationships'."""

    kind: str
    model: str
    column: str
    df: DataFrame
    parent: DataFrame | None = None
    parent_column: str | None = None

    def failures(self) -> DataFrame:
        if self.kind == "unique":
            bad = duplicate_keys(self.df, [self.column])
        elif self.kind == "not_null":
            bad = null_rows(self.df, self.column)
        elif self.kind == "relationships":
            bad = orphans(self.df, self.parent, self.column, self.parent_column or self.column)
        else:
            raise ValueError(f"unknown check kind {self.kind!r}")
        return bad.groupBy().agg(F.count(F.lit(1)).alias("failures"))


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """DQ-4: every check runs; one result row each (test, model, column, failures, passed).

    Checks share passes over their table: a ``unique`` and a ``not_null`` test
    on the same column come from one grouped count (the NULL-key group holds
    the not-null failures), the remaining ``not_null`` tests of a table fold
    into one aggregation, and only ``relationships`` tests add an anti join.
    """
    def row(i: int, c: Check, failures: Column) -> Column:
        return F.struct(F.lit(i).alias("test_order"), F.lit(c.kind).alias("test"), F.lit(c.model).alias("model"),
                        F.lit(c.column).alias("column_name"), failures.cast("long").alias("failures"))

    def emit(folded: DataFrame, rows: list[Column]) -> DataFrame:
        # every result row of one shared pass comes out of that single pass
        return folded.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    indexed = list(enumerate(checks))
    unique_cols = {(id(c.df), c.column) for _, c in indexed if c.kind == "unique"}
    parts: list[DataFrame] = []

    # unique (+ not_null on the same column): one grouped count per column
    for df_id, column in sorted(unique_cols, key=lambda k: k[1]):
        group = [(i, c) for i, c in indexed if id(c.df) == df_id and c.column == column
                 and c.kind in ("unique", "not_null")]
        df = group[0][1].df
        counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        folded = counts.groupBy().agg(
            F.count_if(F.col(column).isNotNull() & (F.col("_n") > 1)).alias("_dup"),
            F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("_n"))), F.lit(0)).alias("_null"),
        )
        parts.append(emit(folded, [row(i, c, F.col("_dup") if c.kind == "unique" else F.col("_null"))
                                   for i, c in group]))

    # remaining not_null tests: one aggregation per table
    rest = [(i, c) for i, c in indexed if c.kind == "not_null" and (id(c.df), c.column) not in unique_cols]
    for df_id in dict.fromkeys(id(c.df) for _, c in rest):
        group = [(i, c) for i, c in rest if id(c.df) == df_id]
        folded = group[0][1].df.groupBy().agg(
            *[F.count_if(F.col(c.column).isNull()).alias(f"_null{i}") for i, c in group])
        parts.append(emit(folded, [row(i, c, F.col(f"_null{i}")) for i, c in group]))

    for i, c in indexed:
        if c.kind not in ("unique", "not_null"):
            parts.append(emit(c.failures(), [row(i, c, F.col("failures"))]))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def bounds_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """DQ-7: count violations of each named rule in one scan."""
    return df.groupBy().agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()])


def unparseable_json(df: DataFrame, column: str, schema: str = "array<string>") -> DataFrame:
    """ARR-1 quality metric: rows whose JSON text is present but does not parse.

    Spark's ``from_json`` yields NULL where another engine would raise, so the
    silent NULLs are counted instead: one row ``(column_name, rows, unparseable)``.
    """
    text = F.col(column)
    bad = text.isNotNull() & F.from_json(text, schema).isNull()
    return df.groupBy().agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("unparseable")).select(
        F.lit(column).alias("column_name"), "rows", "unparseable")


def freeze(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SNK-6: fixed column subset as text: doubles with 4 decimals, NULL as ''.

    The rows have no order; ``files.write_golden_csv`` orders by the typed keys
    before it freezes.
    """
    types = dict(df.dtypes)
    cols = []
    for c in columns:
        v = format4(c) if types[c] in ("double", "float") or types[c].startswith("decimal") else F.col(c).cast("string")
        cols.append(F.coalesce(v, F.lit("")).alias(c))
    return df.select(*cols)


# Elements of an array that expands copies of one row.
COPY_STEP = 4096


def drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """SET-4 / DQ-5: bag difference in both directions with a ``side`` column.

    Equals ``expected.exceptAll(actual)`` tagged 'missing' plus
    ``actual.exceptAll(expected)`` tagged 'unexpected', computed in one pass:
    rows are counted with sign +1 / -1 per side (NULLs group together), and a
    row with net count k != 0 is emitted |k| times on its side. Each input is
    read once; identical hot rows combine map-side. Copies are expanded in two
    steps of at most ``COPY_STEP`` elements an array, so a row with a very large
    net count never becomes one array of that length.
    """
    cols = expected.columns
    signed = expected.select(*cols, F.lit(1).alias("_d")).unionByName(
        actual.select(*cols, F.lit(-1).alias("_d")))
    net = signed.groupBy(*cols).agg(F.sum("_d").alias("_net")).filter(F.col("_net") != 0)
    step = F.lit(COPY_STEP)
    copies = F.abs(F.col("_net"))
    steps = net.select(
        *cols,
        F.when(F.col("_net") > 0, F.lit("missing")).otherwise(F.lit("unexpected")).alias("side"),
        copies.alias("_k"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / step))).alias("_i"),
    )
    left = F.least(step.cast("long"), F.col("_k") - F.col("_i") * step)
    return steps.select(*cols, "side", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("_copy")).drop("_copy")


def fingerprint(df: DataFrame, name: str | None = None) -> DataFrame:
    """DQ-6: order-insensitive identity: row count and the exact sum of row hashes.

    A row is written as text, ``column=value`` or ``column!`` for NULL, one to a
    line. A row with a value that holds a line which looks like a column's also gets
    the lengths of its values, so that no two rows of a schema have one text. Its hash is the first
    60 bits of the SHA-256. Stable across partitioning and file layout, unlike
    parquet bytes.
    """
    values = {c: F.col(f"`{c.replace('`', '``')}`").cast("string") for c in df.columns}
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")
    looks = "\n(?:" + "|".join(re.escape(c) for c in df.columns) + ")[=!]"
    doubt = F.lit(False)
    for c, kind in df.dtypes:
        if kind not in plain:
            doubt = doubt | F.coalesce(values[c].rlike(looks), F.lit(False))
    lengths = F.concat_ws(",", *[F.coalesce(F.length(v), F.lit(-1)).cast("string") for v in values.values()])
    lines = [F.coalesce(F.concat(F.lit(f"{c}="), v), F.lit(f"{c}!")) for c, v in values.items()]
    text = F.concat(F.concat_ws("\n", *lines), F.when(doubt, F.concat(F.lit("\n#"), lengths)).otherwise(F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast(T.DecimalType(38, 0))
    out = df.groupBy().agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("fingerprint"))
    return out if name is None else out.select(F.lit(name).alias("table_name"), "*")


def gate(results: DataFrame, status_col: str = "status", order_col: str = "gate_order") -> DataFrame:
    """DQ-8: fold ordered check statuses (pass/fail/skip) into a run status.

    Every check has already run; any 'fail' fails the run, 'skip' does not.
    """
    return results.groupBy().agg(
        F.when(F.max(F.when(F.col(status_col) == "fail", 1).otherwise(0)) == 1, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.transform(
            F.array_sort(F.collect_list(F.struct(order_col, "gate", status_col, "reason"))),
            lambda s: F.struct(s["gate"].alias("gate"), s[status_col].alias("status"), s["reason"].alias("reason")),
        ).alias("gates"),
    )


def gate_results(spark: SparkSession, rows: list[tuple[str, str, str | None]]) -> DataFrame:
    """Build a (gate_order, gate, status, reason) frame from a short list of gate outcomes."""
    return spark.createDataFrame(
        [(i, g, s, r) for i, (g, s, r) in enumerate(rows)],
        "gate_order int, gate string, status string, reason string",
    )


def golden_check(spark: SparkSession, name: str, frozen: DataFrame, golden_path: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """DQ-5 as a gate row: compare a frozen mart with its golden CSV.

    Returns one row ``(gate, status, reason, drift_rows)``: 'skip' when the
    golden file is absent (a missing golden is not a failure), 'fail' on any
    drift in either direction, else 'pass'. Only the drift count leaves Spark.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(golden_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out_schema = "gate string, status string, reason string, drift_rows long"
    if not fs.exists(path):
        return spark.createDataFrame([(name, "skip", f"{golden_path} not found", None)], out_schema)
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in frozen.columns])
    golden = (spark.read.schema(schema or text_schema).option("header", True)
              .option("nullValue", None).option("emptyValue", "").csv(golden_path))
    golden = golden.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in frozen.columns])
    diff = drift(golden, frozen).groupBy().agg(F.count(F.lit(1)).alias("drift_rows"))
    return diff.select(
        F.lit(name).alias("gate"),
        F.when(F.col("drift_rows") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.when(F.col("drift_rows") > 0, F.lit("drift detected")).alias("reason"),
        "drift_rows",
    )
