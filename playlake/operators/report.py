"""Report aggregates over the marts (AGG-4..8, SRT-2/3, SET-1, SNK-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions import py_round, rate
from playlake.operators.frames import side_by_side


def row_counts(**tables: DataFrame) -> DataFrame:
    """AGG-4: one row with ``<name>`` = row count of each named table.

    Each count reads no columns (parquet footers answer it); the per-table
    one-row results are unioned and folded, never cross-joined.
    """
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
             for name, df in tables.items()]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return stacked.groupBy().agg(
        *[F.max(F.when(F.col("t") == name, F.col("n"))).alias(name) for name in tables]
    )


def value_histogram(df: DataFrame, value: str, alias: str = "n") -> DataFrame:
    """AGG-5: count per distinct value (reader orders by value)."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias(alias))


def group_means(df: DataFrame, group: str, value: str, min_n: int = 5, scale: int = 4) -> DataFrame:
    """AGG-6 + FLT-5: mean per group (Python rounding) for groups with >= ``min_n`` rows."""
    return (
        df.groupBy(group)
        .agg(F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_n)
        .select(group, py_round("_mean", scale).alias("mean_" + value), "n")
    )


def device_qoe(
    fact: DataFrame,
    device: str = "device",
    rebuffer: str | Column = "rebuffer_count",
    startup: str | Column = "startup_time_ms",
    completed: Column | None = None,
) -> DataFrame:
    """AGG-7 + CND-3: rebuffers (2 dp), startup ms (integer), completion rate (3 dp)."""
    reb = F.col(rebuffer) if isinstance(rebuffer, str) else rebuffer
    st = F.col(startup) if isinstance(startup, str) else startup
    done = F.col("completed") if completed is None else completed
    return fact.groupBy(device).agg(
        py_round(F.avg(reb), 2).alias("rebuffers"),
        py_round(F.avg(st), 0).cast("long").alias("startup_ms"),
        py_round(rate(done), 3).alias("completion"),
    )


def spread(df: DataFrame, value: str, threshold: float = 0.02) -> DataFrame:
    """AGG-8: max - min of ``value`` and whether it exceeds ``threshold``."""
    return df.groupBy().agg(
        F.round(F.max(value) - F.min(value), 4).alias("spread"),
        F.count(F.col(value)).alias("n"),
    ).withColumn("planted_signal", F.col("spread") > F.lit(threshold))


def top_k(df: DataFrame, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """SRT-2/SRT-3: first ``k`` rows under ``order`` (unique tie-break required).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``k`` and only those reach the final merge. The rank is computed
    over those ``k`` rows only.
    """
    head = df.orderBy(*order).limit(k)
    return head.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_bottom(df: DataFrame, value: str, key: str, k: int = 15) -> DataFrame:
    """SRT-2 + SET-1: top-``k`` and bottom-``k`` by ``value`` as a bag union."""
    top = top_k(df, [F.col(value).desc_nulls_last(), F.col(key).asc()], k).withColumn("side", F.lit("top"))
    bottom = top_k(df, [F.col(value).asc_nulls_last(), F.col(key).asc()], k).withColumn(
        "side", F.lit("bottom")
    )
    return top.unionByName(bottom)


def report_document(
    counts: DataFrame,
    histogram: DataFrame,
    means: DataFrame,
    variance: DataFrame,
    qoe: DataFrame,
    sample: DataFrame,
    generated_at: Column | None = None,
    suite: DataFrame | None = None,
) -> DataFrame:
    """SNK-7: one nested row built from small aggregates (no driver round trip).

    Each input is already an aggregate with a bounded row count (a histogram of
    4-dp values, per-group rows, top/bottom samples), so each is folded into an
    array by a single ``collect_list``; the one-row results are then put side
    by side without a join. Lists keep the order a reader wants: the histogram
    by value, group means by falling mean, QoE by device, the sample as the top
    titles by rank and then the bottom ones. ``suite`` (the rows of
    ``quality.run_suite``) adds how many of its checks passed.
    """
    def fold(df: DataFrame, name: str, *order: Column) -> DataFrame:
        row = F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"),
                       F.struct(*[F.col(c) for c in df.columns]).alias("row"))
        return df.groupBy().agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["row"]).alias(name))

    mean = next(c for c in means.columns if c.startswith("mean_"))
    parts = [
        counts,
        fold(histogram, "retention_hist", F.col(histogram.columns[0])),
        fold(means, "genre_means", -F.col(mean), F.col(means.columns[0])),
        variance.select(F.struct(*variance.columns).alias("variance_explained")),
        fold(qoe, "device_qoe", F.col(qoe.columns[0])),
        fold(sample, "titles_sample", F.when(F.col("side") == "top", 0).otherwise(1), F.col("rank")),
    ]
    if suite is not None:
        parts.append(suite.groupBy().agg(F.count_if("passed").alias("checks_passed"), F.count(F.lit(1)).alias("checks_total")))
    ts = generated_at if generated_at is not None else F.current_timestamp()
    return side_by_side(*parts).withColumn("generated_at", ts)
