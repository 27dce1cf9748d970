"""Labeling workflow (FLT-9, SNK-8, JON-5, EVL-11/12, CND-4, WIN-2, WIN-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions import jaccard, py_round
from playlake.operators.quality import COPY_STEP
from playlake.operators.silver import latest


def validate(df: DataFrame, vocab: Sequence[str], key: str = "media_id", tags: str = "mood_tags") -> DataFrame:
    """FLT-9: flag each label row ``valid`` with the first failing ``reason``.

    The id must be present and non-zero, 1 to 3 tags, all in the vocabulary.
    Stored tags are sorted (ARR-3).
    """
    allowed = F.array(*[F.lit(t) for t in vocab])
    t = F.col(tags)
    reason = (
        F.when(F.col(key).isNull() | (F.col(key) == 0), F.lit("missing_key"))
        .when(t.isNull() | ~F.size(t).between(1, 3), F.lit("tag_count"))
        .when(~F.forall(t, lambda x: F.array_contains(allowed, x)), F.lit("unknown_tag"))
    )
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull()).withColumn(
        tags, F.array_sort(t)
    )


def upsert_labels(existing: DataFrame, incoming: DataFrame, key: str = "media_id", seq: str = "seq") -> DataFrame:
    """SNK-8 in batch form: newest incoming label per key replaces the stored one."""
    newest = latest(incoming, [key], [F.col(seq).desc()])
    kept = existing.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest.withColumn("mood_tags", F.array_sort("mood_tags")), allowMissingColumns=True)


def agreement(pass1: DataFrame, pass2: DataFrame, key: str = "media_id", seq: str | None = None) -> DataFrame:
    """JON-5 / SET-2 / EVL-11: per-title Jaccard of two passes over the union of
    their keys, 0.0 for two empty sets, NULL unless both passes labeled the title.

    The passes are stacked and folded by one grouped aggregation in place of a full
    outer join: each side's last row of a key is picked before the shuffle and after it, so a
    key with very many rows spreads, and repeated keys give one row. ``seq`` names the column whose
    largest value is the last line (it must be unique within a key and side); without it the
    last is that of the frame's own order, which is the file's for a scan. A NULL key is one key.
    """
    def tagged(rows: DataFrame, side: int) -> DataFrame:
        order = F.col(seq) if seq else F.monotonically_increasing_id()
        return rows.select(key, F.lit(side).alias("_side"), F.struct(order.alias("at")).alias(f"_at{side}"),
                           F.struct(F.col("title").alias("title"), F.col("mood_tags").alias("tags")).alias("_row"))

    def last(side: int) -> Column:
        return F.max_by(F.when(F.col("_side") == side, F.col("_row")), F.col(f"_at{side}")).alias(f"_{side}")

    folded = tagged(pass1, 1).unionByName(tagged(pass2, 2), allowMissingColumns=True).groupBy(key).agg(
        last(1), last(2), (F.count_if(F.col("_side") == 1) > 0).alias("in_pass1"), (F.count_if(F.col("_side") == 2) > 0).alias("in_pass2"))
    return folded.select(
        key,
        F.coalesce("_1.title", "_2.title", F.lit("")).alias("title"),
        F.col("_1.tags").alias("pass1_tags"),
        F.col("_2.tags").alias("pass2_tags"),
        F.when(F.col("in_pass1") & F.col("in_pass2"), jaccard("_1.tags", "_2.tags", 0.0)).alias("agreement"),
        "in_pass1",
        "in_pass2",
    )


def agreement_band(agreement_col: Column) -> Column:
    """CND-4: 'na' when undefined, 'high' at 0.5 or more, else 'low'."""
    return F.when(agreement_col.isNull(), F.lit("na")).when(agreement_col >= 0.5, F.lit("high")).otherwise(F.lit("low"))


def agreement_summary(report: DataFrame, scale: int = 4) -> DataFrame:
    """EVL-12: totals, per-pass counts, both-count and mean agreement (NULL if none)."""
    return report.groupBy().agg(
        F.count(F.lit(1)).alias("total_titles"),
        F.count_if("in_pass1").alias("pass1_count"),
        F.count_if("in_pass2").alias("pass2_count"),
        F.count("agreement").alias("both_count"),
        py_round(F.avg("agreement"), scale).alias("avg_agreement"),
    )


#: Hexadecimal digits of a hash that name its bucket, and slices of a repeated key's rows.
PREFIX, SLICES = 4, 256


def seeded_order(df: DataFrame, key: str, seed: str, name: str = "position") -> DataFrame:
    """WIN-4: a stable, seed-keyed shuffled position (sha256 of seed || key, then key; NULL keys last).

    Hashes are spread evenly, so no range sort is needed: keys are counted by the first digits of their
    hash (65,536 buckets at most), a key's place is its bucket's start and its rank there. Rows
    of one key take neighbouring positions, by a hash of the whole row; equal rows are counted, not sorted, so a hot
    key never sits in one task. Columns must be of types that can be grouped.
    """
    k, names, one = F.col(f"`{key}`"), df.columns, F.count(F.lit(1))
    counts = df.groupBy(k.alias("_key")).agg(one.alias("_n"))
    counts = counts.withColumn("_h", F.sha2(F.concat(F.lit(seed), F.col("_key").cast("string")), 256))
    counts = counts.withColumn("_prefix", F.coalesce(F.substring("_h", 1, PREFIX), F.lit("null")))  # after every digit
    starts = _starts(counts, [], "_prefix", "_n")
    inside = Window.partitionBy("_prefix").orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_rank", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(starts), "_prefix")
    placed = placed.select("_key", "_n", (F.col("_start") + F.col("_rank")).alias("_before"))
    rows = df.join(placed, k.eqNullSafe(F.col("_key")))
    once = rows.where("_n = 1").select(*names, (F.col("_before") + 1).alias(name))

    whole = F.xxhash64(*names)
    again = rows.where("_n > 1").groupBy(*names, "_key", "_before").agg(one.alias("_m"))
    again = again.withColumn("_row", whole).withColumn("_slice", F.pmod("_row", F.lit(SLICES)))
    of_slice = Window.partitionBy("_key", "_slice").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    slices = _starts(again, ["_key"], "_slice", "_m").withColumnsRenamed({"_key": "_of", "_slice": "_at"})
    again = again.withColumn("_rank", F.coalesce(F.sum("_m").over(of_slice), F.lit(0)))
    again = again.join(slices, F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_at")))
    again = again.withColumn("_first", F.col("_before") + F.col("_start") + F.col("_rank"))
    steps = again.select(*names, "_m", "_first", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_m") - 1) / COPY_STEP))).alias("_i"))
    left = F.least(F.lit(COPY_STEP).cast("long"), F.col("_m") - F.col("_i") * COPY_STEP)
    copies = steps.select(*names, "_first", "_i", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("_copy"))
    return once.unionByName(copies.select(*names, (F.col("_first") + F.col("_i") * COPY_STEP + F.col("_copy")).alias(name)))


def _starts(df: DataFrame, by: list[str], part: str, n: str) -> DataFrame:
    """(by, part, _start): the sum of ``n`` in the parts before, for each by; the parts are few."""
    sums = df.groupBy(*by, part).agg(F.sum(n).alias("_sum"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*by, part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))


def last_line_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """WIN-2: the last line per key by an explicit sequence column (never file order)."""
    return latest(df, [key], [F.col(seq).desc()])


def labeling_pool(dim_title: DataFrame, k: int = 50, shuffled: bool = False, seed: str = "pass2-shuffle",
                  existing: DataFrame | None = None) -> DataFrame:
    """SRT-3 + WIN-4: the titles offered for labeling.

    The ``k`` most popular titles (NULL popularity last, key as tie-break),
    with a ``position``: popularity rank for the first pass, or a stable
    seed-keyed shuffled position for the blind second pass. ``existing``
    labels (first pass only) are attached by a left join on the key.
    """
    from playlake.operators.report import top_k

    pool = top_k(dim_title.select(F.col("title_key").alias("media_id"), "title", "synopsis", "popularity"),
                 [F.col("popularity").desc_nulls_last(), F.col("media_id").asc()], k, "position")
    if shuffled:
        pool = seeded_order(pool.drop("position"), "media_id", seed)
    if existing is not None and not shuffled:
        pool = pool.join(existing.select("media_id", F.col("mood_tags").alias("existing_tags")), "media_id", "left")
    return pool.withColumn("synopsis", F.coalesce(F.col("synopsis"), F.lit("")))
