"""Statistics and vector work (STA-1..5, JON-9/10, ARR-4/5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.functions import dot, l2_normalize, py_round
from playlake.schemas import GENRE_NUDGES, TONES


def eta_squared(df: DataFrame, group: str, value: str, scale: int = 3) -> DataFrame:
    """STA-1: SS_between / SS_total of ``value`` by ``group``; 0.0 if SS_total is 0.

    One scan and one shuffle of partial aggregates: a rollup gives the count and
    population variance of each group and of all rows. Variances are merged
    around the means, so values far from zero lose nothing:
    SS_total = n var, SS_within = sum n_g var_g, SS_between is their difference.
    """
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull()).select(F.col(group).alias("_g"), v.alias("_v"))
    parts = rows.rollup("_g").agg(
        F.grouping("_g").alias("_all"), F.count(F.lit(1)).alias("_n"), F.var_pop("_v").alias("_var"))
    whole = F.col("_all") == 1
    ss = F.col("_n") * F.col("_var")
    folded = parts.groupBy().agg(
        F.coalesce(F.max(F.when(whole, F.col("_n"))), F.lit(0)).cast("long").alias("n"),
        F.count_if(~whole).alias("n_groups"),
        F.max(F.when(whole, ss)).alias("_total"),
        F.sum(F.when(~whole, ss)).alias("_within"),
    )
    between = F.greatest(F.col("_total") - F.col("_within"), F.lit(0.0))
    eta = F.when(F.coalesce(F.col("_total"), F.lit(0.0)) > 0, between / F.col("_total")).otherwise(F.lit(0.0))
    return folded.select("n", "n_groups", py_round(eta, scale).alias("eta_squared"))


def r_squared(df: DataFrame, x: str, y: str, scale: int = 3, min_pairs: int = 3) -> DataFrame:
    """STA-2: squared Pearson r; 0.0 for fewer than ``min_pairs`` pairs or zero variance.

    Uses covar_pop / var_pop (ANSI-safe); ``corr`` would raise on zero variance.
    """
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    agg = pairs.groupBy().agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.covar_pop(xs, ys).alias("_c"),
        F.var_pop(xs).alias("_vx"),
        F.var_pop(ys).alias("_vy"),
    )
    den = F.col("_vx") * F.col("_vy")
    r2 = F.when(
        (F.col("n_pairs") >= min_pairs) & (den > 0), F.col("_c") * F.col("_c") / den
    ).otherwise(F.lit(0.0))
    return agg.select("n_pairs", py_round(r2, scale).alias("r_squared"))


def _equals(value: str):
    return lambda x: x == F.lit(value)


def title_vectors(
    df: DataFrame,
    key: str,
    genres: str,
    nudges: Mapping[str, tuple[str, float]] = GENRE_NUDGES,
    tones: Sequence[str] = TONES,
    prefix: str = "tone:",
) -> DataFrame:
    """STA-4: unit tone vector per title from a hash plus genre nudges (clamped at 1).

    The hash input is ``prefix`` followed by the key; other prefixes give
    independent vectors for other entities (e.g. user preferences).

    Every nudge is non-negative, so adding all matching nudges and clamping
    once equals clamping after each addition. Genres may repeat and each
    occurrence counts. The work is staged in projections (digest, components,
    norm) so each is computed once per row; all arithmetic stays in the JVM.
    """
    digest = df.select(
        F.col(key),
        F.coalesce(F.col(genres), F.array().cast("array<string>")).alias("_g"),
        F.sha2(F.concat(F.lit(prefix), F.col(key).cast("string")), 256).alias("_h"),
    )
    parts = []
    for i, tone in enumerate(tones):
        byte = F.conv(F.substring("_h", 2 * i + 1, 2), 16, 10).cast("double") / F.lit(255.0)
        add = F.lit(0.0)
        for name, (t, w) in nudges.items():
            if t == tone:
                add = add + F.size(F.filter("_g", _equals(name))).cast("double") * F.lit(float(w))
        parts.append(F.least(F.lit(1.0), byte + add).alias(f"_b{i}"))
    comps = digest.select(F.col(key), *parts)
    names = [f"_b{i}" for i in range(len(tones))]
    sq = sum((F.col(c) * F.col(c) for c in names[1:]), F.col(names[0]) * F.col(names[0]))
    normed = comps.withColumn("_n", F.coalesce(F.nullif(F.sqrt(sq), F.lit(0.0)), F.lit(1.0)))
    return normed.select(F.col(key), F.array(*[F.col(c) / F.col("_n") for c in names]).alias("tone"))


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Element-wise mean vector per ``key`` (vectors of equal length).

    Exploded by position and averaged with map-side combine, so a hot key
    costs one partial row per (task, position), never its whole group.
    """
    exploded = df.select(key, F.posexplode(vector).alias("_pos", "_x"))
    per_pos = exploded.groupBy(key, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    return per_pos.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_m"))), lambda s: s["_m"]).alias(vector)
    )


def mean_affinity(
    pairs: DataFrame,
    user_vectors: DataFrame,
    title_vectors_df: DataFrame,
    user_key: str,
    title_key: str,
    dim: int,
    vector: str = "vector",
) -> DataFrame:
    """STA-3 / JON-10: mean over watched pairs of dot(user vector, title vector) per title.

    The mean of u.t over a title's viewers is (mean u).t, so only user vectors
    are joined to the pairs; ``dim`` component sums per title are combined on the
    map side, and one row per title meets its title vector.
    """
    u = user_vectors.select(user_key, F.col(vector).alias("_uv"))
    t = title_vectors_df.select(title_key, F.col(vector).alias("_tv"))
    sums = pairs.select(user_key, title_key).join(u, user_key).groupBy(title_key).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        *[F.avg(F.get("_uv", F.lit(i)).cast("double")).alias(f"_m{i}") for i in range(dim)],
    )
    means = sums.select(title_key, "n_pairs", F.array(*[F.col(f"_m{i}") for i in range(dim)]).alias("_mean"))
    return means.join(t, title_key).select(title_key, dot("_mean", "_tv").alias("mean_affinity"), "n_pairs")


def group_affinity(vectors: DataFrame, centres: DataFrame, key: str, vector: str) -> DataFrame:
    """JON-10: mean dot(unit vector, centre of its group) per group, for vectors that carry their group."""
    from playlake.functions.arrays import l2_norm

    unit = vectors.select(key, vector, l2_norm(vector).alias("_n")).select(key, l2_normalize(vector, "_n").alias("_u"))
    centre = centres.select(key, F.col("vector").alias("_c"))
    return unit.join(centre, key).groupBy(key).agg(
        F.avg(dot("_u", "_c")).alias("mean_affinity"), F.count(F.lit(1)).alias("n_pairs"))


def affinity_retention_r2(affinity: DataFrame, retention: DataFrame, key: str,
                          x: str = "mean_affinity", y: str = "ep2_retention", scale: int = 3) -> DataFrame:
    """JON-7 + STA-2: r^2 of per-title mean affinity against retention.

    Titles are paired by an inner join on the key (both sides have one row
    per title), then the squared correlation is one aggregate.
    """
    pairs = affinity.select(key, x).join(retention.select(key, y), key)
    return r_squared(pairs, x, y, scale=scale)


def unit_vectors(df: DataFrame, key: str, vector: str, alias: str = "vector") -> DataFrame:
    """ARR-5 over a table: L2-normalised vectors, zero vectors left as is.

    The norm is its own projection, computed once per vector.
    """
    from playlake.functions.arrays import l2_norm

    normed = df.select(key, vector, l2_norm(vector).alias("_norm"))
    return normed.select(key, l2_normalize(vector, "_norm").alias(alias))


def vector_catalog(vectors: DataFrame, dim: DataFrame, key: str, scale: int = 4) -> DataFrame:
    """STA-5: title vectors joined to the dimension, components rounded (Python rounding)."""
    return vectors.join(dim, key).withColumn(
        "tone", F.transform("tone", lambda x: F.bround(x, scale))
    )
