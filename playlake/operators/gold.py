"""Gold star schema and the retention mart (PRJ-1/2/4/6/7, JON-1/2, AGG-1..3, FLT-3/4, CND-1/2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.functions import days_between, first_or_null, safe_div, to_date_utc
from playlake.schemas import MIN_EP1_VIEWERS

ENRICHMENT_COLUMNS = T.StructType([
    T.StructField("media_id", T.LongType()),
    T.StructField("mood_tags", T.ArrayType(T.StringType())),
    T.StructField("enrichment_model", T.StringType()),
    T.StructField("enriched_at", T.TimestampType()),
])


def empty_enrichment(spark: SparkSession) -> DataFrame:
    """PRJ-6: typed empty relation; the optimizer folds the left join away.

    Typed NULLs under a false filter: Catalyst proves the relation empty
    (PruneFilters) and replaces the left join by NULL columns
    (PropagateEmptyRelation), so no join or shuffle is planned.
    """
    return spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in ENRICHMENT_COLUMNS.fields]
    ).where(F.lit(False))


def dim_title(stg_media: DataFrame, enrichment: DataFrame | None = None) -> DataFrame:
    """One row per title; ``enrichment`` (PRJ-7) adds mood tags by a left join (JON-1)."""
    if enrichment is None:
        enrichment = empty_enrichment(stg_media.sparkSession)
    enr = enrichment.select("media_id", "mood_tags", "enrichment_model", "enriched_at")
    return stg_media.join(enr, "media_id", "left").select(
        F.col("media_id").alias("title_key"),
        "title",
        "title_romaji",
        "genres",
        first_or_null("genres").alias("primary_genre"),
        "synopsis",
        "average_score",
        "popularity",
        "episodes",
        "season",
        "season_year",
        "format",
        "mood_tags",
        "enrichment_model",
        "enriched_at",
    )


def dim_user(stg_users: DataFrame, as_of=None) -> DataFrame:
    """One row per user; ``tenure_days`` counts to ``as_of`` (default today, DAT-3)."""
    end = None if as_of is None else F.lit(as_of).cast("date")
    return stg_users.select(
        F.col("user_id").alias("user_key"),
        "signup_date",
        "primary_device",
        "region",
        "favorite_genre",
        days_between("signup_date", end).alias("tenure_days"),
    )


def fact_playback(stg_playback: DataFrame) -> DataFrame:
    """PRJ-1/PRJ-2: renamed projection plus the UTC watch date."""
    return stg_playback.select(
        "event_id",
        F.col("user_id").alias("user_key"),
        F.col("media_id").alias("title_key"),
        "episode",
        "started_at",
        to_date_utc("started_at").alias("watch_date"),
        "watch_pct",
        "completed",
        "rebuffer_count",
        "startup_time_ms",
        "device",
        "region",
    )


def episode_viewers(
    fact: DataFrame,
    title_key: str = "title_key",
    episode: str = "episode",
    user_key: str = "user_key",
    strict_cohort: bool = False,
) -> DataFrame:
    """AGG-1 + AGG-2: distinct episode-1 and episode-2 viewers per title.

    A row without a user is no viewer, as in ``count(DISTINCT user)``; a title
    with only such rows keeps its row with no viewers.

    Plan: one shuffle on (title, user) that also removes repeat views (map-side
    partial aggregation), then a tiny per-title count with map-side combine.
    Hashing on the user as well spreads a hot title over all reducers, and the
    pivot needs no third exchange. ``strict_cohort`` counts episode-2 viewers
    only among users who also started episode 1.
    """
    per_user = (
        fact.filter(F.col(episode) <= 2)  # FLT-3, pushed to the scan
        .groupBy(title_key, user_key)
        .agg(
            F.max((F.col(episode) == 1) & F.col(user_key).isNotNull()).alias("_e1"),
            F.max((F.col(episode) == 2) & F.col(user_key).isNotNull()).alias("_e2"),
        )
    )
    e2 = (F.col("_e1") & F.col("_e2")) if strict_cohort else F.col("_e2")
    return per_user.groupBy(title_key).agg(
        F.count_if(F.col("_e1")).alias("ep1_viewers"),
        F.count_if(e2).alias("ep2_viewers"),
    )


def episode_dropoff(
    fact: DataFrame,
    dim: DataFrame,
    title_key: str = "title_key",
    episode: str = "episode",
    user_key: str = "user_key",
    min_viewers: int = MIN_EP1_VIEWERS,
    strict_cohort: bool = False,
) -> DataFrame:
    """Episode-2 retention per title (the headline mart).

    ``ep2_retention = round(ep2 / ep1, 4)`` with independent distinct counts
    (AGG-3), titles with fewer than ``min_viewers`` episode-1 viewers dropped
    (FLT-4), dimension columns attached by an inner join (JON-2). No stored sort.
    The dimension key stays in the output, so downstream joins use the key
    rather than the title text (JON-3), and equal titles cannot fan out.
    """
    counts = episode_viewers(fact, title_key, episode, user_key, strict_cohort).filter(
        F.col("ep1_viewers") >= min_viewers
    )
    return counts.join(dim, title_key).select(
        *[F.col(c) for c in dim.columns],
        F.col("ep1_viewers"),
        F.col("ep2_viewers"),
        F.round(safe_div("ep2_viewers", "ep1_viewers"), 4).alias("ep2_retention"),
    )
