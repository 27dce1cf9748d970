"""The media warehouse end to end: bronze -> silver -> gold
-> marts -> column tests -> report, as plain function calls on DataFrames.

Staging models are views and marts are tables (SNK-5) when ``materialize`` is
set; otherwise everything stays lazy and Catalyst plans each consumer whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions import py_round
from playlake.operators import gold, quality, report, silver, stats
from playlake.schemas import BRONZE_MEDIA, BRONZE_PLAYBACK, BRONZE_USERS
from playlake.schemas import TONES
from playlake.sources import bronze


@dataclass
class Warehouse:
    stg_media: DataFrame
    stg_users: DataFrame
    stg_playback: DataFrame
    dim_title: DataFrame
    dim_user: DataFrame
    fact_playback: DataFrame
    episode_dropoff: DataFrame


def build(spark: SparkSession, bronze_root: str, enrichment: DataFrame | None = None, as_of=None,
          materialize: str | None = None, since: str | None = None) -> Warehouse:
    """Silver and gold models from a bronze root holding ``anilist_media/``
    (ingest-date partitioned), ``users/`` and ``playback_events/``."""
    root = bronze_root.rstrip("/")
    media = bronze.read(spark, root, "anilist_media", BRONZE_MEDIA, since=since)
    users = spark.read.schema(BRONZE_USERS).parquet(f"{root}/users")
    events = spark.read.schema(BRONZE_PLAYBACK).parquet(f"{root}/playback_events")
    stg_media = silver.stg_media(media)
    stg_users = silver.stg_users(users)
    stg_playback = silver.stg_playback(events)
    if materialize:
        stg_media = bronze.materialize(stg_media, f"{materialize}stg_media")
        stg_users = bronze.materialize(stg_users, f"{materialize}stg_users")
        stg_playback = bronze.materialize(stg_playback, f"{materialize}stg_playback")
    dim_title = gold.dim_title(stg_media, enrichment)
    dim_user = gold.dim_user(stg_users, as_of)
    fact = gold.fact_playback(stg_playback)
    dropoff = gold.episode_dropoff(
        fact, dim_title.select("title_key", "title", "primary_genre", "mood_tags"))
    if materialize:
        dim_title = bronze.materialize(dim_title, f"{materialize}dim_title", "table")
        dim_user = bronze.materialize(dim_user, f"{materialize}dim_user", "table")
        fact = bronze.materialize(fact, f"{materialize}fact_playback", "table")
        dropoff = bronze.materialize(dropoff, f"{materialize}episode_dropoff", "table")
    return Warehouse(stg_media, stg_users, stg_playback, dim_title, dim_user, fact, dropoff)


def column_tests(w: Warehouse) -> DataFrame:
    """DQ-4: the nine column tests of the marts (unique / not_null / relationships)."""
    C = quality.Check
    return quality.run_suite([
        C("unique", "dim_title", "title_key", w.dim_title),
        C("not_null", "dim_title", "title_key", w.dim_title),
        C("unique", "dim_user", "user_key", w.dim_user),
        C("not_null", "dim_user", "user_key", w.dim_user),
        C("unique", "fact_playback", "event_id", w.fact_playback),
        C("not_null", "fact_playback", "event_id", w.fact_playback),
        C("relationships", "fact_playback", "user_key", w.fact_playback, w.dim_user, "user_key"),
        C("relationships", "fact_playback", "title_key", w.fact_playback, w.dim_title, "title_key"),
        C("not_null", "episode_dropoff", "ep2_retention", w.episode_dropoff),
    ])


def title_affinity(w: Warehouse, user_vectors: DataFrame) -> DataFrame:
    """STA-3 / JON-10: mean dot(user vector, title tone vector) over watched pairs."""
    pairs = w.fact_playback.select("user_key", "title_key").distinct()
    tones = stats.title_vectors(w.dim_title, "title_key", "genres").withColumnRenamed("tone", "vector")
    return stats.mean_affinity(pairs, user_vectors, tones, "user_key", "title_key", len(TONES))


def report_document(w: Warehouse, user_vectors: DataFrame | None = None) -> DataFrame:
    """SNK-7 / F11: catalog, user and event counts, retention histogram, genre means,
    variance explained, device QoE and the top/bottom title sample."""
    d = w.episode_dropoff
    counts = report.row_counts(catalog_n=w.dim_title, users_n=w.dim_user, events_n=w.fact_playback)
    hist = report.value_histogram(d, "ep2_retention", "n")
    means = report.group_means(d, "primary_genre", "ep2_retention")
    eta = stats.eta_squared(d, "primary_genre", "ep2_retention").select(F.col("eta_squared").alias("genre_eta2"))
    if user_vectors is not None:
        r2 = stats.affinity_retention_r2(title_affinity(w, user_vectors), d, "title_key").select(
            F.col("r_squared").alias("tone_r2"))
    else:
        r2 = eta.select(F.lit(None).cast("double").alias("tone_r2"))  # no vectors, no figure
    from playlake.operators.frames import side_by_side

    qoe = report.device_qoe(w.fact_playback)
    sample = report.top_bottom(d.select("title_key", "title", "primary_genre", "ep2_retention", "ep1_viewers"),
                               "ep2_retention", "title_key", 15).withColumn(
        "ep2_retention", py_round("ep2_retention", 4))
    return report.report_document(counts, hist, means, side_by_side(eta, r2), qoe, sample, suite=column_tests(w))
