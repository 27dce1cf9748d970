"""Silver layer: dedupe and clean bronze (WIN-1, FLT-1, PRJ-3/5, STRG-1, ARR-1, DAT-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions import parse_string_array, strip_html, to_date_utc, to_timestamp_utc


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WIN-1 / FLT-2: keep the first row per ``keys`` under ``order`` (e.g. newest first).

    ``order`` must end in a unique tie-break so reruns keep the same row.
    Catalyst turns ``row_number() ... = 1`` into a WindowGroupLimit that keeps
    one row per key on the map side before the shuffle, so a key holding a
    third of the data still ships one row per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def stg_media(bronze_media: DataFrame) -> DataFrame:
    """Cleaned catalog: one row per ``media_id``, newest ingest wins.

    One ingest run stamps every row with the same ``_ingested_at``, so a title
    listed on two pages of a run ties; a hash of the row's payload breaks the
    tie the same way on every rerun.
    """
    payload = [c for c in bronze_media.columns if c not in ("_ingested_at", "ingest_date")]
    order = [F.col("_ingested_at").desc_nulls_last()]
    if "ingest_date" in bronze_media.columns:
        order.append(F.col("ingest_date").desc_nulls_last())
    order.append(F.xxhash64(*[F.col(c) for c in payload]).desc())
    newest = latest(bronze_media, ["media_id"], order)
    return newest.select(
        "media_id",
        F.coalesce("title_english", "title_romaji").alias("title"),
        "title_romaji",
        parse_string_array("genres").alias("genres"),
        strip_html("description_html").alias("synopsis"),
        "average_score",
        "popularity",
        "episodes",
        "season",
        "season_year",
        "format",
    )


def stg_users(bronze_users: DataFrame) -> DataFrame:
    return bronze_users.select(
        "user_id",
        F.col("signup_date").cast("date").alias("signup_date"),
        "primary_device",
        "region",
        "favorite_genre",
    )


def valid_playback(user_id: Column, media_id: Column, watch_pct: Column) -> Column:
    """FLT-1 predicate: ids present and ``watch_pct`` in [0, 1] (NULL and NaN fail)."""
    return user_id.isNotNull() & media_id.isNotNull() & watch_pct.between(0, 1)


def stg_playback(bronze_events: DataFrame) -> DataFrame:
    """Validated playback events with typed timestamps."""
    return bronze_events.filter(
        valid_playback(F.col("user_id"), F.col("media_id"), F.col("watch_pct"))
    ).select(
        "event_id",
        "user_id",
        "media_id",
        "episode",
        to_timestamp_utc("started_at").alias("started_at"),
        "watch_pct",
        "completed",
        "rebuffer_count",
        "startup_time_ms",
        "device",
        "region",
    )


def watch_date(ts: str = "started_at") -> Column:
    return to_date_utc(ts)
