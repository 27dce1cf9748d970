"""AGG-1 kept by day: exact distinct viewers as bitmaps that are united on reading.

A row holds the viewers of one (title, episode, day) whose numbers fall into one bucket of 32,768, as a bitmap of 4 KB
(mostly zeros, which Parquet compresses). Unions lose nothing, so repeat viewers across days count once. A new day is
computed from that day's events alone and replaces its folder, so a rerun changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions import safe_div
from playlake.schemas import MIN_EP1_VIEWERS

SCHEMA = "title_key long, episode int, bucket long, viewers binary, watch_date date"


def daily_bitmaps(fact: DataFrame, episodes: Sequence[int] = (1, 2)) -> DataFrame:
    """One row per (title, episode, day, bucket) of the wanted episodes.

    Viewers are integers, dense ones for small tables. Rows with a NULL user are no viewers, but their title, episode and day keep a
    row of bucket 0 with an empty bitmap, so that the title is known; rows without an episode, or of other episodes, are left out. Repeated
    rows change nothing. The first grouping removes repeat views before the shuffle and spreads a hot title by its viewers' buckets.
    """
    user = F.col("user_key").cast("long")
    seen = fact.filter(F.col("episode").isin(*episodes)).select(
        F.col("title_key").cast("long").alias("title_key"), F.col("episode").cast("int").alias("episode"), F.col("watch_date").cast("date").alias("watch_date"),
        F.coalesce(F.bitmap_bucket_number(user), F.lit(0).cast("long")).alias("bucket"), F.bitmap_bit_position(user).alias("bit"))
    return seen.groupBy("title_key", "episode", "watch_date", "bucket").agg(F.bitmap_construct_agg("bit").alias("viewers"))


def append_days(fact: DataFrame, path: str, episodes: Sequence[int] = (1, 2)) -> None:
    """Write the days that occur in ``fact``; each must be whole, since it replaces what is stored for that day.

    Days are told by ``watch_date``; a NULL day is a day of its own. Without rows nothing is replaced.
    """
    days = daily_bitmaps(fact, episodes).repartition("watch_date", F.pmod(F.hash("title_key", "bucket"), F.lit(16)))
    (days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("watch_date").parquet(path))


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """The stored bitmaps; none if nothing was written yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def episode_viewers(days: DataFrame, since: str | None = None, until: str | None = None, strict_cohort: bool = False) -> DataFrame:
    """Distinct viewers of episodes 1 and 2 per title over the days from ``since`` to ``until``, both included.

    The same counts as ``gold.episode_viewers`` over the events of those days; other days' folders are not read. ``strict_cohort`` meets both
    bitmaps of a bucket, so it needs no viewer rows either.
    """
    if since is not None:
        days = days.filter(F.col("watch_date") >= F.lit(since).cast("date"))
    if until is not None:
        days = days.filter(F.col("watch_date") <= F.lit(until).cast("date"))
    united = days.groupBy("title_key", "episode", "bucket").agg(F.bitmap_or_agg("viewers").alias("viewers"))
    n = F.bitmap_count("viewers")
    by_bucket = united.groupBy("title_key", "bucket").agg(
        F.sum(F.when(F.col("episode") == 1, n).otherwise(0)).alias("e1"),
        F.sum(F.when(F.col("episode") == 2, n).otherwise(0)).alias("e2"),
        F.bitmap_and_agg(F.when(F.col("episode").isin(1, 2), F.col("viewers"))).alias("both"),
        F.count_if(F.col("episode").isin(1, 2)).alias("sides"))
    e2 = F.when(F.col("sides") == 2, F.bitmap_count("both")).otherwise(0) if strict_cohort else F.col("e2")
    return by_bucket.groupBy("title_key").agg(F.sum("e1").alias("ep1_viewers"), F.sum(e2).alias("ep2_viewers"))


def episode_dropoff(days: DataFrame, dim: DataFrame, min_viewers: int = MIN_EP1_VIEWERS, **window) -> DataFrame:
    """The retention mart of ``gold.episode_dropoff`` from stored days; ``window`` goes to ``episode_viewers``."""
    counts = episode_viewers(days, **window).filter(F.col("ep1_viewers") >= min_viewers)
    return counts.join(dim, "title_key").select(
        *[F.col(c) for c in dim.columns], "ep1_viewers", "ep2_viewers", F.round(safe_div("ep2_viewers", "ep1_viewers"), 4).alias("ep2_retention"))
