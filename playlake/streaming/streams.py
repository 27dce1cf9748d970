"""Streaming sources, sinks and stateful rollups.

The same column logic as the batch operators is reused, so a stream and a
batch over the same files give the same rows. State is bounded: the playback
dedupe keeps keys only within its watermark, and run rollups keep one small
aggregate row per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playlake.operators import runlog, silver
from playlake.schemas import BRONZE_PLAYBACK, GATE_EVENT
from playlake.sources import bronze
from playlake.sources.tail import tail_lines

# Gate events as written by an emitter that numbers its lines.
GATE_EVENT_SEQ = T.StructType(GATE_EVENT.fields + [T.StructField("seq", T.LongType())])


def read_lines(spark: SparkSession, path: str, settled: float | None = None) -> DataFrame:
    """SRC-6: tail a directory of NDJSON files as lines (``value`` column); lines appended to a file arrive too.

    A last line without its line feed waits until it is finished, or until the file has not changed for ``settled`` seconds.
    """
    return tail_lines(spark, path, settled).select("value")


def gate_events(spark: SparkSession, path: str, schema: T.StructType = GATE_EVENT_SEQ) -> DataFrame:
    """SRC-6 + STR-1: parsed gate events with the line as it came; blank and non-JSON lines are dropped
    (``split_log`` keeps them)."""
    return runlog.parse_lines(read_lines(spark, path), schema=schema, raw="raw_line")


def split_log(spark: SparkSession, path: str, out_path: str, rejected_path: str, checkpoint: str,
              schema: T.StructType = GATE_EVENT_SEQ, available_now: bool = True) -> StreamingQuery:
    """SRC-6 + STR-1 + STR-2: accepted events to one folder, the other lines with reasons to another.

    Each micro-batch is one folder ``batch_id=N`` in both, written over by a replay of the batch, so every line
    stands once in exactly one of them.
    """
    lines = runlog.classified_lines(tail_lines(spark, path))

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good = runlog.accepted(batch, keep=["file", "offset"], schema=schema, raw="raw_line")
            good.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
            bad = runlog.rejected(batch, keep=["file", "offset"])
            bad.write.mode("overwrite").parquet(f"{rejected_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append_log(events: DataFrame, out_path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """STR-2: append every accepted event (exactly once via the checkpoint).

    Folders are by day and by one of 64 hashes of the run, so their number does
    not grow with the runs; ``run_id`` stays a column, and a reader of one run
    filters by it and by its hash.
    """
    placed = events.withColumn("log_date", F.to_date("ts")).withColumn(
        "run_bucket", F.pmod(F.xxhash64("run_id"), F.lit(64)).cast("int"))
    writer = (placed.writeStream.format("parquet").partitionBy("log_date", "run_bucket")
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)


def append_to(stream: DataFrame, out_path: str, checkpoint: str, partition_by: Sequence[str] = (),
              available_now: bool = False) -> StreamingQuery:
    """Exactly-once parquet append of any stream (e.g. cleaned playback into silver)."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)


def replay(spark: SparkSession, log_path: str, schema: T.StructType = GATE_EVENT_SEQ) -> DataFrame:
    """STR-3: a late reader sees every stored event first, then new ones.

    A new query over the log directory starts from the earliest file; with a
    checkpoint it resumes where it stopped. Use ``trigger(availableNow=True)``
    for a bounded catch-up.
    """
    full = T.StructType([*schema.fields, T.StructField("log_date", T.DateType()),
                         T.StructField("run_bucket", T.IntegerType()), T.StructField("raw_line", T.StringType())])
    return spark.readStream.schema(full).parquet(log_path)


def run_status(events: DataFrame) -> DataFrame:
    """STR-4 / STR-5 streaming rollup: per run start, end, status and gate counts.

    One aggregate row per run is kept in state; emit with output mode
    ``update`` or ``complete``. Its rows equal the batch rollup's run columns.
    """
    return events.groupBy("run_id").agg(
        F.min(F.when(F.col("event") == "run_start", F.col("ts"))).alias("started_at"),
        F.max(F.when(F.col("event") == "run_end", F.col("ts"))).alias("finished_at"),
        F.max(F.when((F.col("event") == "gate_end") & (F.col("status") == "fail"), 1).otherwise(0)).alias("_failed"),
        F.count_if(F.col("event") == "gate_end").alias("gates_done"),
        F.count_if(F.col("event") == "log").alias("log_lines"),
    ).select("run_id", "started_at", "finished_at",
             F.when(F.col("_failed") == 1, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
             "gates_done", "log_lines")


def run_sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """STR-4 / STR-5 with bounded state: a run's events form a session window.

    A run is considered over once no event arrives for ``gap``; with the
    watermark, the engine finalises and evicts each run's state after that,
    so state does not grow with the number of runs ever seen. Session windows
    emit in output mode ``append``: one final row per run.
    """
    return (
        events.withWatermark("ts", watermark)
        .groupBy("run_id", F.session_window("ts", gap).alias("session"))
        .agg(
            F.min(F.when(F.col("event") == "run_start", F.col("ts"))).alias("started_at"),
            F.max(F.when(F.col("event") == "run_end", F.col("ts"))).alias("finished_at"),
            F.max(F.when((F.col("event") == "gate_end") & (F.col("status") == "fail"), 1).otherwise(0)).alias("_failed"),
            F.count_if(F.col("event") == "gate_end").alias("gates_done"),
        )
        .select("run_id", "session", "started_at", "finished_at",
                F.when(F.col("_failed") == 1, F.lit("fail")).otherwise(F.lit("pass")).alias("status"), "gates_done")
    )


def playback_stream(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw playback events arriving as files (F4 schema)."""
    return spark.readStream.schema(BRONZE_PLAYBACK).format(fmt).load(path)


def clean_playback(events: DataFrame, watermark: str = "2 days", dedupe: bool = True) -> DataFrame:
    """STR-10: silver cleaning of an arriving feed; ``event_id`` deduped within the watermark.

    The watermark bounds dedupe state; an event later than the watermark is
    dropped by the engine rather than kept forever in state.
    """
    cleaned = silver.stg_playback(events).withWatermark("started_at", watermark)
    return cleaned.dropDuplicatesWithinWatermark(["event_id"]) if dedupe else cleaned


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint folder; a new folder means a new stream."""
    row = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()
    return row["id"]


def upsert_stream(stream: DataFrame, base_path: str, keys: Sequence[str], order: Sequence[Column],
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """STR-11: rerunnable catalog refresh; each micro-batch is upserted as a new version, which rewrites the buckets
    of its keys only (``bronze.upsert_path``).

    A version records the last batch of this stream that it holds, by the
    stream's own id. A batch replayed after a failure is skipped by that record
    and by nothing else: versions written by others, or by a stream with another
    checkpoint, have no bearing on it.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        done = bronze.applied_batch(spark, base_path, query)
        if done is not None and done >= batch_id:
            return
        bronze.upsert_path(spark, base_path, batch, keys, order, batch=(query, batch_id))

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
