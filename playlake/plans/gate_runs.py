"""Gate runs end to end: NDJSON event files -> accepted events ->
per-gate and per-run records (F9 shape) -> one JSON document per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.operators import runlog
from playlake.streaming.streams import GATE_EVENT_SEQ


def events_from_files(spark: SparkSession, path: str) -> DataFrame:
    """STR-1 over stored logs; the arrival sequence is the emitter's ``seq``."""
    return runlog.parse_lines(spark.read.text(path), schema=GATE_EVENT_SEQ)


def run_records(events: DataFrame, trigger: str = "cli") -> DataFrame:
    """STR-4/5/6/7 and WIN-3: F9 run records with gate status, duration and tail."""
    runs = runlog.run_rollup(events, runlog.gate_rollup(events))
    return runs.select("run_id", "started_at", "finished_at", "status", F.lit(trigger).alias("trigger"), "gates")


def write_records(records: DataFrame, out_path: str) -> None:
    """One JSON document per run under ``run_id=...`` (readable by SRC-5)."""
    records.write.mode("append").partitionBy("run_id").json(out_path)
