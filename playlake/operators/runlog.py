"""Gate-run event log: parse, rollups, totals, integrity checks (STR-1, STR-4..9, WIN-3).

Events follow FIXTURES F8 plus ``seq``, an arrival sequence (events of a run
tie on their 1-second ``ts``). Every per-run or per-gate collection here is
bounded: gates per run are a short fixed list and tails keep at most
``TAIL_LINES`` lines, cut map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.functions.json import json_lines
from playlake.functions.strings import py_strip
from playlake.operators.silver import latest
from playlake.schemas import GATE_EVENT, RUN_ID_PATTERN, TAIL_LINES


def classified_lines(lines: DataFrame, value: str = "value", text: str = "_text", reason: str = "reason") -> DataFrame:
    """STR-1: the non-blank lines, each with the text of its one JSON value or the reason why it has none.

    One parse serves both outputs; see ``json_lines``. Lines of white space only are blank, as for ``str.strip``.
    """
    return json_lines(lines.filter(F.length(py_strip(F.col(value))) > 0), value, text, reason)


def accepted(classified: DataFrame, value: str = "value", keep: Sequence[str] = (), schema=None, raw: str | None = None) -> DataFrame:
    """The events of ``classified_lines``: F8 columns plus ``keep``, and the line as it came if ``raw`` names a column."""
    schema = schema or GATE_EVENT
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = classified.filter(F.col("reason").isNull()).withColumn("_event", F.from_json("_text", schema))
    line = [F.col(value).alias(raw)] if raw else []
    return fields.select(*keep, *line, *[F.col(f"_event.{f.name}").alias(f.name) for f in schema.fields])


def rejected(classified: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The other lines of ``classified_lines``, whole, with the reason."""
    return classified.filter(F.col("reason").isNotNull()).select(*keep, F.col(value).alias("line"), "reason")


def parse_lines(lines: DataFrame, value: str = "value", keep: Sequence[str] = (), schema=None,
                raw: str | None = None) -> DataFrame:
    """STR-1: keep lines that are exactly one JSON value; blank lines skipped.

    Works on batch and streaming frames alike. Returns the F8 columns plus
    ``keep``; ``raw`` names a column for the line as it came, so that fields
    outside the schema are not lost. A value that is no object has NULL fields.
    """
    return accepted(classified_lines(lines, value), value, keep, schema, raw)


def rejected_lines(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """STR-1 side output: non-blank lines that are not one JSON value, whole, with the reason."""
    return rejected(classified_lines(lines, value), value, keep)


def log_tail(df: DataFrame, group: Sequence[str], seq: str, line: str, n: int = TAIL_LINES,
             alias: str = "tail") -> DataFrame:
    """WIN-3: the last ``n`` lines per group, in sequence order.

    ``row_number() <= n`` is planned as a WindowGroupLimit that trims each
    group to ``n`` rows on the map side, so a hot group ships at most ``n``
    rows per input partition; the collected list is then bounded by ``n``.
    """
    w = Window.partitionBy(*group).orderBy(F.col(seq).desc())
    last = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return last.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(line).alias("l")))),
                    lambda x: x["l"]).alias(alias)
    )


def centiseconds(start: Column, end: Column) -> Column:
    """Whole hundredths of a second between two timestamps, rounded half up on integers."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor((micros + F.lit(5000)) / F.lit(10000)).cast("long")


def gate_rollup(events: DataFrame, tail_lines: int = TAIL_LINES) -> DataFrame:
    """STR-4 / STR-6 per gate: status and duration from its end event (duration
    from start/end timestamps when absent), the last log lines, first sequence.

    The aggregation over every event uses fixed-width buffers only (hash
    aggregate, map-side combine); the last end event per gate is picked from
    the few ``gate_end`` rows alone, and the tail is trimmed map-side.
    """
    keys = ["run_id", "gate"]
    g = events.filter(F.col("gate").isNotNull())
    bounds = g.groupBy(*keys).agg(
        F.min("seq").alias("first_seq"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
        F.min(F.when(F.col("event") == "gate_start", F.col("ts"))).alias("_start"),
        F.max(F.when(F.col("event") == "gate_end", F.col("ts"))).alias("_end"),
        F.count_if(F.col("event") == "log").alias("n_lines"),
    )
    ends = latest(g.filter(F.col("event") == "gate_end"), keys, [F.col("seq").desc()]).select(
        *keys, F.col("status").alias("_status"), F.col("duration_s").alias("_reported"))
    rows = bounds.join(ends, keys, "left")
    if tail_lines > 0:
        rows = rows.join(log_tail(g.filter(F.col("event") == "log"), keys, "seq", "line", tail_lines), keys, "left")
    else:  # nobody asks for the lines: they are not read
        rows = rows.withColumn("tail", F.lit(None).cast("array<string>"))
    measured = centiseconds(F.col("_start"), F.col("_end")).cast("double") / F.lit(100.0)
    return rows.select(
        *keys,
        "first_seq",
        "started_at",
        "ended_at",
        F.coalesce(F.col("_status"), F.lit("unknown")).alias("status"),
        F.coalesce(F.col("_reported"), measured).alias("duration_s"),
        F.coalesce(F.col("tail"), F.array().cast("array<string>")).alias("tail"),
        "n_lines",
    )


def run_rollup(events: DataFrame, gates: DataFrame) -> DataFrame:
    """STR-4 / STR-5: one record per run; fail if any gate failed (skip never fails).

    Only the run_start / run_end events are read here (the filter reaches the
    scan); the per-gate rows supply the rest, and the gate list per run is
    bounded by the gates a run declares.
    """
    marks = events.filter(F.col("event").isin("run_start", "run_end")).groupBy("run_id").agg(
        F.min(F.when(F.col("event") == "run_start", F.col("ts"))).alias("_start"),
        F.max(F.when(F.col("event") == "run_end", F.col("ts"))).alias("finished_at"),
    )
    per_run = gates.groupBy("run_id").agg(
        F.min("started_at").alias("_first"),
        F.max(F.when(F.col("status") == "fail", 1).otherwise(0)).alias("_failed"),
        F.array_sort(F.collect_list(F.struct("first_seq", "gate", "status", "duration_s", "tail"))).alias("_g"),
    )
    return marks.join(per_run, "run_id", "full").select(
        "run_id",
        F.coalesce("_start", "_first").alias("started_at"),
        "finished_at",
        F.when(F.col("_failed") == 1, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.coalesce(
            F.transform("_g", lambda s: F.struct(s["gate"].alias("gate"), s["status"].alias("status"),
                                                 s["duration_s"].alias("duration_s"), s["tail"].alias("tail"))),
            F.array().cast("array<struct<gate:string,status:string,duration_s:double,tail:array<string>>>"),
        ).alias("gates"),
    )


def run_totals(gates: DataFrame, scale: int = 2) -> DataFrame:
    """STR-7: run total = sum of its gates' durations, a missing duration counting 0.

    ``gates`` are rows of :func:`gate_rollup`; their tails are not needed.
    """
    total = F.sum(F.coalesce("duration_s", F.lit(0.0)))
    return gates.groupBy("run_id").agg(F.round(total, scale).alias("total_duration_s"))


def first_last(df: DataFrame, group: Sequence[str], seq: str, value: str) -> DataFrame:
    """First and last ``value`` per group by ``seq``, with the row count (map-side partials)."""
    return df.groupBy(*group).agg(
        F.min_by(value, seq).alias("first_" + value),
        F.max_by(value, seq).alias("last_" + value),
        F.count(F.lit(1)).alias("n"),
    )


def check_order(events: DataFrame) -> DataFrame:
    """STR-8: per run, first event run_start, last run_end, every gate started before it ended."""
    ends = first_last(events, ["run_id"], "seq", "event")
    gate_ok = events.filter(F.col("gate").isNotNull()).groupBy("run_id", "gate").agg(
        F.min(F.when(F.col("event") == "gate_start", F.col("seq"))).alias("s"),
        F.max(F.when(F.col("event") == "gate_end", F.col("seq"))).alias("e"),
    ).groupBy("run_id").agg(
        F.count_if(F.col("s").isNull() | F.col("e").isNull() | (F.col("s") > F.col("e"))).alias("bad_gates")
    )
    return ends.join(gate_ok, "run_id", "left").select(
        "run_id",
        (F.col("first_event") == "run_start").alias("starts_ok"),
        (F.col("last_event") == "run_end").alias("ends_ok"),
        F.coalesce("bad_gates", F.lit(0)).alias("bad_gates"),
    )


def check_records(records: DataFrame) -> DataFrame:
    """STR-9 / FLT-8: required fields present, valid id, non-empty complete gates."""
    gate_ok = F.forall(
        "gates",
        lambda g: g["gate"].isNotNull() & g["status"].isNotNull() & g["duration_s"].isNotNull() & g["tail"].isNotNull(),
    )
    ok = (
        F.col("run_id").rlike(RUN_ID_PATTERN)
        & F.col("started_at").isNotNull()
        & F.col("finished_at").isNotNull()
        & F.col("status").isin("pass", "fail")
        & (F.size("gates") > 0)
        & gate_ok
    )
    return records.withColumn("record_ok", F.coalesce(ok, F.lit(False)))


def valid_run_id(c: Column) -> Column:
    """FLT-8: run ids that are safe to use as file names."""
    return F.coalesce(c.rlike(RUN_ID_PATTERN), F.lit(False))
