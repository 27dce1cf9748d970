"""STR-4 / STR-5 as a stream whose state holds open runs only.

A run enters the state with its ``run_start`` and leaves it with its ``run_end``, or after a silence by the clock. What leaves is a
partial record; events that come for a run that is not open make a partial record of their own, marked as a correction, and
no state. Partial records add up: ``fold`` gives the rows of ``streams.run_status`` whatever the order of arrival, so no
late event is dropped and none keeps a run in the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PART = "run_id string, started_us long, finished_us long, failed long, gates_done long, log_lines long"
STATE = "started_us long, finished_us long, failed long, gates_done long, log_lines long"
OUT = f"{PART}, kind string"
_NAMES = ["started_us", "finished_us", "failed", "gates_done", "log_lines"]
_EMPTY = (None, None, 0, 0, 0)


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _most(a, b):
    return b if a is None else a if b is None else max(a, b)


def _add(x: tuple, y: tuple) -> tuple:
    return _least(x[0], y[0]), _most(x[1], y[1]), max(x[2], y[2]), x[3] + y[3], x[4] + y[4]


def _rows(part: pd.DataFrame) -> Iterator[tuple]:
    for row in part[_NAMES].itertuples(index=False, name=None):
        yield tuple(None if v is None or pd.isna(v) else int(v) for v in row)


def _frame(run_id, values: tuple, *more) -> pd.DataFrame:
    """One row; whole numbers stay whole beside NULLs."""
    out = pd.DataFrame({"run_id": pd.Series([run_id], dtype=object)})
    for name, value in zip(_NAMES, values, strict=True):
        out[name] = pd.array([value], dtype="Int64")
    if more:
        out["kind"] = pd.Series([more[0]], dtype=object)
    return out


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per run of an Arrow batch, so that a hot run is small before it is shuffled."""
    for batch in batches:
        for name in _NAMES:
            batch[name] = batch[name].astype("Int64")
        sums = batch.groupby("run_id", dropna=False).agg(
            started_us=("started_us", "min"), finished_us=("finished_us", "max"), failed=("failed", "max"),
            gates_done=("gates_done", "sum"), log_lines=("log_lines", "sum")).reset_index()
        sums["run_id"] = sums["run_id"].astype(object).where(sums["run_id"].notna(), None)
        yield sums


def _step(silence_ms: int | None):
    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run_id = key[0]
        if state.hasTimedOut:
            left = tuple(state.get)
            state.remove()
            yield _frame(run_id, left, "silent")
            return
        total, was_open = (tuple(state.get), True) if state.exists else (_EMPTY, False)
        for part in parts:
            for row in _rows(part):
                total = _add(total, row)
        if not was_open and total[0] is None:
            yield _frame(run_id, total, "correction")
        elif total[1] is not None:
            if was_open:
                state.remove()
            yield _frame(run_id, total, "final")
        else:
            state.update(total)
            if silence_ms is not None:
                state.setTimeoutDuration(silence_ms)

    return step


def run_parts(events: DataFrame, silence_ms: int | None = 6 * 3600 * 1000) -> DataFrame:
    """Partial records of a stream of gate events: ``run_id``, sums, and ``kind`` (final, silent or correction).

    Write them in output mode ``append``. Events without a run_id belong to one run named NULL. A run whose ``run_end`` comes
    before its other events gives its record and then corrections. A run that is open at the end of the stream has no record yet.
    Silence is measured by the clock, so Spark runs batches for as long as the query lives: a bounded catch-up (``availableNow``) would
    never end and needs ``silence_ms=None``, with which runs leave by ``run_end`` only.
    """
    micros = F.unix_micros("ts")

    def only(kind: str, value: Column) -> Column:
        return F.when(F.col("event") == kind, value)

    lean = events.select(
        "run_id", only("run_start", micros).alias("started_us"), only("run_end", micros).alias("finished_us"),
        F.coalesce(only("gate_end", (F.col("status") == "fail").cast("long")), F.lit(0)).cast("long").alias("failed"),
        F.coalesce(only("gate_end", F.lit(1)), F.lit(0)).cast("long").alias("gates_done"),
        F.coalesce(only("log", F.lit(1)), F.lit(0)).cast("long").alias("log_lines"))
    return lean.mapInPandas(_combine, PART).groupBy("run_id").applyInPandasWithState(
        _step(silence_ms), OUT, STATE, "append",
        GroupStateTimeout.NoTimeout if silence_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def fold(parts: DataFrame) -> DataFrame:
    """The rows of ``streams.run_status`` from stored partial records, with ``corrections`` (how many came late)."""
    return parts.groupBy("run_id").agg(
        F.timestamp_micros(F.min("started_us")).alias("started_at"), F.timestamp_micros(F.max("finished_us")).alias("finished_at"),
        F.when(F.max("failed") == 1, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.sum("gates_done").alias("gates_done"), F.sum("log_lines").alias("log_lines"),
        F.count_if(F.col("kind") == "correction").alias("corrections"))
