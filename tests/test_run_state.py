"""Streamed run status: the state falls back to open runs, late events correct, the fold equals the batch rollup."""

import json
import os
import time

from playlake.operators import runlog
from playlake.streaming import run_state, streams


def event(run, second, kind, gate=None, **more):
    return {"event": kind, "run_id": run, "ts": f"2025-01-02T03:04:{second:02d}Z", "gate": gate, "seq": second, **more}


def write(folder, name, events):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in events)


def drain(spark, tmp):
    """Everything that arrived goes through the stream; rows in the state afterwards."""
    parts = run_state.run_parts(streams.gate_events(spark, os.path.join(tmp, "live")), silence_ms=None)
    q = streams.append_to(parts, os.path.join(tmp, "parts"), os.path.join(tmp, "ck"), available_now=True)
    assert q.awaitTermination(60) and q.exception() is None
    return [p for p in q.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"]


COLS = ["run_id", "started_at", "finished_at", "status", "gates_done", "log_lines"]


def test_state_holds_open_runs_only(spark, tmp):
    live = os.path.join(tmp, "live")
    kinds = lambda: sorted((r.run_id or "", r.kind) for r in spark.read.schema(run_state.OUT).parquet(os.path.join(tmp, "parts")).collect())
    closed = [e for i in range(20) for e in (event(f"r{i}", 1, "run_start"), event(f"r{i}", 3, "gate_end", "style", status="pass"),
                                             event(f"r{i}", 9, "run_end"))]
    write(live, "1.ndjson", [event("open", 1, "run_start"), event("open", 2, "log", "style", line="x"), *closed])
    assert drain(spark, tmp) == 1
    assert kinds() == sorted((f"r{i}", "final") for i in range(20))
    # late events, repeated ones, one without a run, and a run whose start comes after its gate
    late = [event("r3", 8, "gate_end", "docs", status="fail"), event("r3", 8, "log", "docs", line="late"), event("r3", 8, "log", "docs", line="late"),
            event(None, 5, "log", "style", line="whose?"), event("odd", 4, "gate_end", "style", status="pass")]
    write(live, "2.ndjson", late)
    assert drain(spark, tmp) == 1
    write(live, "3.ndjson", [event("open", 7, "gate_end", "style", status="skip"), event("open", 8, "run_end"), event("odd", 1, "run_start")])
    assert drain(spark, tmp) == 1  # 'odd' is open now
    write(live, "4.ndjson", [event("odd", 6, "run_end")])
    assert drain(spark, tmp) == 0
    assert ("r3", "correction") in kinds() and ("", "correction") in kinds() and ("odd", "correction") in kinds()

    folded = run_state.fold(spark.read.schema(run_state.OUT).parquet(os.path.join(tmp, "parts")))
    batch = streams.run_status(runlog.parse_lines(spark.read.text(live), schema=streams.GATE_EVENT_SEQ))
    assert sorted(map(repr, folded.select(COLS).collect())) == sorted(map(repr, batch.select(COLS).collect()))
    assert folded.filter("run_id = 'r3'").first().status == "fail"


def test_a_silent_run_leaves_the_state(spark, tmp):
    live, out = os.path.join(tmp, "live"), os.path.join(tmp, "parts")
    write(live, "1.ndjson", [event("gone", 1, "run_start"), event("gone", 2, "gate_end", "style", status="fail")])
    parts = run_state.run_parts(streams.gate_events(spark, live), silence_ms=500)
    q = parts.writeStream.format("parquet").option("checkpointLocation", os.path.join(tmp, "ck")).trigger(processingTime="1 second").start(out)
    try:
        for _ in range(60):
            time.sleep(0.5)
            left = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
            if 1 in left and left[-1] == 0:
                break
        assert q.exception() is None and 1 in left and left[-1] == 0
    finally:
        q.stop()
    row = run_state.fold(spark.read.schema(run_state.OUT).parquet(out)).first()
    assert (row.run_id, row.status, row.gates_done, row.finished_at) == ("gone", "fail", 1, None)
