"""Structured Streaming (stream = batch) and the enrichment job."""

import json
import os

from pyspark.sql import functions as F

from playlake.operators import enrich, runlog
from playlake.schemas import BRONZE_PLAYBACK, MOOD_TAGS
from playlake.sources import bronze
from playlake.streaming import streams

from tests.classifier import keyword_classifier
from tests.test_runlog_quality import LINES


def _write_ndjson(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for i, x in enumerate(lines):
            if isinstance(x, dict):
                x = json.dumps(dict(x, seq=i))
            f.write(x + "\n")


def test_gate_stream_equals_batch(spark, tmp):
    src = os.path.join(tmp, "live")
    _write_ndjson(src, "run.ndjson", LINES)
    stream = streams.gate_events(spark, src)
    q = streams.append_log(stream, os.path.join(tmp, "log"), os.path.join(tmp, "ck1"), available_now=True)
    q.awaitTermination(120)
    stored = spark.read.parquet(os.path.join(tmp, "log"))
    batch = runlog.parse_lines(spark.read.text(src), schema=streams.GATE_EVENT_SEQ)
    cols = ["seq", "event", "gate", "status"]
    assert sorted(map(tuple, stored.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))

    # replay: a late reader sees every stored event; the streaming rollup equals the batch one
    late = streams.run_status(streams.replay(spark, os.path.join(tmp, "log")))
    q2 = (late.writeStream.format("memory").queryName("run_status_t").outputMode("complete")
          .option("checkpointLocation", os.path.join(tmp, "ck2")).trigger(availableNow=True).start())
    q2.awaitTermination(120)
    row = spark.table("run_status_t").first()
    gates = runlog.gate_rollup(batch)
    b = runlog.run_rollup(batch, gates).first()
    assert (row.run_id, row.status, row.started_at, row.finished_at) == (b.run_id, b.status, b.started_at, b.finished_at)
    assert row.gates_done == 3 and row.log_lines == 3


def test_playback_stream_dedupes_within_watermark(spark, tmp):
    src = os.path.join(tmp, "pb")
    os.makedirs(src)
    ev = lambda eid, uid, pct, t: {"event_id": eid, "user_id": uid, "media_id": 1, "episode": 1, "started_at": t,
                                   "watch_pct": pct, "completed": False, "rebuffer_count": 0,
                                   "startup_time_ms": 900, "device": "tv", "region": "NA"}
    rows = [ev("1-1-1", 1, 0.5, "2026-04-01T00:00:00+00:00"), ev("1-1-1", 1, 0.5, "2026-04-01T00:00:00+00:00"),
            ev("2-1-1", 2, 1.5, "2026-04-01T00:00:00+00:00"), ev("3-1-1", None, 0.5, "2026-04-01T00:00:00+00:00"),
            ev("4-1-1", 4, 0.9, "2026-04-01T01:00:00+00:00")]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    cleaned = streams.clean_playback(streams.playback_stream(spark, src))
    q = (cleaned.writeStream.format("memory").queryName("pb_t").option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.event_id for r in spark.table("pb_t").collect()) == ["1-1-1", "4-1-1"]


def test_upsert_stream_is_rerunnable(spark, tmp):
    src = os.path.join(tmp, "cat")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in [{"k": 1, "v": "a", "ver": 1}, {"k": 1, "v": "b", "ver": 2},
                                                   {"k": 2, "v": "c", "ver": 1}]))
    stream = spark.readStream.schema("k long, v string, ver long").json(src)
    base = os.path.join(tmp, "tbl")
    q = streams.upsert_stream(stream, base, ["k"], [F.col("ver").desc()], os.path.join(tmp, "ck"))
    q.awaitTermination(120)
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write(json.dumps({"k": 2, "v": "d", "ver": 5}))
    q = streams.upsert_stream(stream, base, ["k"], [F.col("ver").desc()], os.path.join(tmp, "ck"))
    q.awaitTermination(120)
    assert sorted((r.k, r.v) for r in bronze.read_versioned(spark, base).collect()) == [(1, "b"), (2, "d")]


def _json_rows(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_upsert_stream_on_a_table_that_has_versions(spark, tmp):
    base, order = os.path.join(tmp, "tbl"), [F.col("ver").desc()]
    schema = "k long, v string, ver long"
    for v in range(3):
        bronze.upsert_path(spark, base, spark.createDataFrame([(v, "seed", 0)], schema), ["k"], order)
    src = os.path.join(tmp, "cat")
    _json_rows(src, "a.json", [{"k": 9, "v": "new", "ver": 1}])
    stream = spark.readStream.schema(schema).json(src)
    streams.upsert_stream(stream, base, ["k"], order, os.path.join(tmp, "ck")).awaitTermination(120)
    want = [(0, "seed"), (1, "seed"), (2, "seed"), (9, "new")]
    assert sorted((r.k, r.v) for r in bronze.read_versioned(spark, base).collect()) == want
    # a stream with a new checkpoint starts at batch 0 again, and its rows arrive too
    _json_rows(src, "b.json", [{"k": 9, "v": "newer", "ver": 2}])
    streams.upsert_stream(stream, base, ["k"], order, os.path.join(tmp, "ck-new")).awaitTermination(120)
    assert {r.k: r.v for r in bronze.read_versioned(spark, base).collect()}[9] == "newer"


def test_a_replayed_batch_is_applied_once(spark, tmp):
    base, order, schema = os.path.join(tmp, "tbl"), [F.col("ver").desc()], "k long, v string, ver long"
    first = spark.createDataFrame([(1, "a", 1)], schema)
    assert bronze.upsert_path(spark, base, first, ["k"], order, batch=("q", 0)) == 0
    assert bronze.applied_batch(spark, base, "q") == 0 and bronze.applied_batch(spark, base, "other") is None
    assert bronze.upsert_path(spark, base, spark.createDataFrame([(1, "b", 2)], schema), ["k"], order) == 1
    assert bronze.applied_batch(spark, base, "q") == 0  # kept by versions that others write


def test_enrichment_job(spark):
    titles = spark.createDataFrame([(1, "A dark and absurd tale " * 3), (2, "short"), (3, "Cozy slice of life " * 200)],
                                   "title_key long, synopsis string")
    cands = enrich.candidates(titles)
    assert sorted(r.media_id for r in cands.collect()) == [1, 3]
    assert max(len(r.prompt) for r in cands.collect()) == 2000
    raw = enrich.classify(cands, keyword_classifier(MOOD_TAGS))
    out = {r.media_id: r for r in enrich.assemble(raw, "keyword-v1", enriched_at="2026-07-11T00:00:00Z").collect()}
    assert out[1].mood_tags == ["dark", "absurd"] and out[1].parse_ok and out[3].mood_tags == ["cozy"]
    done = raw.select("media_id").filter("media_id = 1")
    assert [r.media_id for r in enrich.candidates(titles, done=done).collect()] == [3]


def test_run_sessions_bounded_state(spark, tmp):
    src = os.path.join(tmp, "live2")
    _write_ndjson(src, "run.ndjson", LINES)
    later = [dict(x, run_id="20250102T090000Z-beef", ts=x["ts"].replace("T03:", "T09:")) if isinstance(x, dict) else x
             for x in LINES]
    _write_ndjson(src, "run2.ndjson", later)
    sessions = streams.run_sessions(streams.gate_events(spark, src), gap="10 minutes", watermark="5 minutes")
    q = (sessions.writeStream.format("memory").queryName("sessions_t").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = {r.run_id: r for r in spark.table("sessions_t").collect()}
    # the early run is final once the watermark passed its session end; the later one is still open
    assert set(rows) == {LINES[0]["run_id"]}
    assert rows[LINES[0]["run_id"]].status == "fail" and rows[LINES[0]["run_id"]].gates_done == 3


def test_playback_stream_feeds_the_mart(spark, tmp):
    from playlake.operators import gold

    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    rows = []
    for uid in range(1, 31):
        for ep in (1, 2) if uid % 3 else (1,):
            rows.append({"event_id": f"{uid}-7-{ep}", "user_id": uid, "media_id": 7, "episode": ep,
                         "started_at": "2026-04-01T10:00:00+00:00", "watch_pct": 0.5, "completed": False,
                         "rebuffer_count": 0, "startup_time_ms": 900, "device": "tv", "region": "NA"})
    rows.append(dict(rows[0]))  # a redelivered event
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    silver_path = os.path.join(tmp, "silver")
    q = streams.append_to(streams.clean_playback(streams.playback_stream(spark, src)), silver_path,
                          os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination(120)
    stored = spark.read.parquet(silver_path)
    assert stored.count() == len(rows) - 1
    dim = spark.createDataFrame([(7, "Seven")], "title_key long, title string")
    mart = gold.episode_dropoff(gold.fact_playback(stored), dim).first()
    assert (mart.ep1_viewers, mart.ep2_viewers) == (30, 20)


def test_classifier_called_once_per_title(spark, tmp):
    import pandas as pd

    log = os.path.join(tmp, "calls.txt")

    def counting(batch: pd.DataFrame) -> pd.DataFrame:
        with open(log, "a") as f:
            f.write("".join(f"{m}\n" for m in batch["media_id"]))
        return pd.DataFrame({"media_id": batch["media_id"].astype("int64"), "raw_response": '["dark"]',
                             "latency_ms": 1, "input_tokens": 1, "output_tokens": 1})

    titles = spark.createDataFrame([(i, "a long enough synopsis text " * 3) for i in range(40)],
                                   "title_key long, synopsis string").repartition(4)
    raw = enrich.classify(enrich.candidates(titles), counting)
    assert raw.count() == 40 and len(raw.collect()) == 40
    assert enrich.assemble(raw, "m").filter("parse_ok").count() == 40
    calls = open(log).read().split()
    assert sorted(map(int, calls)) == list(range(40))  # each title classified exactly once
