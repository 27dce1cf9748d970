"""SRC-6: files that grow, restarts, unfinished lines, ranges, and rejected lines."""

import json
import os
import random

import pytest

from playlake.sources import tail
from playlake.streaming import streams


def _append(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as f:
        f.write(text.encode() if isinstance(text, str) else text)


def _run(stream, out, ck):
    q = (stream.writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start(out))
    q.awaitTermination(120)


def test_appended_lines_arrive_also_after_a_restart(spark, tmp):
    src, out, ck = (os.path.join(tmp, d) for d in ("live", "out", "ck"))
    line = lambda i: json.dumps({"event": "log", "run_id": "r", "seq": i}) + "\n"
    _append(f"{src}/run.ndjson", line(1) + line(2))
    _run(streams.gate_events(spark, src), out, ck)
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [1, 2]
    _append(f"{src}/run.ndjson", line(3) + line(4)[:-5])
    _append(f"{src}/other.ndjson", line(9))
    _run(streams.gate_events(spark, src), out, ck)  # a new query on the same checkpoint
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [1, 2, 3, 9]
    _append(f"{src}/run.ndjson", line(4)[-5:])
    _run(streams.gate_events(spark, src), out, ck)
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 9]
    _run(streams.gate_events(spark, src), out, ck)
    assert spark.read.parquet(out).count() == 5


def test_one_running_query_follows_a_file(spark, tmp):
    src = os.path.join(tmp, "live")
    _append(f"{src}/a.log", "one\n")
    q = (streams.read_lines(spark, src).writeStream.format("memory").queryName("tail_follow")
         .option("checkpointLocation", os.path.join(tmp, "ck")).start())
    try:
        q.processAllAvailable()
        _append(f"{src}/a.log", "two\nthr")
        q.processAllAvailable()
        assert sorted(r.value for r in spark.table("tail_follow").collect()) == ["one", "two"]
        _append(f"{src}/a.log", "ee\n")
        q.processAllAvailable()
        assert sorted(r.value for r in spark.table("tail_follow").collect()) == ["one", "three", "two"]
    finally:
        q.stop()


def test_accepted_and_rejected_lines_go_to_their_folders(spark, tmp):
    src, good, bad, ck = (os.path.join(tmp, d) for d in ("live", "good", "bad", "ck"))
    _append(f"{src}/a.log", '{"event":"log","seq":1}\nnoise\n\n')
    streams.split_log(spark, src, good, bad, ck).awaitTermination(120)
    _append(f"{src}/a.log", '{"event":"log","seq":2,"x":+INF}\n{"event":"log","seq":3}\n')
    streams.split_log(spark, src, good, bad, ck).awaitTermination(120)
    assert sorted(r.seq for r in spark.read.parquet(good).collect()) == [1, 3]
    assert sorted((r.offset, r.line) for r in spark.read.parquet(bad).collect()) == [(24, "noise"), (31, '{"event":"log","seq":2,"x":+INF}')]


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 10_000])
def test_ranges_hold_every_line_once(tmp, monkeypatch, chunk):
    monkeypatch.setattr(tail, "BLOCK", 5)
    rng = random.Random(chunk)
    lines = ["x" * rng.choice([0, 1, 3, 30]) + rng.choice(["", "é", "\r"]) for _ in range(60)]
    _append(f"{tmp}/f", "".join(x + "\n" for x in lines) + "open end")
    reader = tail.TailReader({"path": str(tmp), "chunk": str(chunk)})
    end = reader.latestOffset()
    found = []
    for span in reader.partitions(reader.initialOffset(), end):
        for batch in reader.read(span):
            found += list(zip(batch.column("offset").to_pylist(), batch.column("value").to_pylist(), strict=True))
    assert [v for _, v in sorted(found)] == [x.removesuffix("\r") for x in lines]
    assert reader.partitions(end, end) == []
    _append(f"{tmp}/f", "ed\nlast\n")
    more = [v for s in reader.partitions(end, reader.latestOffset()) for b in reader.read(s) for v in b.column("value").to_pylist()]
    assert more == ["open ended", "last"]


def test_settled_file_gives_its_unfinished_line_and_hidden_files_do_not_count(tmp):
    _append(f"{tmp}/f", "a\nb")
    _append(f"{tmp}/_hidden/x", "no\n")
    _append(f"{tmp}/.tmp", "no\n")
    os.utime(f"{tmp}/f", (1, 1))
    reader = tail.TailReader({"path": str(tmp), "settled": "60"})
    spans = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [v for s in spans for b in reader.read(s) for v in b.column("value").to_pylist()] == ["a", "b"]


def test_shorter_file_is_an_error(tmp):
    _append(f"{tmp}/f", "a\nb\n")
    reader = tail.TailReader({"path": str(tmp)})
    reader.latestOffset()
    with open(f"{tmp}/f", "w") as f:
        f.write("a\n")
    with pytest.raises(ValueError, match="shorter"):
        reader.latestOffset()


def test_missing_folder_is_empty(tmp):
    assert tail.TailReader({"path": f"{tmp}/absent"}).latestOffset() == {"files": {}}
