"""Gate-run event log (STR-*) and data-quality operators (DQ-*)."""

import json
import os

from pyspark.sql import functions as F

from playlake.operators import quality, runlog
from playlake.sources import files

RUN = "20250102T030405Z-c0de"


def event(second, kind, gate=None, **more):
    return {"event": kind, "run_id": RUN, "ts": f"2025-01-02T03:04:{second:02d}Z", **({"gate": gate} if gate else {}), **more}


LINES = [
    event(5, "run_start", gates=["style", "docs", "load"]),
    "not an event: a stray print",
    "",
    event(6, "gate_start", "style"),
    event(6, "log", "style", line="checking 12 files"),
    event(7, "log", "style", line="all clean"),
    event(8, "gate_end", "style", status="pass", duration_s=1.25),
    event(8, "gate_start", "docs"),
    event(9, "gate_end", "docs", status="skip", reason="nothing to build", duration_s=0.5),
    event(10, "gate_start", "load"),
    event(12, "log", "load", line="p95 too high"),
    event(13, "gate_end", "load", status="fail"),
    event(14, "run_end", status="fail", duration_s=9.0),
]


def lines_df(spark, lines=LINES):
    rows = [(i, json.dumps(x) if isinstance(x, dict) else x) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "seq long, value string")


def test_parse_drops_noise_and_blank(spark):
    events = runlog.parse_lines(lines_df(spark), keep=["seq"])
    assert events.count() == len([x for x in LINES if isinstance(x, dict)])
    rej = runlog.rejected_lines(lines_df(spark), keep=["seq"]).collect()
    assert [r.line for r in rej] == ["not an event: a stray print"]


def test_rollups_totals_and_checks(spark):
    events = runlog.parse_lines(lines_df(spark), keep=["seq"])
    gates = runlog.gate_rollup(events)
    by_gate = {r.gate: r for r in gates.collect()}
    assert by_gate["style"].status == "pass" and by_gate["style"].duration_s == 1.25
    assert by_gate["style"].tail == ["checking 12 files", "all clean"]
    assert by_gate["docs"].status == "skip" and by_gate["docs"].tail == []
    assert by_gate["load"].duration_s == 3.0  # measured from start/end when not reported
    run = runlog.run_rollup(events, gates).first()
    assert run.status == "fail" and [g.gate for g in run.gates] == ["style", "docs", "load"]
    assert runlog.run_totals(gates).first().total_duration_s == 4.75
    assert runlog.run_totals(runlog.gate_rollup(events, tail_lines=0)).first().total_duration_s == 4.75
    chk = runlog.check_order(events).first()
    assert chk.starts_ok and chk.ends_ok and chk.bad_gates == 0
    broken = events.filter(~((F.col("event") == "run_end") | ((F.col("event") == "gate_start") & (F.col("gate") == "style"))))
    chk = runlog.check_order(broken).first()
    assert not chk.ends_ok and chk.bad_gates == 1


def test_skip_does_not_fail_run(spark):
    lines = [x for x in LINES if not (isinstance(x, dict) and x.get("gate") == "load")]
    events = runlog.parse_lines(lines_df(spark, lines), keep=["seq"])
    assert runlog.run_rollup(events, runlog.gate_rollup(events)).first().status == "pass"


def test_tail_keeps_last_n_in_order(spark):
    rows = [(1, i, f"line {i}") for i in range(120)]
    out = runlog.log_tail(spark.createDataFrame(rows, "g long, seq long, line string"), ["g"], "seq", "line", 50).first()
    assert out.tail == [f"line {i}" for i in range(70, 120)]


def test_run_records(spark, tmp):
    good = {"run_id": RUN, "started_at": "2025-01-02T03:04:05Z", "finished_at": "2025-01-02T03:04:14Z", "status": "pass",
            "trigger": "ui", "gates": [{"gate": "style", "status": "pass", "duration_s": 1.25, "tail": ["fine"]}]}
    newer = dict(good, run_id="20250103T000000Z-0ff1ce", gates=[])
    for name, doc in (("a.json", json.dumps(good, indent=2)), ("b.json", json.dumps(newer)), ("c.json", "{broken")):
        with open(os.path.join(tmp, name), "w") as f:
            f.write(doc)
    recs = files.read_run_records(spark, tmp)
    assert [r.run_id for r in recs.collect()] == ["20250103T000000Z-0ff1ce", RUN]
    checked = {r.run_id: r.record_ok for r in runlog.check_records(recs).collect()}
    assert checked == {RUN: True, "20250103T000000Z-0ff1ce": False}
    ids = {RUN: True, "": False, "/tmp/x": False, "..": False, RUN + "/..": False, RUN.upper(): False, "2025-01-02": False,
           " " + RUN: False, "20250102T030405Z-c0d": False, "20250102T030405Z-c0de0": True}
    rows = spark.createDataFrame([(x,) for x in ids], "run_id string")
    assert {r.run_id: r.ok for r in rows.select("run_id", runlog.valid_run_id(F.col("run_id")).alias("ok")).collect()} == ids


def test_quality_suite_drift_fingerprint(spark):
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    suite = quality.run_suite([
        quality.Check("unique", "dim", "k", dim),
        quality.Check("not_null", "dim", "k", dim),
        quality.Check("relationships", "fact", "k", fact, dim, "k"),
    ]).orderBy("test_order").collect()
    assert [(r.test, r.failures, r.passed) for r in suite] == [
        ("unique", 1, False), ("not_null", 1, False), ("relationships", 1, False)]
    a = spark.createDataFrame([("x", 0.5), ("y", None), ("y", None)], "t string, v double")
    b = spark.createDataFrame([("x", 0.50001), ("y", None)], "t string, v double")
    fa, fb = quality.freeze(a, ["t", "v"]), quality.freeze(b, ["t", "v"])
    assert {(r.t, r.v) for r in fa.collect()} == {("x", "0.5000"), ("y", "")}
    d = sorted((r.side, r.t, r.v) for r in quality.drift(fa, fb).collect())
    assert d == [("missing", "y", "")]
    f1 = quality.fingerprint(a).first()
    f2 = quality.fingerprint(a.repartition(3).orderBy(F.rand())).first()
    assert (f1.n_rows, f1.fingerprint) == (f2.n_rows, f2.fingerprint)
    assert quality.fingerprint(b).first().fingerprint != f1.fingerprint
    left, right = (spark.createDataFrame([r], "p string, q string") for r in (("x", None), (None, "x")))
    assert quality.fingerprint(left).first().fingerprint != quality.fingerprint(right).first().fingerprint
    pairs = [  # values and names that look like the encoding of others
        ([("1\nb=2", "3")], [("1", "2\nb=3")], "a string, b string", "a string, b string"),
        ([("\\n",)], [("\n",)], "a string", "a string"),
        ([(None,)], [("",)], "a string", "a string"),
        ([("1\nb!", None)], [("1", "\nb!")], "a string, b string", "a string, b string"),
        ([("x\nb=y", "z")], [("x", "y\nb=z\n#5,1")], "a string, b string", "a string, b string"),
    ]
    for x, y, s, t in pairs:
        assert quality.fingerprint(spark.createDataFrame(x, s)).first() != quality.fingerprint(spark.createDataFrame(y, t)).first()
    assert quality.fingerprint(spark.createDataFrame([("1",)], "`a.b` string")).first().n_rows == 1
    many = spark.createDataFrame([(1,)] * 9000, "k int")
    assert quality.drift(many, many.limit(1)).count() == 8999  # copies in several steps
    g = quality.gate(quality.gate_results(spark, [("style", "pass", None), ("docs", "skip", "absent"),
                                                  ("load", "fail", None)])).first()
    assert g.status == "fail" and [x.gate for x in g.gates] == ["style", "docs", "load"]
    bounds = quality.bounds_checks(spark.createDataFrame([(0.5, 1), (0.0, 0)], "w double, e long"),
                                   {"watch_pct": (F.col("w") > 0) & (F.col("w") <= 1), "episode": F.col("e") >= 1}).first()
    assert (bounds.watch_pct, bounds.episode) == (1, 1)


def test_unparseable_json_metric(spark):
    df = spark.createDataFrame([('["Action"]',), ("[]",), (None,), ("not json",), ('{"a": 1}',)], "genres string")
    row = quality.unparseable_json(df, "genres").first()
    assert (row.rows, row.unparseable) == (5, 2)


def test_accepted_and_rejected_lines_are_disjoint(spark):
    import json

    texts = ['{"seq":1,"x":NaN}', '{"seq":1,"seq":2}', '{"seq":3,"x":' + "9" * 1500 + "}", '{"seq":4,"x":0.' + "1" * 1200 + "}",
             '{"seq":5,"line":"' + "8" * 1500 + '"}', '{"x":+INF}', '{"x":-INF}', '{"x":+Infinity}', '{"x":-Infinity}', '{"x":"+INF"}',
             '{"x":1e+5}', '{"x":+1}', "\t", "", "[1] 2", "nope", "{'a':1}", '"a + b"', "7", '"open']
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    schema = "seq long, line string"
    good = {r.i: r for r in runlog.parse_lines(lines, keep=["i"], schema=schema, raw="raw").collect()}
    bad = {r.i: r.line for r in runlog.rejected_lines(lines, keep=["i"]).collect()}

    def fine(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    import sys
    limit = sys.get_int_max_str_digits()
    sys.set_int_max_str_digits(0)
    try:
        want = {i for i, t in enumerate(texts) if t.strip() and fine(t)}
    finally:
        sys.set_int_max_str_digits(limit)
    assert set(good) == want
    assert bad == {i: t for i, t in enumerate(texts) if t.strip() and i not in want}
    assert good[1].seq == 2 and good[2].raw == texts[2] and good[4].line == "8" * 1500
