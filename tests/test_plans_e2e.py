"""Enrichment -> eval gate, and gate event files -> run records."""

import json
import os

from playlake.operators import runlog
from playlake.plans import enrichment, gate_runs
from playlake.schemas import MOOD_TAGS
from playlake.sources import files

from tests.classifier import keyword_classifier
from tests.test_runlog_quality import LINES


def test_enrichment_and_gate(spark):
    titles = spark.createDataFrame(
        [(501, "A cozy street whose lamps go dark one after the other", "Lantern Street", ["Mystery"]),
         (502, "Nine suns of tin, absurd machines and endless hype", "Nine Tin Suns", ["Music"]),
         (503, "short", "Salt", ["Drama"])],
        "title_key long, synopsis string, title string, genres array<string>")
    results = enrichment.enrich_titles(titles, keyword_classifier(MOOD_TAGS), "keyword-v1",
                                       enriched_at="2026-07-11T00:00:00Z")
    assert sorted(r.media_id for r in results.collect()) == [501, 502]
    again = enrichment.enrich_titles(titles, keyword_classifier(MOOD_TAGS), "keyword-v1", done=results)
    assert again.count() == 0
    golden = spark.createDataFrame([(501, ["cozy", "dark"]), (502, ["absurd"]), (503, ["dark"])],
                                   "media_id long, mood_tags array<string>")
    out = enrichment.evaluate(golden, results)
    s = out["summary"].first()
    assert (s.n_scored, s.n_golden) == (2, 3) and s.parse_fail_rate == 0.0
    assert {r.tag for r in out["prf"].collect()} == set(MOOD_TAGS)


def test_gate_records_round_trip(spark, tmp):
    src = os.path.join(tmp, "logs")
    os.makedirs(src)
    with open(os.path.join(src, "run.ndjson"), "w") as f:
        for i, x in enumerate(LINES):
            f.write((json.dumps(dict(x, seq=i)) if isinstance(x, dict) else x) + "\n")
    recs = gate_runs.run_records(gate_runs.events_from_files(spark, src), trigger="ui")
    out = os.path.join(tmp, "runs")
    gate_runs.write_records(recs, out)
    back = spark.read.json(out).first()
    assert back.status == "fail" and back.trigger == "ui" and len(back.gates) == 3
    checked = runlog.check_records(recs).first()
    assert checked.record_ok
