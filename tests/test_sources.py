"""File sources and sinks: JSON lines, golden CSV freeze/check, report JSON, vector catalog."""

import json
import os

import pytest
from pyspark.sql import functions as F

from playlake.operators import quality, report, stats
from playlake.schemas import GOLDEN_LABELS
from playlake.sources import files


def test_jsonl_strict_and_permissive(spark, tmp):
    path = os.path.join(tmp, "golden.jsonl")
    with open(path, "w") as f:
        f.write('{"media_id": 501, "title": "Lantern Street", "mood_tags": ["cozy"]}\n')
        f.write("{broken\n")
        f.write('{"media_id": 502, "title": "Nine Tin Suns", "mood_tags": ["dark", "absurd"]}\n')
    ok = files.read_jsonl(spark, path, GOLDEN_LABELS)
    assert sorted(r.media_id for r in ok.collect()) == [501, 502]
    with pytest.raises(Exception):
        files.read_jsonl(spark, path, GOLDEN_LABELS, strict=True).collect()


def test_golden_freeze_write_and_check(spark, tmp):
    mart = spark.createDataFrame([("B", "Action", 56, 48, 0.857142), ("A", None, 169, 144, 0.852071)],
                                 "title string, primary_genre string, ep1_viewers long, ep2_viewers long, "
                                 "ep2_retention double")
    cols = ["title", "primary_genre", "ep1_viewers", "ep2_viewers", "ep2_retention"]
    frozen = quality.freeze(mart, cols)
    out = os.path.join(tmp, "golden")
    files.write_golden_csv(mart, out, cols, ["title"])
    csv = [p for p in os.listdir(out) if p.endswith(".csv")]
    assert len(csv) == 1
    lines = open(os.path.join(out, csv[0])).read().splitlines()
    assert lines == ["title,primary_genre,ep1_viewers,ep2_viewers,ep2_retention",
                     "A,,169,144,0.8521", "B,Action,56,48,0.8571"]
    same = quality.golden_check(spark, "episode_dropoff", frozen, out).first()
    assert (same.status, same.drift_rows) == ("pass", 0)
    changed = quality.freeze(mart.withColumn("ep2_viewers", F.col("ep2_viewers") + 1), cols)
    bad = quality.golden_check(spark, "episode_dropoff", changed, out).first()
    assert (bad.status, bad.drift_rows) == ("fail", 4)
    missing = quality.golden_check(spark, "dim_title", frozen, os.path.join(tmp, "nope")).first()
    assert missing.status == "skip"


def test_report_document_sink(spark, tmp):
    mart = spark.createDataFrame([(i, f"t{i}", "Action" if i % 2 else "Drama", 0.5 + i / 100, 20 + i)
                                  for i in range(40)],
                                 "title_key long, title string, primary_genre string, ep2_retention double, ep1_viewers long")
    counts = report.row_counts(catalog_n=mart, users_n=mart.limit(3))
    doc = report.report_document(
        counts, report.value_histogram(mart, "ep2_retention"),
        report.group_means(mart, "primary_genre", "ep2_retention"),
        stats.eta_squared(mart, "primary_genre", "ep2_retention"),
        mart.groupBy("primary_genre").agg(F.count(F.lit(1)).alias("n")),
        report.top_bottom(mart, "ep2_retention", "title_key", 15),
        generated_at=F.lit("2026-07-11T00:00:00Z"))
    out = os.path.join(tmp, "report")
    files.write_report(doc, out)
    body = [p for p in os.listdir(out) if p.endswith(".json")]
    data = json.loads(open(os.path.join(out, body[0])).read().splitlines()[0])
    assert data["catalog_n"] == 40 and data["users_n"] == 3
    assert len(data["retention_hist"]) == 40 and len(data["titles_sample"]) == 30
    assert [g["primary_genre"] for g in data["genre_means"]] == ["Action", "Drama"]  # the higher mean first
    sample = data["titles_sample"]
    assert [x["side"] for x in sample] == ["top"] * 15 + ["bottom"] * 15
    assert [x["rank"] for x in sample] == [*range(1, 16), *range(1, 16)] and sample[0]["title_key"] == 39 and sample[15]["title_key"] == 0
    assert [x["ep2_retention"] for x in data["retention_hist"]] == sorted(x["ep2_retention"] for x in data["retention_hist"])


def test_golden_csv_follows_typed_keys(spark, tmp):
    rows = [(k, f"t{k}") for k in (100, 2, 10, 1, 33)]
    out = os.path.join(tmp, "numeric")
    files.write_golden_csv(spark.createDataFrame(rows, "title_key long, title string"), out, ["title_key", "title"], ["title_key"])
    body = "".join(open(os.path.join(out, p)).read() for p in sorted(os.listdir(out)) if p.endswith(".csv"))
    keys = [line.split(",")[0] for line in body.splitlines() if line[0].isdigit()]
    assert keys == ["1", "2", "10", "33", "100"]


def test_vector_catalog(spark):
    titles = spark.createDataFrame([(1, ["Action"]), (2, ["Comedy"])], "title_key long, genres array<string>")
    dim = spark.createDataFrame([(1, "Lantern Street", "Action", 26), (2, "Nine Tin Suns", "Comedy", None)],
                                "title_key long, title string, genre string, episodes long")
    cat = stats.vector_catalog(stats.title_vectors(titles, "title_key", "genres"), dim, "title_key")
    rows = {r.title_key: r for r in cat.collect()}
    assert rows[2].episodes is None and all(round(x, 4) == x for x in rows[1].tone)


def test_jsonl_last_line_wins(spark, tmp):
    from playlake.operators import labels

    path = os.path.join(tmp, "pass1.jsonl")
    with open(path, "w") as f:
        f.write('{"media_id": 1, "title": "A", "mood_tags": ["dark"]}\n')
        f.write('{"media_id": 2, "title": "B", "mood_tags": ["cozy"]}\n')
        f.write("not json\n")
        f.write('{"media_id": 1, "title": "A", "mood_tags": ["hype", "absurd"]}\n')
    rows = files.read_jsonl(spark, path, GOLDEN_LABELS, with_seq=True)
    out = {r.media_id: r.mood_tags for r in labels.last_line_wins(rows, "media_id", "seq").collect()}
    assert out == {1: ["hype", "absurd"], 2: ["cozy"]}
