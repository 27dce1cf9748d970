"""The media warehouse end to end on a small landed catalog and playback fixture."""

import os
import random

from pyspark.sql import functions as F

from playlake.operators import quality
from playlake.plans import warehouse
from playlake.schemas import BRONZE_PLAYBACK, BRONZE_USERS

from tests.test_marts import PAGES, _land

DEVICES, REGIONS = ["tv", "phone", "desk"], ["north", "south"]
GENRES = {501: ["Mystery", "Music"], 502: ["Mystery"], 503: ["Drama", "Psychological"]}


def _fixture(spark, tmp):
    pages = [{"data": {"Page": {"pageInfo": {"hasNextPage": False}, "media": [
        {"id": mid, "title": {"romaji": f"r{mid}", "english": f"Title {mid}"}, "genres": g,
         "description": f"<p>Synopsis of {mid}</p>", "popularity": 1000 * mid, "episodes": 12}
        for mid, g in GENRES.items()]}}}]
    _land(spark, tmp, pages, "2026-07-01T10:00:00Z")
    _land(spark, tmp, PAGES[1:], "2026-07-02T10:00:00Z")  # a later ingest of title 502 wins
    rng = random.Random(42)
    users, events = [], []
    for uid in range(1, 301):
        users.append((uid, "2026-01-01", rng.choice(DEVICES), rng.choice(REGIONS), "Action"))
        for mid in rng.sample(sorted(GENRES), 2):
            for ep in range(1, rng.randint(1, 4) + 1):
                pct = round(rng.random(), 4)
                events.append((f"{uid}-{mid}-{ep}", uid, mid, ep, "2026-04-01T10:00:00+00:00", pct, pct >= 0.9,
                               rng.randint(0, 3), rng.randint(120, 2000), "tv", "NA"))
    events.append(("bad", None, 1, 1, "2026-04-01T10:00:00+00:00", 0.5, False, 0, 200, "tv", "NA"))
    root = os.path.join(tmp, "bronze")
    spark.createDataFrame(users, BRONZE_USERS).write.parquet(os.path.join(root, "users"))
    spark.createDataFrame(events, BRONZE_PLAYBACK).write.parquet(os.path.join(root, "playback_events"))
    return root, events


def test_warehouse_end_to_end(spark, tmp):
    root, events = _fixture(spark, tmp)
    w = warehouse.build(spark, root, as_of="2026-07-01")
    titles = {r.title_key: r for r in w.dim_title.collect()}
    assert titles[502].title == "Nine Tin Suns" and titles[501].primary_genre == "Mystery"
    # brute-force retention from the landed events
    e1, e2 = {}, {}
    for _, uid, mid, ep, *_ in events:
        if uid is None:
            continue
        (e1 if ep == 1 else e2 if ep == 2 else {}).setdefault(mid, set()).add(uid)
    want = {mid: round(len(e2.get(mid, ())) / len(v), 4) for mid, v in e1.items() if len(v) >= 20}
    got = {r.title_key: r.ep2_retention for r in w.episode_dropoff.collect()}
    assert got == want
    tests = warehouse.column_tests(w).collect()
    assert len(tests) == 9 and all(t.passed for t in tests)
    assert w.dim_user.filter(F.col("tenure_days") != 181).count() == 0

    vecs = spark.createDataFrame([(u, [1.0, 0.0, 0.0, 0.0, 0.0]) for u in range(1, 301)],
                                 "user_key long, vector array<double>")
    doc = warehouse.report_document(w, vecs).first()
    assert doc.catalog_n == 3 and doc.users_n == 300 and doc.events_n == len(events) - 1
    assert len(doc.titles_sample) == 2 * len(want)
    assert {g.device for g in doc.device_qoe} <= set(DEVICES)
    assert (doc.checks_passed, doc.checks_total) == (9, 9)
    assert warehouse.report_document(w).first().variance_explained.tone_r2 is None


def test_warehouse_materialized(spark, tmp):
    root, _ = _fixture(spark, tmp)
    w = warehouse.build(spark, root, as_of="2026-07-01", materialize="wh_")
    assert spark.catalog.tableExists("wh_episode_dropoff")
    frozen = quality.freeze(w.episode_dropoff, ["title", "primary_genre", "ep1_viewers", "ep2_viewers",
                                                "ep2_retention"])
    assert frozen.count() == w.episode_dropoff.count()
