"""Silver, gold and bronze: dedupe, cleaning, retention mart, landing, upserts."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from playlake.operators import gold, silver
from playlake.schemas import BRONZE_PLAYBACK
from playlake.sources import bronze

PAGES = [
    {"data": {"Page": {"pageInfo": {"hasNextPage": True}, "media": [
        {"id": 501, "title": {"romaji": "Ranpu Dōri", "english": "Lantern Street"}, "genres": ["Mystery", "Music"],
         "tags": [{"name": "Fog", "rank": 71}], "description": "<p>A street <i>of lamps</i></p>",
         "averageScore": 64, "popularity": 1200, "episodes": 9, "season": "FALL", "seasonYear": 2011,
         "format": "ONA", "status": "FINISHED"},
        {"id": 502, "title": None, "genres": None, "description": None, "popularity": 800, "episodes": None},
    ]}}},
    {"data": {"Page": {"pageInfo": {"hasNextPage": False}, "media": [
        {"id": 502, "title": {"romaji": "Nine Tin Suns", "english": None}, "genres": [], "description": "Metal",
         "popularity": 801, "episodes": None},
    ]}}},
]


def _land(spark, tmp, pages, ts):
    src = os.path.join(tmp, f"pages-{ts[:10]}")
    os.makedirs(src, exist_ok=True)
    for i, p in enumerate(pages):
        with open(os.path.join(src, f"p{i}.json"), "w") as f:
            json.dump(p, f)
    flat = bronze.flatten_payloads(bronze.read_payloads(spark, src), ts)
    bronze.append_partitioned(flat, os.path.join(tmp, "bronze", "anilist_media"))
    return flat


def test_flatten_and_partitioned_append(spark, tmp):
    flat = _land(spark, tmp, PAGES, "2026-07-01T10:00:00Z")
    rows = {(r.media_id, r.title_romaji) : r for r in flat.collect()}
    assert len(rows) == 3
    missing = rows[(502, None)]
    assert missing.title_english is None and json.loads(missing.genres) == []
    assert json.loads(rows[(501, "Ranpu Dōri")].tags) == [{"name": "Fog", "rank": 71}]
    _land(spark, tmp, PAGES[1:], "2026-07-02T10:00:00Z")
    b = bronze.read(spark, os.path.join(tmp, "bronze"), "anilist_media")
    assert sorted(r.ingest_date.isoformat() for r in b.select("ingest_date").distinct().collect()) == [
        "2026-07-01", "2026-07-02"]
    pruned = bronze.read(spark, os.path.join(tmp, "bronze"), "anilist_media", since="2026-07-02")
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "ingest_date" in plan


def test_stg_media_latest_wins_and_dim_title(spark, tmp):
    _land(spark, tmp, PAGES, "2026-07-01T10:00:00Z")
    _land(spark, tmp, PAGES[1:], "2026-07-02T10:00:00Z")
    stg = silver.stg_media(bronze.read(spark, os.path.join(tmp, "bronze"), "anilist_media"))
    rows = {r.media_id: r for r in stg.collect()}
    assert set(rows) == {501, 502}
    assert rows[502].title == "Nine Tin Suns" and rows[502].genres == []
    assert rows[501].title == "Lantern Street" and rows[501].synopsis == "A street of lamps"
    dim = {r.title_key: r for r in gold.dim_title(stg).collect()}
    assert dim[501].primary_genre == "Mystery" and dim[502].primary_genre is None and dim[501].mood_tags is None
    enr = spark.createDataFrame([(501, ["dark"], "m", None)], gold.ENRICHMENT_COLUMNS)
    assert {r.title_key: r.mood_tags for r in gold.dim_title(stg, enr).collect()}[501] == ["dark"]


def test_latest_has_map_side_limit(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, 1, "d")], "k int, t int, v string")
    out = silver.latest(df, ["k"], [F.col("t").desc(), F.col("v").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "b"), (2, "d")]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def _events(spark, rows):
    return spark.createDataFrame(rows, BRONZE_PLAYBACK)


def _ev(uid, mid, ep, pct=0.5):
    return (f"{uid}-{mid}-{ep}", uid, mid, ep, "2026-04-01T00:00:00+00:00", pct, pct >= 0.9, 0, 900, "tv", "NA")


def test_stg_playback_drops_malformed(spark):
    rows = [_ev(1, 1, 1), _ev(None, 1, 1), _ev(2, None, 1), _ev(3, 1, 1, -0.1), _ev(4, 1, 1, 1.1),
            _ev(5, 1, 1, float("nan")), _ev(6, 1, 1, 1.0), _ev(7, 1, 1, 0.0)]
    rows.append(("x", 8, 1, 1, "2026-04-01T00:00:00+00:00", None, False, 0, 900, "tv", "NA"))
    stg = silver.stg_playback(_events(spark, rows))
    assert sorted(r.user_id for r in stg.collect()) == [1, 6, 7]
    fact = gold.fact_playback(stg).first()
    assert fact.watch_date == dt.date(2026, 4, 1) and fact.user_key is not None


def brute_dropoff(rows, min_viewers, strict=False):
    per = {}
    for uid, mid, ep in rows:
        if ep <= 2:
            per.setdefault(mid, {1: set(), 2: set()})[ep].add(uid)
    out = {}
    for mid, s in per.items():
        e1 = len(s[1])
        e2 = len(s[2] & s[1]) if strict else len(s[2])
        if e1 >= min_viewers:
            out[mid] = (e1, e2, round(e2 / e1, 4))
    return out


def test_episode_dropoff_matches_brute_force(spark):
    import random

    rng = random.Random(7)
    rows = []
    for uid in range(1, 400):
        for mid in rng.sample(range(1, 12), 3):
            for ep in range(1, rng.randint(1, 4) + 1):
                if not (ep == 1 and rng.random() < 0.05):  # some viewers skip episode 1
                    rows.append((uid, mid, ep))
    rows += rows[:50]  # repeat views
    fact = spark.createDataFrame(rows, "user_key long, title_key long, episode long")
    dim = spark.createDataFrame([(m, f"t{m}") for m in range(1, 12)], "title_key long, title string")
    for strict in (False, True):
        got = {r.title_key: (r.ep1_viewers, r.ep2_viewers, r.ep2_retention)
               for r in gold.episode_dropoff(fact, dim, min_viewers=20, strict_cohort=strict).collect()}
        assert got == brute_dropoff(rows, 20, strict)


def test_dim_user_tenure(spark):
    from playlake.schemas import BRONZE_USERS

    raw = spark.createDataFrame([(1, "2026-01-01", "tv", "NA", "Action")], BRONZE_USERS)
    out = gold.dim_user(silver.stg_users(raw), as_of="2026-03-01").first()
    assert out.user_key == 1 and out.tenure_days == 59


def test_upsert_is_idempotent_and_versioned(spark, tmp):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, v string, ver long")
    incoming = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1)], "k long, v string, ver long")
    order = [F.col("ver").desc()]
    once = bronze.upsert(target, incoming, ["k"], order)
    twice = bronze.upsert(once, incoming, ["k"], order)
    expect = [(1, "a"), (2, "b2"), (3, "c")]
    assert sorted((r.k, r.v) for r in once.collect()) == expect
    assert sorted((r.k, r.v) for r in twice.collect()) == expect
    base = os.path.join(tmp, "tbl")
    assert bronze.upsert_path(spark, base, target, ["k"], order) == 0
    assert bronze.upsert_path(spark, base, incoming, ["k"], order) == 1
    assert bronze.upsert_path(spark, base, incoming, ["k"], order) == 2
    assert sorted((r.k, r.v) for r in bronze.read_versioned(spark, base).collect()) == expect


def test_rows_without_a_user_are_no_viewers(spark):
    rows = [(u, 1, 1) for u in range(30)] + [(None, 1, 1), (None, 1, 2), (None, 2, 1)]
    fact = spark.createDataFrame(rows, "user_key long, title_key long, episode long")
    got = {r.title_key: (r.ep1_viewers, r.ep2_viewers) for r in gold.episode_viewers(fact).collect()}
    assert got == {1: (30, 0), 2: (0, 0)}


def test_catalog_table_keeps_properties_and_never_goes(spark):
    bronze.ensure_schema(spark, "bronze_p")
    table, order = "bronze_p.media", [F.col("ver").desc()]
    first = spark.createDataFrame([(1, "a", 1)], "k long, v string, ver long")
    bronze.upsert_table(spark, table, first, ["k"], order)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('owner_team' = 'catalog')")
    bronze.upsert_table(spark, table, spark.createDataFrame([(2, "b", 1)], "k long, v string, ver long"), ["k"], order)
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert props.get("owner_team") == "catalog" and spark.table(table).count() == 2
    broken = spark.createDataFrame([(3, "c", 1)], "k long, v string, ver long").withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    try:
        bronze.upsert_table(spark, table, broken, ["k"], order)
        raise AssertionError("the error must reach the caller")
    except Exception as e:  # noqa: BLE001
        assert "boom" in str(e)
    assert spark.table(table).count() == 2


def test_merge_errors_are_raised(spark, monkeypatch):
    bronze.ensure_schema(spark, "bronze_m")
    table = "bronze_m.media"
    rows = spark.createDataFrame([(1, "a", 1)], "k long, v string, ver long")
    bronze.upsert_table(spark, table, rows, ["k"], [F.col("ver").desc()])
    monkeypatch.setattr(bronze, "table_provider", lambda *_: "delta")
    try:
        bronze.upsert_table(spark, table, rows, ["k"], [F.col("ver").desc()])
        raise AssertionError("parquet has no MERGE")
    except Exception as e:  # noqa: BLE001
        assert "MERGE" in str(e).upper()
    assert spark.table(table).count() == 1


def test_catalog_table_upsert(spark):
    bronze.ensure_schema(spark, "bronze_t")
    table = "bronze_t.media"
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, ver long")
    bronze.upsert_table(spark, table, first, ["k"], [F.col("ver").desc()])
    second = spark.createDataFrame([(2, "b2", 2), (3, "c", 1)], "k long, v string, ver long")
    bronze.upsert_table(spark, table, second, ["k"], [F.col("ver").desc()])
    bronze.upsert_table(spark, table, second, ["k"], [F.col("ver").desc()])
    assert sorted((r.k, r.v) for r in spark.table(table).collect()) == [(1, "a"), (2, "b2"), (3, "c")]
    view = bronze.materialize(spark.table(table).filter("k > 1"), "stg_media_t")
    assert view.count() == 2
