"""Registered queries over the driver tables, and their DuckDB oracles.

Each query applies a playlake operator to *analog* columns (SURVEY §7.4); the
operator's semantics are those of §2. Every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.functions import (
    clamp, composite_key, first_or_null, parse_string_array, py_round, strip_html, tag_display, to_json_list,
)
from playlake.functions.json import parse_tag_responses
from playlake.operators import enrich, evals, frozen, gold, ledger, observed, quality, report, runlog, silver, stats, viewers
from playlake.operators import labels as labelops
from playlake.operators.frames import side_by_side
from playlake.operators.partitioning import spread
from playlake.plans.tables import table
from playlake.schemas import CATALOG_PAGE, GATE_EVENT, TONES
from playlake.session import scratch_path
from playlake.sources import bronze, files
from playlake.streaming import run_state, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco


# ---------------------------------------------------------------------------
# Flagship: episode-2 retention. title = supplier, episode = line number,
# viewer = order.
# ---------------------------------------------------------------------------
def _lineitem_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("title_key"),
        F.col("l_linenumber").alias("episode"),
        F.col("l_orderkey").alias("user_key"),
    )


def _supplier_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("title_key"),
        F.col("s_name").alias("title"),
        F.col("s_nationkey").alias("primary_genre"),
    )


def dropoff(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return gold.episode_dropoff(_lineitem_fact(spark, sf_dir), _supplier_dim(spark, sf_dir), **kw)


_DROPOFF_SQL = """
WITH counts AS (
    SELECT l_suppkey AS title_key,
           count(DISTINCT l_orderkey) FILTER (WHERE l_linenumber = 1) AS ep1_viewers,
           count(DISTINCT l_orderkey) FILTER (WHERE l_linenumber = 2 {e2}) AS ep2_viewers
    FROM lineitem GROUP BY 1)
SELECT s_suppkey AS title_key, s_name AS title, s_nationkey AS primary_genre,
       ep1_viewers, ep2_viewers,
       round(CAST(ep2_viewers AS DOUBLE) / nullif(ep1_viewers, 0), 4) AS ep2_retention
FROM counts JOIN supplier ON title_key = s_suppkey
WHERE ep1_viewers >= 20
"""
DROPOFF_SQL = _DROPOFF_SQL.format(e2="")
STRICT_DROPOFF_SQL = _DROPOFF_SQL.format(
    e2="AND (l_suppkey, l_orderkey) IN (SELECT (l_suppkey, l_orderkey) FROM lineitem WHERE l_linenumber = 1)")


@register("episode_dropoff", DROPOFF_SQL)
def q_episode_dropoff(spark, sf_dir):
    """AGG-1,2,3 JON-2 FLT-3,4 CND-1,2."""
    return dropoff(spark, sf_dir)


# ---------------------------------------------------------------------------
# Silver / gold analogs
# ---------------------------------------------------------------------------


@register("latest_per_key", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""")
def q_latest_per_key(spark, sf_dir):
    """WIN-1: newest order per customer, order key as tie-break."""
    orders = table(spark, sf_dir, "orders")
    newest = silver.latest(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return newest.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
                         "o_totalprice", "o_orderstatus")


@register("strip_html", """
SELECT page_id, url, regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g') AS text FROM pages
""")
def q_strip_html(spark, sf_dir):
    """STRG-1 over whole pages."""
    return table(spark, sf_dir, "pages").select("page_id", "url", strip_html("html").alias("text"))


@register("json_array_first", """
WITH j AS (SELECT p_partkey, to_json(list_filter(string_split(p_name, ' '), lambda w: length(w) > 4)) AS g FROM part),
     p AS (SELECT p_partkey, from_json(g, '["VARCHAR"]') AS genres FROM j)
SELECT p_partkey, genres, genres[1] AS primary_genre, CAST(len(genres) AS BIGINT) AS n_genres FROM p
""")
def q_json_array_first(spark, sf_dir):
    """JSN-1 -> ARR-1 -> PRJ-4: words of the part name as a JSON genre list, parsed, first element."""
    part = table(spark, sf_dir, "part")
    words = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 4)
    genres = parse_string_array(to_json_list(words))
    return part.select("p_partkey", genres.alias("genres")).select(
        "p_partkey", "genres", first_or_null("genres").alias("primary_genre"),
        F.size("genres").cast("long").alias("n_genres"))


def _valid_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ok = silver.valid_playback(F.col("user_id"), F.col("event_id"), F.col("value") / F.lit(100.0))
    return ev.filter(ok)


@register("valid_events", """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date
FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND value / 100.0 BETWEEN 0 AND 1
""")
def q_valid_events(spark, sf_dir):
    """FLT-1 / DAT-1: malformed-row filter (value scaled to a [0, 1] share)."""
    return _valid_events(spark, sf_dir).select("event_id", "user_id", "event_type", "value",
                                               F.to_date("ts").alias("event_date"))


def _bronze_playback(spark, sf_dir) -> DataFrame:
    """The events as they would land: text times, shares, device names."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id")).alias("event_id"), "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("media_id"), F.lit(1).cast("long").alias("episode"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("started_at"),
        (F.col("value") / F.lit(100.0)).alias("watch_pct"), (F.col("value") >= 90).alias("completed"),
        F.col("event_id").alias("rebuffer_count"), F.floor("value").alias("startup_time_ms"),
        F.col("event_type").alias("device"), F.lit(None).cast("string").alias("region"))


_STG_PLAYBACK_SQL = """
    SELECT 'e' || event_id AS event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS media_id,
           CAST(1 AS BIGINT) AS episode, ts AS started_at, value / 100.0 AS watch_pct, value >= 90 AS completed,
           event_id AS rebuffer_count, CAST(floor(value) AS BIGINT) AS startup_time_ms, event_type AS device
    FROM events
    WHERE user_id IS NOT NULL AND json_extract(props, '$.k') IS NOT NULL AND value / 100.0 BETWEEN 0 AND 1"""


@register("stg_playback", f"""
SELECT event_id, user_id, media_id, epoch_us(started_at) AS started_us, watch_pct, completed, device FROM ({_STG_PLAYBACK_SQL})
""")
def q_stg_playback(spark, sf_dir):
    """DAT-1 / DAT-5 / FLT-1: landed events with text times, cleaned and typed by the silver operator."""
    stg = silver.stg_playback(_bronze_playback(spark, sf_dir))
    return stg.select("event_id", "user_id", "media_id", F.unix_micros("started_at").alias("started_us"), "watch_pct",
                      "completed", "device")


@register("fact_events", f"""
SELECT event_id, user_id AS user_key, media_id AS title_key, episode, CAST(started_at AS DATE) AS watch_date, watch_pct,
       completed, rebuffer_count, startup_time_ms, device FROM ({_STG_PLAYBACK_SQL})
""")
def q_fact_events(spark, sf_dir):
    """PRJ-1 / PRJ-2 / DAT-2: the fact projection over the cleaned events."""
    fact = gold.fact_playback(silver.stg_playback(_bronze_playback(spark, sf_dir)))
    return fact.drop("started_at", "region")


def label_tags(quality="quality", toxic="toxic"):
    """Golden analog tags from the labels table."""
    return F.array(F.when(F.col(quality) == 1, F.lit("hq")).otherwise(F.lit("lq")),
                   F.when(F.col(toxic) == 1, F.lit("toxic")).otherwise(F.lit("safe")))


_LABEL_TAGS_SQL = "[CASE WHEN quality = 1 THEN 'hq' ELSE 'lq' END, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'safe' END]"


def _doc_titles(spark, sf_dir) -> DataFrame:
    """Documents in the shape of the cleaned catalog."""
    null = F.lit(None)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("media_id"), F.concat_ws("/", "source", "lang").alias("title"), F.col("source").alias("title_romaji"),
        F.array("lang").alias("genres"), F.col("text").alias("synopsis"), null.cast("long").alias("average_score"),
        F.col("n_chars").alias("popularity"), null.cast("long").alias("episodes"), null.cast("string").alias("season"),
        null.cast("long").alias("season_year"), F.lit("text").alias("format"))


def _doc_enrichment(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("media_id"), label_tags().alias("mood_tags"), F.lit("labels").alias("enrichment_model"),
        F.lit(None).cast("timestamp").alias("enriched_at"))


@register("dim_title", f"""
SELECT d.doc_id AS title_key, concat_ws('/', d.source, d.lang) AS title, d.lang AS primary_genre, d.text AS synopsis,
       d.n_chars AS popularity, CASE WHEN l.doc_id IS NOT NULL THEN {_LABEL_TAGS_SQL} END AS mood_tags,
       CASE WHEN l.doc_id IS NOT NULL THEN 'labels' END AS enrichment_model
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_dim_title(spark, sf_dir):
    """JON-1 / PRJ-4 / PRJ-7: the title dimension over documents, with label-derived tags by a left join."""
    dim = gold.dim_title(_doc_titles(spark, sf_dir), _doc_enrichment(spark, sf_dir))
    return dim.select("title_key", "title", "primary_genre", "synopsis", "popularity", "mood_tags", "enrichment_model")


@register("dim_title_plain", """
SELECT doc_id AS title_key, concat_ws('/', source, lang) AS title, n_chars AS popularity,
       CAST(NULL AS VARCHAR[]) AS mood_tags FROM documents
""")
def q_dim_title_plain(spark, sf_dir):
    """PRJ-6: without enrichment the typed empty relation leaves NULL tags and no join."""
    return gold.dim_title(_doc_titles(spark, sf_dir)).select("title_key", "title", "popularity", "mood_tags")


AS_OF = "1999-01-01"


@register("dim_user", f"""
SELECT c_custkey AS user_key, f.signup_date, c_mktsegment AS primary_device, c_nationkey AS region,
       CAST(date_diff('day', f.signup_date, DATE '{AS_OF}') AS BIGINT) AS tenure_days
FROM customer LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS signup_date
                         FROM orders GROUP BY 1) f ON c_custkey = f.o_custkey
""")
def q_dim_user(spark, sf_dir):
    """DAT-3: users with first-order date and tenure to a fixed as-of date."""
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.min(F.to_date("o_orderdate")).alias("signup_date"))
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("primary_device"),
        F.col("c_nationkey").alias("region"), F.lit(None).cast("string").alias("favorite_genre"))
    stg = users.join(first, "user_id", "left")
    return gold.dim_user(stg, as_of=AS_OF).select("user_key", "signup_date", "primary_device", "region",
                                                 "tenure_days")


@register("upsert_latest", """
WITH newest AS (
    SELECT o_custkey AS key, o_totalprice AS balance, CAST(o_orderdate AS DATE) AS as_of, 'orders' AS source
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
          FROM orders) WHERE rn = 1)
SELECT * FROM newest
UNION ALL
SELECT c_custkey, c_acctbal, CAST(NULL AS DATE), 'customer' FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.key = c.c_custkey)
""")
def q_upsert_latest(spark, sf_dir):
    """SNK-3 / JON-8: customer balances upserted with each customer's newest order."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"),
        F.lit(None).cast("date").alias("as_of"), F.lit("customer").alias("source"))
    incoming = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("balance"),
        F.to_date("o_orderdate").alias("as_of"), F.lit("orders").alias("source"), "o_orderdate", "o_orderkey")
    return bronze.upsert(target, incoming, ["key"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


# ---------------------------------------------------------------------------
# Report aggregates over the flagship mart
# ---------------------------------------------------------------------------


@register("row_counts", """
SELECT (SELECT count(*) FROM supplier) AS catalog_n, (SELECT count(*) FROM orders) AS users_n,
       (SELECT count(*) FROM lineitem) AS events_n
""")
def q_row_counts(spark, sf_dir):
    """AGG-4: sizes of the title, viewer and event tables."""
    return report.row_counts(catalog_n=table(spark, sf_dir, "supplier"), users_n=table(spark, sf_dir, "orders"),
                             events_n=table(spark, sf_dir, "lineitem"))


@register("retention_hist", f"""
SELECT ep2_retention, count(*) AS n FROM ({DROPOFF_SQL}) GROUP BY 1
""")
def q_retention_hist(spark, sf_dir):
    """AGG-5: histogram of the retention ratio."""
    return report.value_histogram(dropoff(spark, sf_dir), "ep2_retention")


@register("genre_means", f"""
SELECT primary_genre, round_even(avg(ep2_retention), 4) AS mean_ep2_retention, count(*) AS n
FROM ({DROPOFF_SQL}) GROUP BY 1 HAVING count(*) >= 5
""")
def q_genre_means(spark, sf_dir):
    """AGG-6 / FLT-5: mean retention per group with at least 5 titles."""
    return report.group_means(dropoff(spark, sf_dir), "primary_genre", "ep2_retention", min_n=5)


@register("device_qoe", """
SELECT event_type AS device, round_even(avg(value), 2) AS rebuffers,
       CAST(round_even(avg(CAST(json_extract(props, '$.k') AS BIGINT)), 0) AS BIGINT) AS startup_ms,
       round_even(avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END), 3) AS completion
FROM events GROUP BY 1
""")
def q_device_qoe(spark, sf_dir):
    """AGG-7 / CND-3: per event type mean value, mean props.k, share with value >= 50."""
    ev = table(spark, sf_dir, "events")
    return report.device_qoe(ev, device="event_type", rebuffer=F.col("value"),
                             startup=F.get_json_object("props", "$.k").cast("long"),
                             completed=F.col("value") >= 50).withColumnRenamed("event_type", "device")


@register("retention_spread", f"""
SELECT round(max(ep2_retention) - min(ep2_retention), 4) AS spread, count(ep2_retention) AS n,
       round(max(ep2_retention) - min(ep2_retention), 4) > 0.02 AS planted_signal
FROM ({DROPOFF_SQL})
""")
def q_retention_spread(spark, sf_dir):
    """AGG-8: max - min retention and the planted-signal check."""
    return report.spread(dropoff(spark, sf_dir), "ep2_retention")


@register("top_bottom", f"""
WITH d AS ({DROPOFF_SQL})
SELECT * FROM (SELECT 'top' AS side, row_number() OVER (ORDER BY ep2_retention DESC NULLS LAST, title_key) AS rank,
                      title_key, title, primary_genre, ep2_retention, ep1_viewers FROM d
               ORDER BY ep2_retention DESC NULLS LAST, title_key LIMIT 15)
UNION ALL
SELECT * FROM (SELECT 'bottom', row_number() OVER (ORDER BY ep2_retention ASC NULLS LAST, title_key),
                      title_key, title, primary_genre, ep2_retention, ep1_viewers FROM d
               ORDER BY ep2_retention ASC NULLS LAST, title_key LIMIT 15)
""")
def q_top_bottom(spark, sf_dir):
    """SRT-2 / SET-1: top and bottom 15 titles by retention (bag union)."""
    d = dropoff(spark, sf_dir).select("title_key", "title", "primary_genre", "ep2_retention", "ep1_viewers")
    out = report.top_bottom(d, "ep2_retention", "title_key", 15)
    return out.select("side", F.col("rank").cast("long").alias("rank"), "title_key", "title", "primary_genre",
                      "ep2_retention", "ep1_viewers")


@register("top_popular", """
SELECT p_partkey, p_name, p_retailprice,
       row_number() OVER (ORDER BY p_retailprice DESC NULLS LAST, p_partkey) AS rank
FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 50
""")
def q_top_popular(spark, sf_dir):
    """SRT-3: labeling pool, top 50 by popularity analog."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    out = report.top_k(part, [F.col("p_retailprice").desc_nulls_last(), F.col("p_partkey").asc()], 50)
    return out.withColumn("rank", F.col("rank").cast("long"))


# ---------------------------------------------------------------------------
# Ordering and statistics
# ---------------------------------------------------------------------------

SHUFFLE_SEED = "pass2-shuffle"


@register("seeded_shuffle", f"""
SELECT c_custkey, c_name,
       row_number() OVER (ORDER BY sha256('{SHUFFLE_SEED}' || CAST(c_custkey AS VARCHAR)), c_custkey) AS position
FROM customer
""")
def q_seeded_shuffle(spark, sf_dir):
    """WIN-4 / STRG-6: seed-keyed shuffled position, computed without a one-task window."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return labelops.seeded_order(cust, "c_custkey", SHUFFLE_SEED)


@register("eta_squared", """
WITH x AS (SELECT label AS g, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
     gm AS (SELECT avg(v) AS m, count(*) AS n FROM x WHERE v IS NOT NULL),
     grp AS (SELECT g, count(*) AS n, avg(v) AS m FROM x WHERE v IS NOT NULL GROUP BY g),
     ss AS (SELECT (SELECT sum(grp.n * (grp.m - gm.m) * (grp.m - gm.m)) FROM grp, gm) AS ssb,
                   (SELECT sum((v - gm.m) * (v - gm.m)) FROM x, gm) AS sst)
SELECT (SELECT n FROM gm) AS n, (SELECT count(*) FROM grp) AS n_groups,
       round_even(CASE WHEN sst > 0 THEN ssb / sst ELSE 0.0 END, 3) AS eta_squared
FROM ss
""")
def q_eta_squared(spark, sf_dir):
    """STA-1: variance of all embedding components explained by the label."""
    emb = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x"))
    emb = emb.select("label", F.col("x").cast("double").alias("v"))
    return stats.eta_squared(emb, "label", "v")


@register("r_squared", """
WITH o AS (SELECT l_orderkey, sum(l_quantity) AS x, sum(l_extendedprice) AS y FROM lineitem GROUP BY 1)
SELECT count(*) AS n_pairs,
       round_even(CASE WHEN count(*) >= 3 AND var_pop(x) * var_pop(y) > 0
                  THEN covar_pop(x, y) * covar_pop(x, y) / (var_pop(x) * var_pop(y)) ELSE 0.0 END, 3) AS r_squared
FROM o WHERE x IS NOT NULL AND y IS NOT NULL
""")
def q_r_squared(spark, sf_dir):
    """STA-2: r^2 of per-order quantity against per-order price."""
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("x"), F.sum("l_extendedprice").alias("y"))
    return stats.r_squared(per_order, "x", "y")


# Analog nudges keyed by part type (the media model keys them by genre).
PART_TYPE_NUDGES = {
    "ECONOMY": ("cozy", 0.4),
    "LARGE": ("hype", 0.35),
    "MEDIUM": ("melancholy", 0.25),
    "PROMO": ("absurd", 0.3),
    "SMALL": ("dark", 0.35),
}


def _title_vector_sql() -> str:
    tones = TONES
    hexd = "'0123456789abcdef'"
    parts = []
    for i, tone in enumerate(tones):
        hi = f"(instr({hexd}, substr(h, {2 * i + 1}, 1)) - 1)"
        lo = f"(instr({hexd}, substr(h, {2 * i + 2}, 1)) - 1)"
        add = " + ".join(
            f"(CASE WHEN p_type = '{g}' THEN {w} ELSE 0.0 END)" for g, (t, w) in PART_TYPE_NUDGES.items() if t == tone
        ) or "0.0"
        parts.append(f"least(1.0, CAST({hi} * 16 + {lo} AS DOUBLE) / 255.0 + {add}) AS b{i}")
    norm = "sqrt(" + " + ".join(f"b{i} * b{i}" for i in range(5)) + ")"
    vec = ", ".join(f"round_even(b{i} / coalesce(nullif(nrm, 0.0), 1.0), 4) + 0.0" for i in range(5))
    return f"""
WITH h AS (SELECT p_partkey, p_type, sha256('tone:' || CAST(p_partkey AS VARCHAR)) AS h FROM part),
     b AS (SELECT p_partkey, {", ".join(parts)} FROM h),
     n AS (SELECT *, {norm} AS nrm FROM b)
SELECT p_partkey, [{vec}] AS tone FROM n
"""


@register("title_vectors", _title_vector_sql())
def q_title_vectors(spark, sf_dir):
    """STA-4 / ARR-5 / STA-5 rounding: hashed tone vectors nudged by part type."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.array("p_type").alias("genres"))
    vec = stats.title_vectors(part, "p_partkey", "genres", PART_TYPE_NUDGES)
    return vec.select("p_partkey", F.transform("tone", lambda x: F.bround(x, 4)).alias("tone"))


@register("vector_norm", """
WITH n AS (SELECT vec_id, label, embedding,
                  sqrt(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
                                   lambda a, b: a + b)) AS nrm FROM embeddings)
SELECT vec_id, label, round_even(nrm, 6) AS norm,
       list_transform(embedding, lambda x: round_even(CAST(x AS DOUBLE) / coalesce(nullif(nrm, 0.0), 1.0), 4) + 0.0) AS unit
FROM n
""")
def q_vector_norm(spark, sf_dir):
    """ARR-5: L2 norms and unit vectors of every embedding."""
    from playlake.functions.arrays import l2_norm, l2_normalize

    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding", l2_norm("embedding").alias("_n"))
    return emb.select(
        "vec_id", "label", F.bround("_n", 6).alias("norm"),
        F.transform(l2_normalize("embedding", "_n"), lambda x: F.bround(x, 4) + F.lit(0.0)).alias("unit"))


@register("vector_affinity", """
WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
     c_el AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
              FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM e) GROUP BY label, i),
     c AS (SELECT label, list(m ORDER BY i) AS v FROM c_el GROUP BY label),
     cu AS (SELECT label, list_transform(v, lambda x: x / coalesce(nullif(sqrt(list_sum(list_transform(v, lambda y: y * y))), 0.0), 1.0)) AS tv FROM c),
     uu AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) /
                 coalesce(nullif(sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))), 0.0), 1.0)) AS uv
            FROM e)
SELECT uu.label, round_even(avg(list_dot_product(uv, tv)), 4) AS mean_affinity, count(*) AS n_pairs
FROM uu JOIN cu ON uu.label = cu.label GROUP BY uu.label
""")
def q_vector_affinity(spark, sf_dir):
    """JON-10 / STA-3 / ARR-4: mean dot(unit vector, unit label centroid) per label."""
    emb = table(spark, sf_dir, "embeddings")
    cents = stats.unit_vectors(stats.centroids(emb, "label", "embedding"), "label", "embedding")
    out = stats.group_affinity(emb, cents, "label", "embedding")
    return out.select("label", F.bround("mean_affinity", 4).alias("mean_affinity"), "n_pairs")


# ---------------------------------------------------------------------------
# Enrichment, evaluation and labeling analogs. Golden tags come from
# `labels`; a rule over `documents` plays the classifier, whose raw response
# takes one of ten shapes (valid, padded, object, junk item, trailing text,
# mixed types, bare string, null, single quotes, empty list).
# ---------------------------------------------------------------------------

EVAL_VOCAB = ["hq", "lq", "toxic", "safe", "spam"]
_VOCAB_SQL = "['hq', 'lq', 'toxic', 'safe', 'spam']"
TOXIC_PATTERN = "(?i)(?:password|secret|api[_-]?key|token)"
RATES = (3e-6, 1.5e-5)


def _responses(spark, sf_dir) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text"))
    # the full-text regex runs once per document in its own projection
    flagged = docs.select(
        "doc_id", "lang", "n_chars",
        F.when(F.col("n_chars") >= 1000, F.lit("hq")).otherwise(F.lit("lq")).alias("q"),
        F.when(F.col("text").rlike(TOXIC_PATTERN), F.lit("toxic")).otherwise(F.lit("safe")).alias("t"))
    q, t = F.col("q"), F.col("t")
    shapes = [
        F.concat(F.lit('["'), q, F.lit('","'), t, F.lit('"]')),
        F.concat(F.lit(' ["'), q, F.lit('"]\n')),
        F.concat(F.lit('{"'), q, F.lit('": 1, "'), t, F.lit('": 2}')),
        F.concat(F.lit('["'), q, F.lit('", "'), t, F.lit('", "spam-ish"]')),
        F.concat(F.lit('["'), q, F.lit('"] trailing')),
        F.concat(F.lit('[1, "'), q, F.lit('", null, ["'), t, F.lit('"]]')),
        F.concat(F.lit('"'), q, F.lit('"')),
        F.lit("null"),
        F.concat(F.lit("['"), q, F.lit("']")),
        F.lit("[]"),
    ]
    which = F.pmod(F.col("doc_id"), F.lit(len(shapes)))
    raw = F.element_at(F.array(*shapes), (which + 1).cast("int"))
    with_raw = flagged.select("doc_id", "lang", "n_chars", raw.alias("raw_response"))
    parsed = parse_tag_responses(with_raw, "raw_response", EVAL_VOCAB)
    return parsed.select(
        F.col("doc_id").alias("media_id"), "lang", "raw_response", "mood_tags", "parse_ok",
        F.col("n_chars").alias("latency_ms"),
        F.floor(F.col("n_chars") / 4).cast("long").alias("input_tokens"),
        F.floor(F.length("raw_response") / 4).cast("long").alias("output_tokens"))


_RESPONSES_SQL = f"""
responses AS (
    SELECT doc_id, lang, n_chars,
           CASE doc_id % 10
             WHEN 0 THEN '["' || q || '","' || t || '"]'
             WHEN 1 THEN ' ["' || q || '"]' || chr(10)
             WHEN 2 THEN '{{"' || q || '": 1, "' || t || '": 2}}'
             WHEN 3 THEN '["' || q || '", "' || t || '", "spam-ish"]'
             WHEN 4 THEN '["' || q || '"] trailing'
             WHEN 5 THEN '[1, "' || q || '", null, ["' || t || '"]]'
             WHEN 6 THEN '"' || q || '"'
             WHEN 7 THEN 'null'
             WHEN 8 THEN '[''' || q || ''']'
             ELSE '[]' END AS raw_response
    FROM (SELECT doc_id, lang, n_chars,
                 CASE WHEN n_chars >= 1000 THEN 'hq' ELSE 'lq' END AS q,
                 CASE WHEN regexp_matches(text, '{TOXIC_PATTERN}') THEN 'toxic' ELSE 'safe' END AS t
          FROM documents)),
stripped AS (
    SELECT *, regexp_replace(raw_response, '^\\s+|\\s+$', '', 'g') AS r FROM responses),
typed AS (
    SELECT *, CASE WHEN json_valid(r) THEN json_type(r::JSON) END AS ty FROM stripped),
preds AS (
    SELECT doc_id AS media_id, lang, raw_response,
           CASE WHEN ty = 'ARRAY' THEN list_transform(
                     list_filter(CAST(r::JSON AS JSON[]),
                                 lambda e: json_type(e) = 'VARCHAR' AND list_contains({_VOCAB_SQL}, e ->> '$')),
                     lambda e: e ->> '$')
                WHEN ty = 'OBJECT' THEN list_filter(json_keys(r::JSON), lambda k: list_contains({_VOCAB_SQL}, k))
                ELSE CAST([] AS VARCHAR[]) END AS mood_tags,
           coalesce(ty IN ('ARRAY', 'OBJECT', 'VARCHAR'), false) AS parse_ok,
           n_chars AS latency_ms, CAST(floor(n_chars / 4) AS BIGINT) AS input_tokens,
           CAST(floor(length(raw_response) / 4) AS BIGINT) AS output_tokens
    FROM typed)"""

_GOLDEN_SQL = f"golden AS (SELECT doc_id AS media_id, {_LABEL_TAGS_SQL} AS mood_tags FROM labels)"

_SCORED_SQL = """
scored AS (
    SELECT g.media_id, list_distinct(g.mood_tags) AS want,
           list_distinct(coalesce(p.mood_tags, CAST([] AS VARCHAR[]))) AS got,
           p.raw_response, p.input_tokens, p.output_tokens
    FROM golden g JOIN preds p ON g.media_id = p.media_id)"""

_CONFUSION_SQL = f"""
items AS (
    SELECT unnest(list_filter(list_intersect(want, got), lambda x: list_contains({_VOCAB_SQL}, x))) AS tag, 0 AS kind FROM scored
    UNION ALL
    SELECT unnest(list_filter(got, lambda x: NOT list_contains(want, x) AND list_contains({_VOCAB_SQL}, x))), 1 FROM scored
    UNION ALL
    SELECT unnest(list_filter(want, lambda x: NOT list_contains(got, x) AND list_contains({_VOCAB_SQL}, x))), 2 FROM scored),
counts AS (
    SELECT tag, count(*) FILTER (WHERE kind = 0) AS tp, count(*) FILTER (WHERE kind = 1) AS fp,
           count(*) FILTER (WHERE kind = 2) AS fn FROM items GROUP BY tag),
confusion AS (
    SELECT v.tag, CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(fp, 0) AS BIGINT) AS fp,
           CAST(coalesce(fn, 0) AS BIGINT) AS fn
    FROM (VALUES ('hq'), ('lq'), ('toxic'), ('safe'), ('spam')) v(tag) LEFT JOIN counts c ON v.tag = c.tag),
prf AS (
    SELECT tag, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1
    FROM (SELECT tag, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                      CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM confusion))"""


def _golden(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("media_id"), label_tags().alias("mood_tags"))


def _scored(spark, sf_dir) -> DataFrame:
    return evals.score_join(_golden(spark, sf_dir), _responses(spark, sf_dir), "media_id")


@register("response_parse", f"WITH {_RESPONSES_SQL} SELECT media_id, raw_response, mood_tags, parse_ok FROM preds")
def q_response_parse(spark, sf_dir):
    """JSN-2 / ENR-3 / FLT-7: strict parse of every response and vocabulary filter."""
    return _responses(spark, sf_dir).select("media_id", "raw_response", "mood_tags", "parse_ok")


@register("tag_confusion", f"WITH {_RESPONSES_SQL}, {_GOLDEN_SQL}, {_SCORED_SQL}, {_CONFUSION_SQL} "
                           "SELECT tag, tp, fp, fn FROM confusion")
def q_tag_confusion(spark, sf_dir):
    """EVL-1 / JON-4: TP/FP/FN per vocabulary tag."""
    return evals.tag_confusion(_scored(spark, sf_dir), EVAL_VOCAB).select("tag", "tp", "fp", "fn")


@register("tag_prf", f"WITH {_RESPONSES_SQL}, {_GOLDEN_SQL}, {_SCORED_SQL}, {_CONFUSION_SQL} "
                     "SELECT tag, round_even(precision, 4) AS precision, round_even(recall, 4) AS recall, "
                     "round_even(f1, 4) AS f1 FROM prf")
def q_tag_prf(spark, sf_dir):
    """EVL-2: precision / recall / F1 per tag (0.0 on empty denominators)."""
    prf = evals.tag_prf(evals.tag_confusion(_scored(spark, sf_dir), EVAL_VOCAB))
    return prf.select("tag", *[py_round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


@register("eval_summary", f"""
WITH {_RESPONSES_SQL}, {_GOLDEN_SQL}, {_SCORED_SQL}, {_CONFUSION_SQL},
per AS (
    SELECT count(*) AS n_scored,
           avg(CASE WHEN len(list_distinct(list_concat(want, got))) = 0 THEN 1.0
                    ELSE len(list_intersect(want, got)) / len(list_distinct(list_concat(want, got))) END) AS jac,
           avg(CASE WHEN len(got) = 0 AND length(coalesce(raw_response, '')) > 0 THEN 1.0 ELSE 0.0 END) AS pf,
           sum(coalesce(input_tokens, 0) + coalesce(output_tokens, 0)) AS tok
    FROM scored),
macro AS (SELECT avg(f1) AS f1 FROM prf)
SELECT n_scored, (SELECT count(*) FROM golden) AS n_golden, round_even(macro.f1, 4) AS macro_f1,
       round_even(jac, 4) AS mean_jaccard, round_even(coalesce(pf, 0.0), 4) AS parse_fail_rate,
       CAST(coalesce(tok, 0) // greatest(n_scored, 1) AS BIGINT) AS tokens_per_title,
       (macro.f1 >= 0.6 AND coalesce(pf, 0.0) <= 0.05 AND n_scored > 0) AS passed
FROM per, macro
""")
def q_eval_summary(spark, sf_dir):
    """EVL-3..8: macro-F1, mean Jaccard, parse failures, tokens per title, gate."""
    golden = _golden(spark, sf_dir)
    # one row per golden title, read by both the per-title and the per-tag branch
    scored = _scored(spark, sf_dir).checkpoint(eager=True)
    prf = evals.tag_prf(evals.tag_confusion(scored, EVAL_VOCAB))
    return evals.eval_summary(golden, scored, prf)


@register("trace_health", f"""
WITH {_RESPONSES_SQL}
SELECT count(*) AS n,
       round_even(avg(CASE WHEN len(mood_tags) = 0 THEN 1.0 ELSE 0.0 END), 4) AS empty_tag_rate,
       round_even(quantile_cont(latency_ms, 0.95), 2) AS p95_latency_ms,
       CAST(sum(input_tokens + output_tokens) // greatest(count(*), 1) AS BIGINT) AS tokens_per_title,
       round_even(avg(input_tokens * {RATES[0]} + output_tokens * {RATES[1]}), 6) AS cost_per_title
FROM preds
""")
def q_trace_health(spark, sf_dir):
    """EVL-9 / EVL-10: empty-tag rate, exact p95 latency, tokens and cost per title.

    The predictions are stored once (as enrichment results are), since both
    the summary and the distributed percentile read them.
    """
    preds = _responses(spark, sf_dir).select("mood_tags", "latency_ms", "input_tokens", "output_tokens")
    return evals.trace_health(preds.checkpoint(eager=True), *RATES)


@register("enrich_candidates", """
SELECT doc_id AS media_id, substring(text, 1, 2000) AS prompt FROM documents WHERE length(text) > 40
""")
def q_enrich_candidates(spark, sf_dir):
    """ENR-1 / FLT-6 / STRG-2: texts longer than 40 characters and their prompts."""
    docs = table(spark, sf_dir, "documents")
    return enrich.candidates(docs, key="doc_id", text="text")


def _pass2(spark, sf_dir) -> DataFrame:
    # the second pass holds the titles whose reply could be read
    return _responses(spark, sf_dir).filter("parse_ok").select(
        "media_id", F.concat(F.lit("doc-"), F.col("media_id")).alias("title"), "mood_tags")


def _pass1(spark, sf_dir) -> DataFrame:
    return _golden(spark, sf_dir).select("media_id", F.concat(F.lit("doc-"), F.col("media_id")).alias("title"),
                                         "mood_tags")


_AGREEMENT_SQL = f"""
WITH {_RESPONSES_SQL}, {_GOLDEN_SQL},
p1 AS (SELECT media_id, 'doc-' || media_id AS title, mood_tags FROM golden),
p2 AS (SELECT media_id, 'doc-' || media_id AS title, mood_tags FROM preds WHERE parse_ok),
j AS (
    SELECT coalesce(p1.media_id, p2.media_id) AS media_id, coalesce(p1.title, p2.title, '') AS title,
           p1.mood_tags AS pass1_tags, p2.mood_tags AS pass2_tags,
           p1.media_id IS NOT NULL AS in_pass1, p2.media_id IS NOT NULL AS in_pass2,
           list_distinct(coalesce(p1.mood_tags, CAST([] AS VARCHAR[]))) AS a,
           list_distinct(coalesce(p2.mood_tags, CAST([] AS VARCHAR[]))) AS b
    FROM p1 FULL OUTER JOIN p2 ON p1.media_id = p2.media_id),
report AS (
    SELECT media_id, title, pass1_tags, pass2_tags, in_pass1, in_pass2,
           CASE WHEN in_pass1 AND in_pass2 THEN
                CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0
                     ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END END AS agreement
    FROM j)"""


@register("label_agreement", _AGREEMENT_SQL + """
SELECT media_id, title, pass1_tags, pass2_tags, round_even(agreement, 4) AS agreement,
       CASE WHEN agreement IS NULL THEN 'na' WHEN agreement >= 0.5 THEN 'high' ELSE 'low' END AS band,
       in_pass1, in_pass2
FROM report
""")
def q_label_agreement(spark, sf_dir):
    """JON-5 / EVL-11 / CND-4: two labeling passes, per-title agreement and band."""
    rep = labelops.agreement(_pass1(spark, sf_dir), _pass2(spark, sf_dir))
    return rep.select("media_id", "title", "pass1_tags", "pass2_tags", py_round("agreement", 4).alias("agreement"),
                      labelops.agreement_band(F.col("agreement")).alias("band"), "in_pass1", "in_pass2")


@register("agreement_summary", _AGREEMENT_SQL + """
SELECT count(*) AS total_titles, count(*) FILTER (WHERE in_pass1) AS pass1_count,
       count(*) FILTER (WHERE in_pass2) AS pass2_count, count(agreement) AS both_count,
       round_even(avg(agreement), 4) AS avg_agreement
FROM report
""")
def q_agreement_summary(spark, sf_dir):
    """EVL-12: agreement totals."""
    return labelops.agreement_summary(labelops.agreement(_pass1(spark, sf_dir), _pass2(spark, sf_dir)))


@register("label_validation", f"""
WITH t AS (
    SELECT l.doc_id AS media_id,
           list_sort(list_filter([CASE WHEN quality = 1 THEN 'hq' END, CASE WHEN toxic = 1 THEN 'toxic' END,
                                  CASE WHEN quality = 0 AND toxic = 1 THEN 'spam' END,
                                  CASE WHEN toxic = 1 THEN 'lq' END, CASE WHEN d.lang = 'de' THEN d.lang END],
                                 lambda x: x IS NOT NULL)) AS mood_tags
    FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id)
SELECT media_id, mood_tags, reason, reason IS NULL AS valid FROM (
    SELECT *, CASE WHEN media_id IS NULL OR media_id = 0 THEN 'missing_key'
                   WHEN mood_tags IS NULL OR len(mood_tags) NOT BETWEEN 1 AND 3 THEN 'tag_count'
                   WHEN NOT list_bool_and(list_transform(mood_tags, lambda x: list_contains({_VOCAB_SQL}, x)))
                        THEN 'unknown_tag' END AS reason
    FROM t)
""")
def q_label_validation(spark, sf_dir):
    """FLT-9 / ARR-3: label rows validated (id, 1-3 tags, vocabulary), tags sorted."""
    lab = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"),
                                              "doc_id", "left")
    tags = F.array_compact(F.array(
        F.when(F.col("quality") == 1, F.lit("hq")), F.when(F.col("toxic") == 1, F.lit("toxic")),
        F.when((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit("spam")),
        F.when(F.col("toxic") == 1, F.lit("lq")), F.when(F.col("lang") == "de", F.col("lang"))))
    rows = lab.select(F.col("doc_id").alias("media_id"), tags.alias("mood_tags"))
    return labelops.validate(rows, EVAL_VOCAB).select("media_id", "mood_tags", "reason", "valid")


# ---------------------------------------------------------------------------
# Event-log analogs. A gate-run log is derived from `events`: each user is a
# run, each event type a gate with its events as log lines (sequence =
# event id), gate boundaries from the first/last event, and the `error` gate
# failing.
# ---------------------------------------------------------------------------


def _ndjson_lines(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    record = F.to_json(F.struct(F.col("event_type").alias("event"),
                                F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
                                F.col("event_id").alias("seq"), F.col("props").alias("line")))
    line = (F.when(F.col("event_type") == "error", F.concat(F.lit("ERROR event "), F.col("event_id")))
            .when(F.col("value") < 1, F.lit("")).otherwise(record))
    return ev.select(F.col("event_id").alias("offset"), line.alias("value"))


NDJSON_SCHEMA = "event string, run_id string, seq long, line string"


@register("ndjson_filter", """
SELECT event_id AS seq, event_type AS event, 'run-' || user_id AS run_id, props AS line
FROM events WHERE event_type <> 'error' AND value >= 1
""")
def q_ndjson_filter(spark, sf_dir):
    """STR-1: only lines that are exactly one JSON value pass; blank and noise lines dropped."""
    parsed = runlog.parse_lines(_ndjson_lines(spark, sf_dir), schema=NDJSON_SCHEMA)
    return parsed.select("seq", "event", "run_id", "line")


@register("ndjson_rejected", """
SELECT event_id AS offset, 'ERROR event ' || event_id AS line, 'not_one_json_value' AS reason
FROM events WHERE event_type = 'error'
""")
def q_ndjson_rejected(spark, sf_dir):
    """STR-1 side output: lines that are not one JSON value, whole, with the reason."""
    return runlog.rejected_lines(_ndjson_lines(spark, sf_dir), keep=["offset"])


@register("ndjson_odd_values", """
SELECT event_id AS offset, '{"event":"' || event_type || '","seq":1,"x":NaN,"seq":' || event_id || '}' AS raw_line,
       event_type AS event, event_id AS seq
FROM events
""")
def q_ndjson_odd_values(spark, sf_dir):
    """STR-1: NaN and repeated keys are valid lines (the last key wins), and the line is kept as it came."""
    line = F.concat(F.lit('{"event":"'), F.col("event_type"), F.lit('","seq":1,"x":NaN,"seq":'), F.col("event_id"), F.lit("}"))
    lines = table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), line.alias("value"))
    return runlog.parse_lines(lines, keep=["offset"], schema="event string, seq long", raw="raw_line")


def _mixed_lines(spark, sf_dir) -> DataFrame:
    """Lines of eight shapes by event, on which lenient and strict readers of JSON differ."""
    n = F.col("event_id")
    long = F.repeat(F.lit("7"), 1500)
    shapes = [
        F.concat(F.lit('{"event":"a","seq":'), n, F.lit(',"x":NaN}')),
        F.concat(F.lit('{"event":"b","seq":0,"seq":'), n, F.lit("}")),
        F.concat(F.lit('{"event":"c","seq":'), n, F.lit(',"x":'), long, F.lit("}")),
        F.concat(F.lit('{"event":"d+INF","seq":'), n, F.lit(',"x":-Infinity,"y":1e+5}')),
        F.concat(F.lit('{"event":"e","seq":'), n, F.lit(',"x":+INF}')),
        F.concat(F.lit('{"event":"f","seq":'), n, F.lit("} {}")),
        F.concat(F.lit("{'event':'g','seq':"), n, F.lit("}")),
        F.lit(" \t "),
    ]
    line = F.element_at(F.array(*shapes), (F.pmod(n, F.lit(len(shapes))) + 1).cast("int"))
    return table(spark, sf_dir, "events").select(n.alias("offset"), line.alias("value"))


@register("ndjson_split", """
SELECT event_id AS offset, CASE WHEN event_id % 8 < 4 THEN ['a', 'b', 'c', 'd+INF'][event_id % 8 + 1] END AS event,
       CASE WHEN event_id % 8 < 4 THEN event_id END AS seq,
       CASE WHEN event_id % 8 >= 4 THEN 'not_one_json_value' END AS reason
FROM events WHERE event_id % 8 <> 7
""")
def q_ndjson_split(spark, sf_dir):
    """STR-1: accepted and rejected lines of one parse; NaN, repeated keys and long numbers pass, +INF does not."""
    lines = runlog.classified_lines(_mixed_lines(spark, sf_dir))
    good = runlog.accepted(lines, keep=["offset"], schema="event string, seq long").withColumn("reason", F.lit(None).cast("string"))
    bad = runlog.rejected(lines, keep=["offset"])
    return good.unionByName(bad.select("offset", F.lit(None).cast("string").alias("event"), F.lit(None).cast("long").alias("seq"), "reason"))


def _gate_events(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"), F.col("event_type").alias("gate"), "ts",
        F.col("event_id").alias("eid"))
    cols = [f.name for f in GATE_EVENT.fields] + ["seq"]

    def shape(df, **exprs):
        # one SQL projection per branch; unspecified event fields are typed NULLs
        sql = [f"CAST({exprs.get(f.name, f.name if f.name in df.columns else 'NULL')} AS {f.dataType.simpleString()}) "
               f"AS {f.name}" for f in GATE_EVENT.fields]
        return df.selectExpr(*sql, f"CAST({exprs['seq']} AS BIGINT) AS seq")

    logs = shape(ev, event="'log'", line="concat(gate, ' #', eid)", seq="eid * 4 + 1")
    # one rollup gives the bounds of gates and, where gate is NULL, of runs; each row is two events
    bounds = ev.rollup("run_id", "gate").agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min("eid").alias("e0"), F.max("eid").alias("e1"),
    ).filter("run_id IS NOT NULL")
    ends = bounds.selectExpr(
        "run_id", "gate", "CASE WHEN gate = 'error' THEN 'fail' WHEN gate IS NOT NULL THEN 'pass' END AS result",
        "CASE WHEN gate IS NULL THEN 'run' ELSE 'gate' END AS kind",
        "explode(array(struct('_start' AS part, t0 AS at, e0 * 4 - IF(gate IS NULL, 1, 0) AS s),"
        " struct('_end' AS part, t1 AS at, e1 * 4 + IF(gate IS NULL, 3, 2) AS s))) AS x")
    marks = shape(ends, event="concat(kind, x.part)", status="IF(x.part = '_end', result, NULL)", ts="x.at", seq="x.s")
    return logs.unionByName(marks).select(*cols)


_GATES_SQL = """
g AS (
    SELECT 'run-' || user_id AS run_id, event_type AS gate, min(event_id) AS e0,
           CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END AS status,
           floor((date_diff('microsecond', min(ts), max(ts)) + 5000) / 10000) / 100.0 AS duration_s,
           count(*) AS n_lines
    FROM events GROUP BY user_id, event_type),
t AS (
    SELECT 'run-' || user_id AS run_id, event_type AS gate, list(event_type || ' #' || event_id ORDER BY event_id) AS tail
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn <= 50 GROUP BY user_id, event_type)"""


@register("gate_rollup", f"""
WITH {_GATES_SQL}
SELECT g.run_id, g.gate, status, duration_s, tail, n_lines FROM g JOIN t ON g.run_id = t.run_id AND g.gate = t.gate
""")
def q_gate_rollup(spark, sf_dir):
    """STR-4 / STR-6 / WIN-3: per-gate status, duration and last 50 log lines."""
    gates = runlog.gate_rollup(_gate_events(spark, sf_dir))
    return gates.select("run_id", "gate", "status", "duration_s", "tail", "n_lines")


_TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@register("run_rollup", f"""
WITH {_GATES_SQL},
r AS (SELECT 'run-' || user_id AS run_id, min(ts) AS t0, max(ts) AS t1 FROM events GROUP BY user_id)
SELECT r.run_id, strftime(t0, '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(t1, '%Y-%m-%d %H:%M:%S.%f') AS finished_at,
       CASE WHEN bool_or(status = 'fail') THEN 'fail' ELSE 'pass' END AS status,
       list(gate ORDER BY e0) AS gate_names, count(*) AS n_gates
FROM r JOIN g ON r.run_id = g.run_id GROUP BY r.run_id, t0, t1
""")
def q_run_rollup(spark, sf_dir):
    """STR-4 / STR-5: one record per run; any failed gate fails the run."""
    events = _gate_events(spark, sf_dir)
    runs = runlog.run_rollup(events, runlog.gate_rollup(events))
    return runs.select("run_id", F.date_format("started_at", _TS_FMT).alias("started_at"),
                       F.date_format("finished_at", _TS_FMT).alias("finished_at"), "status",
                       F.transform("gates", lambda g: g["gate"]).alias("gate_names"),
                       F.size("gates").cast("long").alias("n_gates"))


@register("run_totals", f"""
WITH {_GATES_SQL}
SELECT run_id, round(sum(coalesce(duration_s, 0.0)), 2) AS total_duration_s FROM g GROUP BY run_id
""")
def q_run_totals(spark, sf_dir):
    """STR-7: run total = sum of gate durations."""
    events = _gate_events(spark, sf_dir)
    return runlog.run_totals(runlog.gate_rollup(events, tail_lines=0))


@register("event_order", """
SELECT conv_id, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role, count(*) AS n,
       arg_min(role, turn) IN ('system', 'user') AS starts_ok, arg_max(role, turn) = 'assistant' AS ends_ok
FROM conversations GROUP BY conv_id
""")
def q_event_order(spark, sf_dir):
    """STR-8: stream integrity per conversation (first speaker, last speaker)."""
    conv = table(spark, sf_dir, "conversations")
    fl = runlog.first_last(conv, ["conv_id"], "turn", "role")
    return fl.select("conv_id", "first_role", "last_role", "n",
                     F.col("first_role").isin("system", "user").alias("starts_ok"),
                     (F.col("last_role") == "assistant").alias("ends_ok"))


@register("log_tail", """
SELECT conv_id, list(text ORDER BY turn) AS tail
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations)
WHERE rn <= 2 GROUP BY conv_id
""")
def q_log_tail(spark, sf_dir):
    """WIN-3: last two turns of every conversation, in order."""
    return runlog.log_tail(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", 2)


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------


@register("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
""")
def q_dq_unique(spark, sf_dir):
    """DQ-1: duplicated (order, line) pairs."""
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("ri_orphans", """
SELECT doc_id, lang FROM documents d
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def q_ri_orphans(spark, sf_dir):
    """DQ-3 / JON-6: documents with no label row (relationships test, left anti join)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return quality.orphans(docs, table(spark, sf_dir, "labels"), "doc_id", "doc_id")


def _suite(spark, sf_dir):
    sup, cust = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    ev, li = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    C = quality.Check
    return [
        C("unique", "dim_title", "s_suppkey", sup),
        C("not_null", "dim_title", "s_suppkey", sup),
        C("unique", "dim_user", "c_custkey", cust),
        C("not_null", "dim_user", "c_custkey", cust),
        C("unique", "fact_playback", "event_id", ev),
        C("not_null", "fact_playback", "event_id", ev),
        C("relationships", "fact_playback", "user_id", ev, cust, "c_custkey"),
        C("relationships", "fact_playback", "l_suppkey", li, sup, "s_suppkey"),
        C("not_null", "episode_dropoff", "ep2_retention", dropoff(spark, sf_dir)),
    ]


@register("dq_suite", f"""
SELECT test_order, test, model, column_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
  SELECT 0 AS test_order, 'unique' AS test, 'dim_title' AS model, 's_suppkey' AS column_name,
         (SELECT count(*) FROM (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 1, 'not_null', 'dim_title', 's_suppkey', (SELECT count(*) FROM supplier WHERE s_suppkey IS NULL)
  UNION ALL SELECT 2, 'unique', 'dim_user', 'c_custkey',
         (SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 3, 'not_null', 'dim_user', 'c_custkey', (SELECT count(*) FROM customer WHERE c_custkey IS NULL)
  UNION ALL SELECT 4, 'unique', 'fact_playback', 'event_id',
         (SELECT count(*) FROM (SELECT event_id FROM events WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 5, 'not_null', 'fact_playback', 'event_id', (SELECT count(*) FROM events WHERE event_id IS NULL)
  UNION ALL SELECT 6, 'relationships', 'fact_playback', 'user_id',
         (SELECT count(*) FROM events e WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id))
  UNION ALL SELECT 7, 'relationships', 'fact_playback', 'l_suppkey',
         (SELECT count(*) FROM lineitem l WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey))
  UNION ALL SELECT 8, 'not_null', 'episode_dropoff', 'ep2_retention',
         (SELECT count(*) FROM ({DROPOFF_SQL}) WHERE ep2_retention IS NULL)
) s
""")
def q_dq_suite(spark, sf_dir):
    """DQ-2 / DQ-4: nine column tests in one result table."""
    return quality.run_suite(_suite(spark, sf_dir))


_FROZEN = """SELECT CAST(title_key AS VARCHAR) AS title_key, title, CAST(primary_genre AS VARCHAR) AS primary_genre,
       CAST(ep1_viewers AS VARCHAR) AS ep1_viewers, CAST(ep2_viewers AS VARCHAR) AS ep2_viewers,
       coalesce(printf('%.4f', ep2_retention), '') AS ep2_retention FROM ({sql})"""


@register("golden_drift", f"""
WITH e AS ({_FROZEN.format(sql=DROPOFF_SQL)}), a AS ({_FROZEN.format(sql=STRICT_DROPOFF_SQL)})
SELECT *, 'missing' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM a)
UNION ALL
SELECT *, 'unexpected' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e)
""")
def q_golden_drift(spark, sf_dir):
    """SNK-6 / SET-4 / DQ-5: frozen mart against a changed model (strict cohort), both directions."""
    cols = ["title_key", "title", "primary_genre", "ep1_viewers", "ep2_viewers", "ep2_retention"]
    expected = quality.freeze(dropoff(spark, sf_dir), cols)
    actual = quality.freeze(dropoff(spark, sf_dir, strict_cohort=True), cols)
    return quality.drift(expected, actual)


_PRINTED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


def _fingerprint_sql(name: str) -> str:
    text = " || chr(10) || ".join(f"coalesce('{c}=' || CAST({c} AS VARCHAR), '{c}!')" for c in _PRINTED[name])
    return (f"SELECT '{name}' AS table_name, count(*) AS n_rows, "
            f"CAST(sum(CAST(CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS fingerprint FROM {name}")


@register("fingerprint", " UNION ALL ".join(_fingerprint_sql(t) for t in _PRINTED))
def q_fingerprint(spark, sf_dir):
    """DQ-6: order-insensitive fingerprints of whole tables."""
    parts = [quality.fingerprint(table(spark, sf_dir, t).select(*_PRINTED[t]), t) for t in _PRINTED]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_REPORT_SQL = """
SELECT (SELECT count(*) FROM supplier) AS catalog_n, (SELECT count(*) FROM orders) AS users_n,
       (SELECT count(*) FROM lineitem) AS events_n,
       coalesce((SELECT list(printf('%.4f %d', v, n) ORDER BY v) FROM ({hist}) h(v, n)), CAST([] AS VARCHAR[])) AS retention_hist,
       coalesce((SELECT list(printf('%d %.4f %d', g, m, n) ORDER BY m DESC, g) FROM ({means}) x(g, m, n)), CAST([] AS VARCHAR[])) AS genre_means,
       coalesce((SELECT list(printf('%s %.2f %d %.3f', d, r, s, c) ORDER BY d) FROM ({qoe}) q(d, r, s, c)), CAST([] AS VARCHAR[])) AS device_qoe,
       coalesce((SELECT list(printf('%s %d %d', side, rank, title_key) ORDER BY side DESC, rank) FROM ({sample})), CAST([] AS VARCHAR[])) AS titles_sample,
       (SELECT eta_squared FROM ({eta})) AS genre_eta2, (SELECT r_squared FROM ({tone})) AS tone_r2,
       (SELECT count(*) FILTER (WHERE passed) FROM ({suite})) AS checks_passed, (SELECT count(*) FROM ({suite})) AS checks_total
"""


def _report(spark, sf_dir) -> DataFrame:
    """The nested document; the mart (one row per title) is stored once for the five aggregates that read it."""
    mart = scratch_path(spark, f"mart-{uuid.uuid4().hex}")
    dropoff(spark, sf_dir).write.parquet(mart)
    d = spark.read.parquet(mart)
    eta = stats.eta_squared(d, "primary_genre", "ep2_retention").select(F.col("eta_squared").alias("genre_eta2"))
    tone = stats.affinity_retention_r2(_title_affinity(spark, sf_dir), d, "title_key").select(F.col("r_squared").alias("tone_r2"))
    sample = report.top_bottom(d.select("title_key", "title", "primary_genre", "ep2_retention", "ep1_viewers"),
                               "ep2_retention", "title_key", 15)
    return report.report_document(
        q_row_counts(spark, sf_dir), report.value_histogram(d, "ep2_retention"),
        report.group_means(d, "primary_genre", "ep2_retention", min_n=5), side_by_side(eta, tone),
        q_device_qoe(spark, sf_dir), sample, suite=quality.run_suite(_suite(spark, sf_dir)))


def q_report_document(spark, sf_dir):
    """SNK-7: the nested report, its lists written as text in the order they have in the document."""
    def lines(column: str, form: str, *fields: str):
        return F.transform(column, lambda r: F.format_string(form, *[r[f] for f in fields])).alias(column)

    return _report(spark, sf_dir).select(
        "catalog_n", "users_n", "events_n",
        lines("retention_hist", "%.4f %d", "ep2_retention", "n"),
        lines("genre_means", "%d %.4f %d", "primary_genre", "mean_ep2_retention", "n"),
        lines("device_qoe", "%s %.2f %d %.3f", "device", "rebuffers", "startup_ms", "completion"),
        lines("titles_sample", "%s %d %d", "side", "rank", "title_key"),
        F.col("variance_explained.genre_eta2").alias("genre_eta2"), F.col("variance_explained.tone_r2").alias("tone_r2"),
        F.col("checks_passed").cast("long").alias("checks_passed"), F.col("checks_total").cast("long").alias("checks_total"))


# ---------------------------------------------------------------------------
# Vector affinity at scale (STA-3 / JON-10 / JON-7): viewers (orders) and
# titles (suppliers) get hashed unit tone vectors; watched pairs are the
# distinct (order, supplier) pairs of lineitem.
# ---------------------------------------------------------------------------
def _title_affinity(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pairs = li.select(F.col("l_orderkey").alias("user_key"), F.col("l_suppkey").alias("title_key")).distinct()
    users = stats.title_vectors(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("user_key"),
                                                                      F.lit(None).cast("array<string>").alias("g")),
                                "user_key", "g", nudges={}, prefix="pref:").withColumnRenamed("tone", "vector")
    titles = stats.title_vectors(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("title_key"),
                                                                        F.lit(None).cast("array<string>").alias("g")),
                                 "title_key", "g", nudges={}).withColumnRenamed("tone", "vector")
    return stats.mean_affinity(pairs, users, titles, "user_key", "title_key", len(TONES))


def _unit_vector_sql(table_name: str, key: str, prefix: str) -> str:
    hexd = "'0123456789abcdef'"
    comps = []
    for i in range(5):
        hi = f"(instr({hexd}, substr(h, {2 * i + 1}, 1)) - 1)"
        lo = f"(instr({hexd}, substr(h, {2 * i + 2}, 1)) - 1)"
        comps.append(f"least(1.0, CAST({hi} * 16 + {lo} AS DOUBLE) / 255.0 + 0.0) AS b{i}")
    norm = "sqrt(" + " + ".join(f"b{i} * b{i}" for i in range(5)) + ")"
    vec = ", ".join(f"b{i} / coalesce(nullif(nrm, 0.0), 1.0) AS v{i}" for i in range(5))
    return f"""(SELECT k, {vec} FROM (SELECT *, {norm} AS nrm FROM (
        SELECT k, {", ".join(comps)} FROM (SELECT {key} AS k, sha256('{prefix}' || CAST({key} AS VARCHAR)) AS h
                                            FROM {table_name}))))"""


_AFFINITY_SQL = f"""
pairs AS (SELECT DISTINCT l_orderkey AS user_key, l_suppkey AS title_key FROM lineitem),
u AS {_unit_vector_sql("orders", "o_orderkey", "pref:")},
t AS {_unit_vector_sql("supplier", "s_suppkey", "tone:")},
aff AS (
    SELECT p.title_key,
           avg(0.0 + u.v0 * t.v0 + u.v1 * t.v1 + u.v2 * t.v2 + u.v3 * t.v3 + u.v4 * t.v4) AS mean_affinity,
           count(*) AS n_pairs
    FROM pairs p JOIN u ON p.user_key = u.k JOIN t ON p.title_key = t.k GROUP BY p.title_key)"""


@register("title_affinity", f"""
WITH {_AFFINITY_SQL}
SELECT title_key, round_even(mean_affinity, 4) AS mean_affinity, n_pairs FROM aff
""")
def q_title_affinity(spark, sf_dir):
    """STA-3 / JON-10 / ARR-4: mean viewer-title tone affinity over watched pairs."""
    aff = _title_affinity(spark, sf_dir)
    return aff.select("title_key", F.bround("mean_affinity", 4).alias("mean_affinity"), "n_pairs")


@register("tone_r2", f"""
WITH {_AFFINITY_SQL}, d AS ({DROPOFF_SQL}), j AS (SELECT mean_affinity AS x, ep2_retention AS y FROM aff JOIN d USING (title_key))
SELECT count(*) AS n_pairs,
       round_even(CASE WHEN count(*) >= 3 AND var_pop(x) * var_pop(y) > 0
                  THEN covar_pop(x, y) * covar_pop(x, y) / (var_pop(x) * var_pop(y)) ELSE 0.0 END, 3) AS r_squared
FROM j
""")
def q_tone_r2(spark, sf_dir):
    """JON-7 / STA-2: r^2 of mean title affinity against episode-2 retention."""
    return stats.affinity_retention_r2(_title_affinity(spark, sf_dir), dropoff(spark, sf_dir), "title_key")


_MART_ETA_SQL = f"""
WITH d AS ({DROPOFF_SQL}), gm AS (SELECT avg(ep2_retention) AS m FROM d),
     grp AS (SELECT primary_genre, count(*) AS n, avg(ep2_retention) AS m FROM d GROUP BY 1),
     ss AS (SELECT (SELECT sum(n * (grp.m - gm.m) * (grp.m - gm.m)) FROM grp, gm) AS ssb,
                   (SELECT sum((ep2_retention - gm.m) * (ep2_retention - gm.m)) FROM d, gm) AS sst)
SELECT round_even(CASE WHEN sst > 0 THEN ssb / sst ELSE 0.0 END, 3) AS eta_squared FROM ss"""

register("report_document", _REPORT_SQL.format(
    hist=ORACLE["retention_hist"], means=ORACLE["genre_means"], qoe=ORACLE["device_qoe"], sample=ORACLE["top_bottom"],
    eta=_MART_ETA_SQL, tone=ORACLE["tone_r2"], suite=ORACLE["dq_suite"]))(q_report_document)


# ---------------------------------------------------------------------------
# Keys that repeat: the last line of a key wins (WIN-2, JON-4, JON-5, SNK-8).
# Golden rows are a customer's orders by key, predictions the same by date.
# ---------------------------------------------------------------------------
def _order_tags(spark, sf_dir, tags, seq) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("media_id"), F.concat(F.lit("c"), F.col("o_custkey")).alias("title"),
        F.array(tags).alias("mood_tags"), F.col("o_orderpriority").alias("raw_response"),
        F.floor(F.col("o_totalprice")).alias("input_tokens"), F.lit(1).cast("long").alias("output_tokens"), seq.alias("seq"))


def _status_rows(spark, sf_dir):
    return _order_tags(spark, sf_dir, F.col("o_orderstatus"), F.col("o_orderkey"))


def _price_rows(spark, sf_dir):
    tag = F.when(F.col("o_totalprice") >= 150000, "F").when(F.col("o_totalprice") >= 75000, "O").otherwise("P")
    return _order_tags(spark, sf_dir, tag, F.struct("o_orderdate", "o_orderkey"))


_LAST_SQL = """
g AS (SELECT o_custkey AS k, o_orderstatus AS tag FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
p AS (SELECT o_custkey AS k, CASE WHEN o_totalprice >= 150000 THEN 'F' WHEN o_totalprice >= 75000 THEN 'O' ELSE 'P' END AS tag
      FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


@register("eval_last_wins", f"WITH {_LAST_SQL} SELECT k AS media_id, [g.tag] AS want, [p.tag] AS got FROM g JOIN p USING (k)")
def q_eval_last_wins(spark, sf_dir):
    """JON-4 / WIN-2: golden and predictions with repeated keys, one scored row per key."""
    return evals.score_join(_status_rows(spark, sf_dir), _price_rows(spark, sf_dir), seq="seq").select("media_id", "want", "got")


@register("agreement_last_wins", f"""
WITH {_LAST_SQL}
SELECT k AS media_id, [g.tag] AS pass1_tags, [p.tag] AS pass2_tags, CASE WHEN g.tag = p.tag THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS agreement
FROM g JOIN p USING (k)
""")
def q_agreement_last_wins(spark, sf_dir):
    """JON-5 / WIN-2: two passes with repeated keys."""
    rep = labelops.agreement(_status_rows(spark, sf_dir), _price_rows(spark, sf_dir), seq="seq")
    return rep.select("media_id", "pass1_tags", "pass2_tags", "agreement")


@register("label_upsert", """
WITH incoming AS (SELECT o_custkey AS media_id, [o_orderstatus] AS mood_tags FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT media_id, mood_tags FROM incoming
UNION ALL SELECT c_custkey, [c_mktsegment] FROM customer WHERE c_custkey NOT IN (SELECT media_id FROM incoming)
""")
def q_label_upsert(spark, sf_dir):
    """SNK-8: the newest label of a key replaces the stored one."""
    stored = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("media_id"), F.array("c_mktsegment").alias("mood_tags"), F.lit(0).cast("long").alias("seq"))
    return labelops.upsert_labels(stored, _status_rows(spark, sf_dir).select("media_id", "mood_tags", "seq")).select("media_id", "mood_tags")


# ---------------------------------------------------------------------------
# Landing, catalog and checks over the given tables
# ---------------------------------------------------------------------------
def _payload_pages(spark, sf_dir) -> DataFrame:
    """Parts as catalog documents: JSON text, then the declared page schema, as files would be read."""
    item = F.struct(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") > 10, F.struct(F.col("p_name").alias("romaji"), F.col("p_brand").alias("english"))).alias("title"),
        F.when(F.col("p_size") > 5, F.array("p_type", "p_brand")).alias("genres"),
        F.concat(F.lit("<p>"), F.col("p_name"), F.lit("</p>")).alias("description"),
        F.floor("p_retailprice").alias("popularity"), F.col("p_size").cast("long").alias("episodes"))
    page = F.to_json(F.struct(F.struct(F.struct(F.array(item).alias("media")).alias("Page")).alias("data")))
    return table(spark, sf_dir, "part").select(F.from_json(page, CATALOG_PAGE).alias("p")).select("p.*")


_FLAT_SQL = """SELECT p_partkey AS media_id, CASE WHEN p_size > 10 THEN p_name END AS title_romaji,
       CASE WHEN p_size > 10 THEN p_brand END AS title_english,
       CASE WHEN p_size > 5 THEN '["' || p_type || '","' || p_brand || '"]' ELSE '[]' END AS genres,
       '<p>' || p_name || '</p>' AS description_html, CAST(floor(p_retailprice) AS BIGINT) AS popularity FROM part"""


@register("flatten_payloads", _FLAT_SQL)
def q_flatten_payloads(spark, sf_dir):
    """SRC-4 / JSN-3: nested payload documents to flat rows."""
    flat = bronze.flatten_payloads(_payload_pages(spark, sf_dir), "2024-05-01T00:00:00Z")
    return flat.select("media_id", "title_romaji", "title_english", "genres", "description_html", "popularity")


@register("landed_catalog", """
SELECT p_partkey AS media_id, CASE WHEN p_size > 10 THEN p_brand END AS title,
       CASE WHEN p_size > 5 THEN [p_type, p_brand] ELSE CAST([] AS VARCHAR[]) END AS genres, p_name AS synopsis,
       DATE '2024-05-02' AS ingest_date
FROM part
""")
def q_landed_catalog(spark, sf_dir):
    """SNK-1 / SNK-2 / SRC-1 / DAT-4 / PRJ-3: two daily appends, read back from the newer day, cleaned."""
    root = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    for day in ("2024-05-01", "2024-05-02"):
        bronze.append_partitioned(bronze.flatten_payloads(_payload_pages(spark, sf_dir), f"{day}T08:00:00Z"), root)
    rows = bronze.read(spark, root, since="2024-05-02")
    return silver.stg_media(rows).join(rows.select("media_id", "ingest_date"), "media_id").select(
        "media_id", "title", "genres", "synopsis", "ingest_date")


@register("golden_roundtrip", f"SELECT title_key, title, ep1_viewers, ep2_viewers, ep2_retention FROM ({DROPOFF_SQL})")
def q_golden_roundtrip(spark, sf_dir):
    """SNK-6 / SRC-7 / SRT-4: the mart frozen to CSV in key order and read back."""
    columns = ["title_key", "title", "ep1_viewers", "ep2_viewers", "ep2_retention"]
    path = scratch_path(spark, f"golden-{uuid.uuid4().hex}")
    files.write_golden_csv(dropoff(spark, sf_dir), path, columns, ["title_key"])
    schema = T.StructType([T.StructField(c, t) for c, t in zip(
        columns, (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.DoubleType()), strict=True)])
    return files.read_golden_csv(spark, path, schema)


@register("vector_catalog", f"""
WITH v AS ({_title_vector_sql()})
SELECT p_partkey, tone, p_name, p_type FROM v JOIN part USING (p_partkey)
""")
def q_vector_catalog(spark, sf_dir):
    """STA-5: title vectors joined to their dimension, rounded."""
    part = table(spark, sf_dir, "part")
    vec = stats.title_vectors(part.select("p_partkey", F.array("p_type").alias("genres")), "p_partkey", "genres", PART_TYPE_NUDGES)
    return stats.vector_catalog(vec, part.select("p_partkey", "p_name", "p_type"), "p_partkey")


@register("bounds_checks", """
SELECT count(*) FILTER (WHERE NOT coalesce(l_quantity BETWEEN 1 AND 40, false)) AS quantity,
       count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.08, false)) AS discount,
       count(*) FILTER (WHERE NOT coalesce(l_linenumber >= 1, false)) AS line FROM lineitem
""")
def q_bounds_checks(spark, sf_dir):
    """DQ-7: violations of three rules in one scan."""
    return quality.bounds_checks(table(spark, sf_dir, "lineitem"), {
        "quantity": F.col("l_quantity").between(1, 40), "discount": F.col("l_discount") <= 0.08, "line": F.col("l_linenumber") >= 1})


@register("quality_gate", f"""
SELECT CASE WHEN count(*) FILTER (WHERE NOT passed) > 0 THEN 'fail' ELSE 'pass' END AS status,
       list(test || ' ' || model || ' ' || CASE WHEN passed THEN 'pass' ELSE 'fail' END ORDER BY test_order) AS gates
FROM ({ORACLE["dq_suite"]})
""")
def q_quality_gate(spark, sf_dir):
    """DQ-8: the suite's rows folded into one status, in order."""
    rows = quality.run_suite(_suite(spark, sf_dir)).select(
        F.col("test_order").alias("gate_order"), F.concat_ws(" ", "test", "model").alias("gate"),
        F.when(F.col("passed"), "pass").otherwise("fail").alias("status"), F.lit(None).cast("string").alias("reason"))
    return quality.gate(rows).select("status", F.transform("gates", lambda g: F.concat_ws(" ", g["gate"], g["status"])).alias("gates"))


@register("valid_run_ids", r"""
WITH r AS (SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') || '-' || CASE WHEN event_type = 'click' THEN 'xyz' ELSE '' END
                  || lower(to_hex(event_id + 4096)) AS run_id FROM events)
SELECT event_id, run_id, regexp_full_match(run_id, '\d{8}T\d{6}Z-[0-9a-f]{4,}') AS ok FROM r
""")
def q_valid_run_ids(spark, sf_dir):
    """FLT-8: run ids that are safe as file names."""
    run_id = F.concat(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z-'"), F.when(F.col("event_type") == "click", "xyz").otherwise(""),
                      F.lower(F.hex(F.col("event_id") + 4096)))
    rows = table(spark, sf_dir, "events").select("event_id", run_id.alias("run_id"))
    return rows.withColumn("ok", runlog.valid_run_id(F.col("run_id")))


@register("run_order_checks", """
SELECT DISTINCT 'run-' || user_id AS run_id, true AS starts_ok, true AS ends_ok, CAST(0 AS BIGINT) AS bad_gates FROM events
""")
def q_run_order_checks(spark, sf_dir):
    """STR-8: every run starts and ends as it should, its gates in order."""
    return runlog.check_order(_gate_events(spark, sf_dir))


@register("run_record_checks", """
SELECT 'run-' || user_id AS run_id, false AS record_ok, count(DISTINCT event_type) AS n_gates FROM events GROUP BY 1
""")
def q_run_record_checks(spark, sf_dir):
    """STR-9: the record contract; these runs' ids are not of the required form."""
    events = _gate_events(spark, sf_dir)
    runs = runlog.check_records(runlog.run_rollup(events, runlog.gate_rollup(events)))
    return runs.select("run_id", "record_ok", F.size("gates").cast("long").alias("n_gates"))


@register("long_gate_tail", """
SELECT event_type AS gate, list(event_id ORDER BY event_id) AS tail, 50 < max(n) AS is_cut
FROM (SELECT event_type, event_id, count(*) OVER (PARTITION BY event_type) AS n,
             row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
WHERE rn <= 50 GROUP BY event_type
""")
def q_long_gate_tail(spark, sf_dir):
    """WIN-3: gates of many more than 50 lines keep the last 50 in order."""
    ev = table(spark, sf_dir, "events")
    tails = runlog.log_tail(ev, ["event_type"], "event_id", "event_id")
    n = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return tails.join(n, "event_type").select(F.col("event_type").alias("gate"), "tail", (F.col("n") > 50).alias("is_cut"))


@register("enrich_assemble", f"""
WITH {_RESPONSES_SQL}
SELECT p.media_id AS title_key, p.mood_tags, 'rule-1' AS enrichment_model, p.raw_response, p.parse_ok
FROM preds p
""")
def q_enrich_assemble(spark, sf_dir):
    """ENR-3 / ENR-4 / ENR-5: raw replies assembled into results and joined back to the titles."""
    raw = _responses(spark, sf_dir).select("media_id", "raw_response", "latency_ms", "input_tokens", "output_tokens")
    results = enrich.assemble(raw, "rule-1", EVAL_VOCAB, enriched_at="2024-05-01T00:00:00Z")
    dim = gold.dim_title(_doc_titles(spark, sf_dir).drop("synopsis").withColumn("synopsis", F.lit("")), results)
    return dim.join(results.select(F.col("media_id").alias("title_key"), "raw_response", "parse_ok"), "title_key").select(
        "title_key", "mood_tags", "enrichment_model", "raw_response", "parse_ok")


@register("pass_positions", """
SELECT p_partkey AS media_id, row_number() OVER (ORDER BY p_retailprice DESC NULLS LAST, p_partkey) AS position, p_type AS title
FROM part QUALIFY position <= 50
""")
def q_pass_positions(spark, sf_dir):
    """SRT-3 / SRT-5 / MTH-3: the labeling pool of the first pass."""
    dim = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("title_key"), F.col("p_type").alias("title"), F.lit("").alias("synopsis"), F.col("p_retailprice").alias("popularity"))
    return labelops.labeling_pool(dim).select("media_id", F.col("position").cast("long").alias("position"), "title")


@register("display_keys", """
SELECT l_orderkey, l_linenumber, l_orderkey || '-' || l_partkey || '-' || l_suppkey AS event_key,
       concat_ws(', ', l_returnflag, l_linestatus) AS flags, least(greatest(l_quantity, 5.0), 30.0) AS clamped FROM lineitem
""")
def q_display_keys(spark, sf_dir):
    """STRG-5 / STRG-7 / MTH-3: composite keys, tag display and clamping."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", composite_key("l_orderkey", "l_partkey", "l_suppkey").alias("event_key"),
        tag_display(F.array("l_returnflag", "l_linestatus")).alias("flags"), clamp("l_quantity", 5.0, 30.0).alias("clamped"))


# ---------------------------------------------------------------------------
# Results kept between runs: ledger, viewers by day, fingerprints, run state
# ---------------------------------------------------------------------------
def _length_classifier(batch):
    """Replies that follow from the prompt alone, so that equal prompts have equal replies."""
    n = batch["prompt"].str.len()
    return batch[["media_id"]].assign(raw_response=n.map(lambda k: '["long"]' if k > 400 else '["short"]'), latency_ms=n,
                                      input_tokens=n // 4, output_tokens=1)


@register("enrich_ledger", """
SELECT doc_id AS media_id, CASE WHEN n > 400 THEN '["long"]' ELSE '["short"]' END AS raw_response, n AS latency_ms,
       n // 4 AS input_tokens, CAST(1 AS BIGINT) AS output_tokens
FROM (SELECT doc_id, length(substring(text, 1, 2000)) AS n FROM documents WHERE length(text) > 40)
""")
def q_enrich_ledger(spark, sf_dir):
    """ENR-2: English texts are classified first; the second run, over all texts, calls for the missing prompts only."""
    path = scratch_path(spark, f"replies-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    ledger.classify(enrich.candidates(docs.filter("lang = 'en'"), key="doc_id", text="text"), _length_classifier, "length-1", path, waves=2)
    return ledger.classify(enrich.candidates(docs, key="doc_id", text="text"), _length_classifier, "length-1", path, waves=2)


@register("viewers_by_year", """
WITH f AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS title_key, o_custkey, o_orderstatus = 'F' AS first FROM orders)
SELECT title_key, strict, count(DISTINCT o_custkey) FILTER (WHERE first) AS ep1_viewers,
       count(DISTINCT o_custkey) FILTER (WHERE NOT first AND (NOT strict OR (title_key, o_custkey) IN
           (SELECT (title_key, o_custkey) FROM f WHERE first))) AS ep2_viewers
FROM f, (VALUES (true), (false)) s(strict) GROUP BY title_key, strict
""")
def q_viewers_by_year(spark, sf_dir):
    """AGG-1 / AGG-2: customers of each order priority (finished orders, other ones), appended in two steps of whole years."""
    path = scratch_path(spark, f"viewers-{uuid.uuid4().hex}")
    fact = table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("long").alias("title_key"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("episode"),
        F.col("o_custkey").alias("user_key"), F.trunc("o_orderdate", "year").alias("watch_date"))
    late = F.coalesce(F.col("watch_date") >= F.lit("1998-01-01").cast("date"), F.lit(True))
    viewers.append_days(fact.filter(~late), path)
    viewers.append_days(fact.filter(late), path)
    days = viewers.stored_days(spark, path)
    both = [viewers.episode_viewers(days, strict_cohort=strict).withColumn("strict", F.lit(strict)) for strict in (True, False)]
    return both[0].unionByName(both[1])


def _row_text_sql(columns: list[str]) -> str:
    return " || ".join(f"coalesce('{c}=' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) || ';', '{c}!;')" for c in columns)


@register("bucket_prints", f"""
SELECT substr(sha256({_row_text_sql(["doc_id"])}), 1, 2) AS bucket, count(*) AS n_rows,
       CAST(sum(CAST(CAST('0x' || substr(sha256({_row_text_sql(_PRINTED["documents"])}), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS print
FROM documents GROUP BY 1
""")
def q_bucket_prints(spark, sf_dir):
    """DQ-6: a fingerprint for each key bucket of a whole table."""
    return frozen.bucket_prints(table(spark, sf_dir, "documents").select(*_PRINTED["documents"]), ["doc_id"])


@register("frozen_drift", ORACLE["golden_drift"])
def q_frozen_drift(spark, sf_dir):
    """DQ-5 / DQ-6: the mart stored with its bucket fingerprints against a changed model; unequal buckets are read."""
    cols = ["title_key", "title", "primary_genre", "ep1_viewers", "ep2_viewers", "ep2_retention"]
    path = scratch_path(spark, f"frozen-{uuid.uuid4().hex}")
    frozen.freeze(quality.freeze(dropoff(spark, sf_dir), cols), ["title_key"], path, digits=1)
    return frozen.drift(spark, path, quality.freeze(dropoff(spark, sf_dir, strict_cohort=True), cols), ["title_key"], digits=1)


@register("observed_suite", """
SELECT test_order, test, 'fact' AS model, column_name, failures, failures = 0 AS passed FROM (
  SELECT CAST(0 AS INTEGER) AS test_order, 'not_null' AS test, 'l_shipdate' AS column_name, count(*) FILTER (WHERE l_shipdate IS NULL) AS failures FROM lineitem
  UNION ALL SELECT 1, 'bounds', 'quantity', count(*) FILTER (WHERE NOT coalesce(l_quantity BETWEEN 1 AND 40, false)) FROM lineitem
  UNION ALL SELECT 2, 'bounds', 'line', count(*) FILTER (WHERE NOT coalesce(l_linenumber >= 1, false)) FROM lineitem
  UNION ALL SELECT 3, 'relationships', 'l_suppkey', (SELECT count(*) FROM lineitem l WHERE l_suppkey IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)))
""")
def q_observed_suite(spark, sf_dir):
    """DQ-2 / DQ-4 / DQ-7: null and bounds checks counted by the write; relationships keep their pass."""
    path = scratch_path(spark, f"observed-{uuid.uuid4().hex}")
    fact = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    written = observed.write(fact, path, "fact", ["l_shipdate"],
                             {"quantity": F.col("l_quantity").between(1, 40), "line": F.col("l_linenumber") >= 1})
    stored = spark.read.schema(fact.schema).parquet(path)
    return observed.suite(written, [quality.Check("relationships", "fact", "l_suppkey", stored, table(spark, sf_dir, "supplier"), "s_suppkey")])


@register("run_status_stream", """
SELECT 'run-' || user_id AS run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS finished_at,
       CASE WHEN bool_or(event_type = 'error') THEN 'fail' ELSE 'pass' END AS status,
       count(DISTINCT event_type) AS gates_done, count(*) AS log_lines
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""")
def q_run_status_stream(spark, sf_dir):
    """STR-4 / STR-5: run records from a stream of several micro-batches whose state holds open runs only."""
    root = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    events = _gate_events(spark, sf_dir).filter(F.col("run_id").isNotNull())
    events.write.parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(f"{root}/events")
    query = streams.append_to(run_state.run_parts(stream, silence_ms=None), f"{root}/parts", f"{root}/ck", available_now=True)
    query.awaitTermination()
    runs = run_state.fold(spark.read.schema(run_state.OUT).parquet(f"{root}/parts"))
    return runs.select("run_id", F.date_format("started_at", _TS_FMT).alias("started_at"), F.date_format("finished_at", _TS_FMT).alias("finished_at"),
                       "status", "gates_done", "log_lines")
