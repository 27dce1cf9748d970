"""Explicit schemas for every dataset (FIXTURES F1-F11) and fixed values.

Declaring types up front keeps an all-NULL column from changing type between
runs, which schema inference cannot promise.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
# Mood vocabulary, in this order.
MOOD_TAGS = ["dark", "cozy", "hype", "melancholy", "absurd"]
# Tone axes of the title feature vector, in this order (same words as MOOD_TAGS).
TONES = ["dark", "cozy", "hype", "melancholy", "absurd"]
# Genre nudges applied to the hashed base vector: genre -> (tone, weight).
GENRE_NUDGES = {
    "Horror": ("dark", 0.35),
    "Thriller": ("dark", 0.25),
    "Psychological": ("melancholy", 0.3),
    "Slice of Life": ("cozy", 0.4),
    "Comedy": ("absurd", 0.3),
    "Action": ("hype", 0.35),
    "Sports": ("hype", 0.3),
    "Drama": ("melancholy", 0.25),
    "Romance": ("cozy", 0.2),
}
# Eval gate defaults: macro-F1 floor and parse-failure ceiling.
MIN_MACRO_F1 = 0.6
MAX_PARSE_FAIL = 0.05
# Retention mart: minimum episode-1 audience for a title to be reported.
MIN_EP1_VIEWERS = 20
# Run ids: UTC timestamp, 'Z', dash, lowercase hex suffix.
RUN_ID_PATTERN = r"^\d{8}T\d{6}Z-[0-9a-f]{4,}$"
# Log lines kept per gate in a run record.
TAIL_LINES = 50
# Enrichment input is cut to this many characters; titles need a longer synopsis.
PROMPT_CHARS = 2000
MIN_SYNOPSIS_CHARS = 40
# Bronze source tag.
SOURCE_TAG = "anilist_graphql"
# ---------------------------------------------------------------------------

_media_item = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StructType([
        T.StructField("romaji", T.StringType()),
        T.StructField("english", T.StringType()),
    ])),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("rank", T.IntegerType()),
    ]))),
    T.StructField("description", T.StringType()),
    T.StructField("averageScore", T.LongType()),
    T.StructField("popularity", T.LongType()),
    T.StructField("episodes", T.LongType()),
    T.StructField("season", T.StringType()),
    T.StructField("seasonYear", T.LongType()),
    T.StructField("format", T.StringType()),
    T.StructField("status", T.StringType()),
])

# one API page document.
CATALOG_PAGE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("Page", T.StructType([
            T.StructField("pageInfo", T.StructType([T.StructField("hasNextPage", T.BooleanType())])),
            T.StructField("media", T.ArrayType(_media_item)),
        ])),
    ])),
])

# bronze catalog rows (file form; ingest_date comes from the partition path).
BRONZE_MEDIA = T.StructType([
    T.StructField("media_id", T.LongType()),
    T.StructField("title_romaji", T.StringType()),
    T.StructField("title_english", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("description_html", T.StringType()),
    T.StructField("average_score", T.LongType()),
    T.StructField("popularity", T.LongType()),
    T.StructField("episodes", T.LongType()),
    T.StructField("season", T.StringType()),
    T.StructField("season_year", T.LongType()),
    T.StructField("format", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source", T.StringType()),
])

# F3
BRONZE_USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("primary_device", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("favorite_genre", T.StringType()),
])

# F4
BRONZE_PLAYBACK = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("media_id", T.LongType()),
    T.StructField("episode", T.LongType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("watch_pct", T.DoubleType()),
    T.StructField("completed", T.BooleanType()),
    T.StructField("rebuffer_count", T.LongType()),
    T.StructField("startup_time_ms", T.LongType()),
    T.StructField("device", T.StringType()),
    T.StructField("region", T.StringType()),
])

# F5
TITLE_MOODS = T.StructType([
    T.StructField("media_id", T.LongType()),
    T.StructField("mood_tags", T.ArrayType(T.StringType())),
    T.StructField("raw_response", T.StringType()),
    T.StructField("parse_ok", T.BooleanType()),
    T.StructField("latency_ms", T.LongType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
    T.StructField("enrichment_model", T.StringType()),
    T.StructField("enriched_at", T.TimestampType()),
])

# Output of a caller-supplied classifier (ENR-2), before parsing.
CLASSIFIER_OUTPUT = T.StructType([
    T.StructField("media_id", T.LongType()),
    T.StructField("raw_response", T.StringType()),
    T.StructField("latency_ms", T.LongType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
])

# F6 (a ``seq`` column carries file order when the writer supplies it)
GOLDEN_LABELS = T.StructType([
    T.StructField("media_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("mood_tags", T.ArrayType(T.StringType())),
])

# F7
GOLDEN_DROPOFF = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("primary_genre", T.StringType()),
    T.StructField("ep1_viewers", T.LongType()),
    T.StructField("ep2_viewers", T.LongType()),
    T.StructField("ep2_retention", T.DoubleType()),
])

# F8
GATE_EVENT = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("gate", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("line", T.StringType()),
    T.StructField("gates", T.ArrayType(T.StringType())),
    T.StructField("ts", T.TimestampType()),
])

GATE_RECORD = T.StructType([
    T.StructField("gate", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("tail", T.ArrayType(T.StringType())),
])

# F9
RUN_RECORD = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("trigger", T.StringType()),
    T.StructField("gates", T.ArrayType(GATE_RECORD)),
])
