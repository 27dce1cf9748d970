import math

from pyspark.sql import functions as F

from playlake import functions as pf
from playlake.functions.json import parse_tag_responses, with_json_check
from playlake.schemas import MOOD_TAGS

# raw response -> (tags kept, parsed)
REPLIES = {
    '["dark","x"]': (["dark"], True),
    ' ["hype"]\n': (["hype"], True),
    "[]": ([], True),
    '["dark","dark","cozy"]': (["dark", "dark", "cozy"], True),
    '[1,"dark",null,["hype"],{"cozy":1}]': (["dark"], True),
    '{"dark":1}': (["dark"], True),
    '\t{"melancholy":1,"hype":2,"zzz":3}\r\n': (["melancholy", "hype"], True),
    '["d\\u0061rk"]': (["dark"], True),
    '"dark"': ([], True),  # a string is a list of letters
    "7": ([], False),
    "1.5": ([], False),
    "true": ([], False),
    "null": ([], False),
    '["dark"] blah': ([], False),
    '["dark"] ["x"]': ([], False),
    '["a"],["b"]': ([], False),
    "['dark']": ([], False),
    '["dark",]': ([], False),
    '["dark"': ([], False),
    "not json": ([], False),
    "": ([], False),
    '```json ["dark"] ```': ([], False),
    "1],[2": ([], False),
    '{"a":1} {"b":2}': ([], False),
}


def test_strict_parse(spark):
    df = spark.createDataFrame([(r,) for r in REPLIES], "raw string")
    for row in parse_tag_responses(df, "raw", MOOD_TAGS).collect():
        assert (row.mood_tags, row.parse_ok) == REPLIES[row.raw], row.raw


def test_known_parse_differences_are_rejections(spark):
    # NaN and repeated keys are rejected here (documented)
    df = spark.createDataFrame([('[NaN,"dark"]',), ('{"dark":1,"dark":2}',)], "raw string")
    assert [r.parse_ok for r in parse_tag_responses(df, "raw", MOOD_TAGS).collect()] == [False, False]


def test_json_lines(spark):
    lines = {'{"event":"run_start"}': True, "WARNING: not json": False, "7": True, '{"a":1} trailing': False, '"x"': True}
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    assert {r.v: r.is_json for r in with_json_check(df, "v").collect()} == lines


def test_strip_html_and_strings(spark):
    df = spark.createDataFrame([("<p>Hi <b>there</b></p>",), (None,), ("a &amp; b<br/>",)], "h string")
    got = [r.t for r in df.select(pf.strip_html("h").alias("t")).collect()]
    assert got == ["Hi there", "", "a &amp; b"]
    row = spark.range(1).select(
        pf.py_strip(F.lit(" \t x \n")).alias("s"), pf.truncate(F.lit("abcdef"), 3).alias("t"),
        pf.composite_key(F.lit(1), F.lit(22), F.lit(3)).alias("k"), pf.format4(F.lit(0.5)).alias("f"),
        pf.tag_display(F.array(F.lit("dark"), F.lit("cozy"))).alias("d")).first()
    assert (row.s, row.t, row.k, row.f, row.d) == ("x", "abc", "1-22-3", "0.5000", "dark, cozy")


def test_arrays(spark):
    df = spark.createDataFrame([('["Action","Drama"]',), ("[]",), (None,), ("not json",)], "g string")
    out = df.select(pf.first_or_null(pf.parse_string_array("g")).alias("f")).collect()
    assert [r.f for r in out] == ["Action", None, None, None]
    row = spark.range(1).select(
        pf.to_json_list(F.lit(None).cast("array<string>")).alias("j"),
        pf.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"), 1.0).alias("e1"),
        pf.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"), 0.0).alias("e0"),
        pf.jaccard(F.array(F.lit("a"), F.lit("a"), F.lit("b")), F.array(F.lit("b")), 1.0).alias("j2"),
        pf.dot(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))).alias("d"),
        pf.l2_normalize(F.array(F.lit(3.0), F.lit(4.0))).alias("u"),
        pf.l2_normalize(F.array(F.lit(0.0), F.lit(0.0))).alias("z"),
        pf.vocab_filter(F.array(F.lit("dark"), F.lit("x"), F.lit("dark")), MOOD_TAGS).alias("v")).first()
    assert row.j == "[]" and row.e1 == 1.0 and row.e0 == 0.0 and row.j2 == 0.5 and row.d == 11.0
    assert row.u == [0.6, 0.8] and row.z == [0.0, 0.0] and row.v == ["dark", "dark"]


def test_maths_and_dates(spark):
    row = spark.range(1).select(
        pf.safe_div(F.lit(1), F.lit(0)).alias("z"), pf.py_round(F.lit(0.125), 2).alias("r"),
        pf.clamp(F.lit(1.4), 0.0, 1.0).alias("c"), pf.floor_div(F.lit(7), F.lit(2)).alias("fd"),
        pf.floor_div(F.lit(7), F.lit(0)).alias("fd0"),
        pf.days_between(F.lit("2026-01-01").cast("date"), F.lit("2026-03-01").cast("date")).alias("dd"),
        pf.date_path(F.lit("2026-07-11T23:59:59Z").cast("timestamp")).alias("p")).first()
    assert row.z is None and row.r == 0.12 and row.c == 1.0 and row.fd == 3 and row.fd0 == 7
    assert row.dd == 59 and row.p == "2026-07-11"
    assert math.isclose(row.r, round(0.125, 2))
    # the stated limit: ties are those of the decimal text, not of the binary value
    assert spark.range(1).select(pf.py_round(F.lit(2.675), 2).alias("r")).first().r == 2.68
