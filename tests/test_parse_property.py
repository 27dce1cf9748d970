"""Property test: the expected tags follow from the value that each text was written from."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlake.functions.json import parse_tag_responses, with_json_check
from playlake.schemas import MOOD_TAGS

words = st.sampled_from(MOOD_TAGS + ["x", "Dark", "", "hype ", "d"])
leaves = st.one_of(st.integers(-5, 5), st.booleans(), st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32))


def kept(names):
    return [n for n in names if n in MOOD_TAGS]


@st.composite
def cases(draw):
    """(text, expected tags, expected to parse, is one JSON value)."""
    kind = draw(st.sampled_from(["list", "list", "object", "string", "leaf"]))
    names = draw(st.lists(words, max_size=4))
    if kind == "list":
        value, tags, ok = list(names), kept(names), True
        for _ in range(draw(st.integers(0, 3))):
            value.insert(draw(st.integers(0, len(value))), draw(st.one_of(leaves, st.lists(words, max_size=2))))
    elif kind == "object":
        value = {n: draw(leaves) for n in names}
        tags, ok = kept(value), True
    elif kind == "string":
        value, tags, ok = draw(words), [], True
    else:
        value, tags, ok = draw(leaves), [], False
    text = json.dumps(value, separators=draw(st.sampled_from([(",", ":"), (", ", ": ")])))
    pad = draw(st.sampled_from(["", " ", "\n", "\t ", " \r\n"]))
    damage = draw(st.sampled_from([None, None, None, "after", "before", "twice", "cut"]))
    if damage == "after":
        text += draw(st.sampled_from([" x", "]", "}", ",", " []"]))
    elif damage == "before":
        text = draw(st.sampled_from(["x", ",", "```"])) + text
    elif damage == "twice":
        text = f"{text} {text}"
    elif damage == "cut":
        text = text[:-1] if text[-1] in "]}\"" else text + "]"
    if damage:
        tags, ok = [], False
    return pad + text + pad, tags, ok, not damage


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cases(), min_size=60, max_size=60))
def test_parse_gives_what_the_text_was_written_from(spark, batch):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(batch)], "i int, raw string")
    out = with_json_check(parse_tag_responses(df, "raw", MOOD_TAGS), "raw")
    for row in out.collect():
        text, tags, ok, one = batch[row.i]
        assert (row.mood_tags, row.parse_ok, row.is_json) == (tags, ok, one), text
