"""Column-level helpers. Each returns a Spark ``Column``."""

from playlake.functions.arrays import (  # noqa: F401
    dot,
    first_or_null,
    jaccard,
    l2_normalize,
    parse_string_array,
    to_json_list,
    vocab_filter,
)
from playlake.functions.dates import date_path, days_between, to_date_utc, to_timestamp_utc  # noqa: F401
from playlake.functions.json import json_values, parse_tag_responses  # noqa: F401
from playlake.functions.maths import clamp, floor_div, py_round, rate, safe_div  # noqa: F401
from playlake.functions.strings import (  # noqa: F401
    char_length,
    composite_key,
    format4,
    py_strip,
    sha256_hex,
    strip_html,
    tag_display,
    truncate,
)
