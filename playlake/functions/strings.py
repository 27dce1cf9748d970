"""String helpers: STRG-1 .. STRG-8."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake.functions._util import ColumnOrName, as_col


def strip_html(c: ColumnOrName) -> Column:
    """STRG-1: drop every ``<...>`` tag; NULL becomes ''. No entity decoding."""
    return F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"<[^>]+>", "")


def truncate(c: ColumnOrName, n: int) -> Column:
    """STRG-2: first ``n`` characters (code points)."""
    return F.substring(as_col(c), 1, n)


def py_strip(c: ColumnOrName) -> Column:
    """STRG-3: Python ``str.strip()`` on ASCII whitespace (Spark ``trim`` only drops spaces)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def char_length(c: ColumnOrName) -> Column:
    """STRG-4: length in characters."""
    return F.char_length(as_col(c))


def composite_key(*cols: ColumnOrName, sep: str = "-") -> Column:
    """STRG-5: ``"{a}-{b}-{c}"`` key text."""
    return F.concat_ws(sep, *[as_col(c).cast("string") for c in cols])


def sha256_hex(c: ColumnOrName) -> Column:
    """STRG-6: lowercase hex SHA-256 of the UTF-8 text."""
    return F.sha2(as_col(c).cast("string"), 256)


def tag_display(tags: ColumnOrName) -> Column:
    """STRG-7: tags joined for display."""
    return F.array_join(as_col(tags), ", ")


def format4(c: ColumnOrName) -> Column:
    """STRG-8: a double as text with 4 decimals; NULL stays NULL."""
    v = as_col(c).cast("double")
    return F.when(v.isNotNull(), F.format_string("%.4f", v))
