"""Date/time helpers: DAT-1 .. DAT-5. The session time zone is pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake.functions._util import ColumnOrName, as_col


def to_timestamp_utc(c: ColumnOrName, strict: bool = True) -> Column:
    """DAT-1/DAT-5: ISO-8601 text (or NTZ timestamp) to a UTC timestamp.

    ``strict=False`` yields NULL for unparseable text so callers can quarantine.
    """
    c = as_col(c)
    return c.cast("timestamp") if strict else F.try_to_timestamp(c.cast("string"))


def to_date_utc(c: ColumnOrName) -> Column:
    """DAT-2: calendar date of a timestamp in UTC."""
    return F.to_date(as_col(c))


def days_between(start: ColumnOrName, end: ColumnOrName | None = None) -> Column:
    """DAT-3: whole days from ``start`` to ``end`` (default: today), as bigint."""
    end_col = F.current_date() if end is None else as_col(end)
    return F.datediff(end_col, as_col(start)).cast("long")


def date_path(ts: ColumnOrName) -> Column:
    """DAT-4: ``yyyy-MM-dd`` partition value of a timestamp."""
    return F.date_format(as_col(ts), "yyyy-MM-dd")
