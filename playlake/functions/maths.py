"""Numeric helpers: MTH-1 .. MTH-5, CND-2, CND-3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake.functions._util import ColumnOrName, as_col


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """CND-2: ``num / den`` as double, NULL when ``den`` is 0 (ANSI-safe)."""
    return as_col(num).cast("double") / F.nullif(as_col(den), F.lit(0)).cast("double")


def py_round(c: ColumnOrName, scale: int = 0) -> Column:
    """MTH-2: round half to even, as Python's ``round`` does.

    Ties are those of the value's shortest decimal text: 2.675 is a tie here and
    gives 2.68, where Python rounds the binary value just below it to 2.67.
    """
    return F.bround(as_col(c).cast("double"), scale)


def clamp(c: ColumnOrName, lo: float, hi: float) -> Column:
    """MTH-3: bound a value to ``[lo, hi]``."""
    return F.least(F.greatest(as_col(c), F.lit(lo)), F.lit(hi))


def floor_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """MTH-4: Python ``//`` on non-negative integers; ``den`` of 0 treated as 1."""
    n = as_col(num).cast("long")
    d = F.greatest(as_col(den).cast("long"), F.lit(1))
    # exact on longs: n - pmod(n, d) is a multiple of d (floor semantics)
    return ((n - F.pmod(n, d)) / d).cast("long")


def rate(cond: Column) -> Column:
    """CND-3: share of rows where ``cond`` holds; NULL counts as false."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))
