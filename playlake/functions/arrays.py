"""Array helpers: ARR-1 .. ARR-5, PRJ-4, FLT-7, JSN-1, EVL-4/EVL-11 Jaccard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake.functions._util import ColumnOrName, as_col


def parse_string_array(c: ColumnOrName) -> Column:
    """ARR-1: JSON array text to ``array<string>``; malformed text gives NULL."""
    return F.from_json(as_col(c), "array<string>")


def first_or_null(c: ColumnOrName) -> Column:
    """PRJ-4: first element, NULL for an empty or NULL array (never raises)."""
    return F.get(as_col(c), 0)


def to_json_list(c: ColumnOrName) -> Column:
    """JSN-1: array to JSON text, NULL becoming ``[]``."""
    arr = as_col(c)
    return F.to_json(F.coalesce(arr, F.array().cast("array<string>")))


def vocab_filter(tags: ColumnOrName, vocab: Sequence[str]) -> Column:
    """FLT-7: keep elements found in ``vocab``; order and duplicates preserved."""
    allowed = F.array(*[F.lit(v) for v in vocab])
    return F.filter(as_col(tags), lambda t: F.array_contains(allowed, t))


def jaccard(a: ColumnOrName, b: ColumnOrName, empty_value: float) -> Column:
    """|A ∩ B| / |A ∪ B| over the element *sets*; ``empty_value`` when both are empty.

    EVL-4 uses 1.0 for two empty sets, EVL-11 uses 0.0; callers choose.
    NULL arrays are treated as empty.
    """
    sa = F.array_distinct(F.coalesce(as_col(a), F.array().cast("array<string>")))
    sb = F.array_distinct(F.coalesce(as_col(b), F.array().cast("array<string>")))
    inter = F.size(F.array_intersect(sa, sb))
    union = F.size(F.array_union(sa, sb))
    return F.when(union == 0, F.lit(float(empty_value))).otherwise(
        inter.cast("double") / union.cast("double")
    )


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    """ARR-4: dot product of two equal-length numeric arrays (JVM-side)."""
    products = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: ColumnOrName) -> Column:
    return F.sqrt(F.aggregate(as_col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: ColumnOrName, norm: ColumnOrName | None = None) -> Column:
    """ARR-5: divide by the L2 norm; a zero norm divides by 1.

    Pass ``norm`` as an already projected column on large vectors: an outer
    expression inside the ``transform`` lambda is evaluated once per element.
    """
    n = l2_norm(v) if norm is None else as_col(norm)
    safe = F.coalesce(F.nullif(n, F.lit(0.0)), F.lit(1.0))
    return F.transform(as_col(v), lambda x: x.cast("double") / safe)
