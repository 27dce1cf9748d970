"""Combining one-row aggregates without a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames into one row.

    Each frame is a global aggregate with distinct column names. The frames
    are stacked (missing columns NULL) and folded by one tiny aggregation,
    which avoids a nested-loop or cartesian join plan entirely.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    cols = [c for f in frames for c in f.columns]
    return stacked.groupBy().agg(*[F.any_value(c, True).alias(c) for c in cols])
