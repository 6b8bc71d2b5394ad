"""One-row results side by side, without a cross join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Merge frames of one row (or none) and distinct columns into a single row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
