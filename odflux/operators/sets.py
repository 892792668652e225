"""Unions and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL over the superset of the columns, absent ones missing, numbers widened."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
