"""Null rules of the flow tables, one helper per rule.

A missing value differs from everything, never matches a pattern, is not a
group, and adds nothing to a sum.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def differs(left: Column, right: Column) -> Column:
    """``left != right`` where a missing side counts as different; against a constant it can be pushed to the scan."""
    return left.isNull() | right.isNull() | (left != right)


def holds(column: Column, pattern: str) -> Column:
    """Regex search that is false, not missing, on a missing value.

    Alternatives that are plain words are searched as words, which costs a
    fraction of a regex and can be pushed to the scan.
    """
    words = pattern.split("|")
    if all(word.isalnum() for word in words):
        found = reduce(lambda left, right: left | right, (column.contains(word) for word in words))
    else:
        found = column.rlike(pattern)
    return column.isNotNull() & found


def sum_or_zero(column: Column | str) -> Column:
    """Sum that is 0 for a group holding only missing values."""
    return F.coalesce(F.sum(column), F.lit(0))


def all_present(columns: Iterable[str]) -> Column:
    return reduce(lambda left, right: left & right, (F.col(c).isNotNull() for c in columns), F.lit(True))


def with_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows whose grouping columns are all present."""
    return df.where(all_present(columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN in a float column becomes null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats})
