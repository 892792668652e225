"""Predicates on area codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from odflux.functions.nulls import holds

# Area codes and code patterns of the flow tables.
LOCAL_AUTHORITY_PATTERN = "E0|W0"
LONDON_BOROUGH_PREFIX = "E09"
LONDON_REGION = "E12000007"
INNER_AND_OUTER_LONDON = ("E13000001", "E13000002")
ENGLAND = "E92000001"
NOT_LONDON = "other"
TOTAL = "total"


def is_local_authority(column: Column, pattern: str = LOCAL_AUTHORITY_PATTERN) -> Column:
    """The pattern may occur anywhere in the code; a missing code does not match."""
    return holds(column, pattern)


def is_london_borough(column: Column) -> Column:
    return column.startswith(LONDON_BOROUGH_PREFIX)


def both_in(left: Column, right: Column, codes: tuple[str, ...] = INNER_AND_OUTER_LONDON) -> Column:
    return left.isin(*codes) & right.isin(*codes)


def labelled(column: Column, labels: Mapping[object, str]) -> Column:
    """Label of a value; a value without a label is missing."""
    result = F.lit(None).cast("string")
    for value, label in labels.items():
        result = F.when(column == value, F.lit(label)).otherwise(result)
    return result
