"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(column: Column, decimals: int = 1) -> Column:
    """Scale, round to the even neighbour on a tie, scale back."""
    scale = float(10**decimals)
    return F.rint(column * F.lit(scale)) / F.lit(scale)
