"""Row filters. Each one is a plain predicate that can reach the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.functions import codes
from odflux.functions.nulls import differs
from odflux.operators.lookups import Lookup


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def year_before(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("year") < year)


def year_in_set(df: DataFrame, years: Iterable[int], column: str = "year") -> DataFrame:
    return df.where(F.col(column).isin(*years))


def code_pattern_split(
    df: DataFrame, column: str, pattern: str = codes.LOCAL_AUTHORITY_PATTERN
) -> tuple[DataFrame, DataFrame]:
    """Rows whose code holds the pattern, and all other rows."""
    hit = codes.is_local_authority(F.col(column), pattern)
    return df.where(hit), df.where(~hit)


def drop_self_flows(df: DataFrame) -> DataFrame:
    return df.where(differs(F.col("gss_in"), F.col("gss_out")))


def drop_zero_values(df: DataFrame, column: str = "value") -> DataFrame:
    """Missing values stay."""
    return df.where(differs(F.col(column), F.lit(0)))


def age_at_most(df: DataFrame, age: int) -> DataFrame:
    return df.where(F.col("age") <= age)


def both_ends_in_set(df: DataFrame, allowed: tuple[str, ...] = codes.INNER_AND_OUTER_LONDON) -> DataFrame:
    return df.where(codes.both_in(F.col("gss_in"), F.col("gss_out"), allowed))


def code_prefix(df: DataFrame, column: str = "gss_in", prefix: str = codes.LONDON_BOROUGH_PREFIX) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def code_equals(df: DataFrame, code: str, column: str = "gss_code") -> DataFrame:
    return df.where(F.col(column) == code)


def code_not_equals(df: DataFrame, code: str, column: str = "gss_code") -> DataFrame:
    """A missing code is kept."""
    return df.where(differs(F.col(column), F.lit(code)))


def code_present(df: DataFrame, column: str, present: DataFrame, key: str) -> DataFrame:
    """Rows of a small table whose code occurs in the ``key`` column of a large one.

    The large table is first cut down to the codes asked for, so it is
    scanned once and only those codes are shuffled.
    """
    wanted = Lookup(df.select(column).distinct(), column)
    seen = wanted.restrict(present.select(F.col(key).alias("__seen")), "__seen").distinct()
    return df.join(seen, F.col(column) == F.col("__seen"), "left_semi")
