"""Checks and counts on flow tables."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflux.functions.nulls import all_present
from odflux.operators.filters import year_in_set
from odflux.operators.lookups import Lookup


# Names of a register up to this many bytes are tested in the plan of the table itself, others by a join.
NAMED_BYTES = 1024 * 1024


class AreaNames:
    """Known area names, measured once, and the test whether a cell holds one."""

    def __init__(self, register: DataFrame, name_column: str = "gss_name", max_bytes: int = NAMED_BYTES) -> None:
        names = register.select(F.col(name_column).alias("cell")).where("cell IS NOT NULL").distinct()
        self.lookup = Lookup(names, "cell")
        self.few = self.lookup.size.bytes <= max_bytes

    @cached_property
    def listed(self) -> list[str]:
        """The names; only asked for when they are few."""
        return [row["cell"] for row in self.lookup.frame.collect()]

    def held(self, column: str) -> Column:
        return F.coalesce(F.col(column).isin(self.listed), F.lit(False))


def text_columns(df: DataFrame) -> list[str]:
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        raise ValueError("the table has no text column")
    return texts


def columns_with_area_names(df: DataFrame, register: DataFrame | AreaNames, name_column: str = "gss_name") -> DataFrame:
    """Text columns of ``df`` holding a known area name, with the rows that do.

    Of few names, one partial aggregate over one scan; of many, cells are joined with them.
    """
    names = register if isinstance(register, AreaNames) else AreaNames(register, name_column)
    texts = text_columns(df)
    if not names.few:
        cells = df.select(*texts).unpivot([], texts, "column_name", "cell")
        return names.lookup.restrict(cells, "cell").groupBy("column_name").agg(F.count(F.lit(1)).alias("n_rows"))
    counts = df.agg(*[F.count_if(names.held(c)).alias(c) for c in texts])
    return counts.unpivot([], texts, "column_name", "n_rows").where("n_rows > 0")


class AreaNameWatch:
    """Counts area names in a table's text columns while an action on it runs, without a job of its own."""

    def __init__(self, names: AreaNames) -> None:
        self.names = names
        self.seen = Observation()
        self.watched: list[str] = []

    def on(self, df: DataFrame) -> DataFrame:
        self.watched = text_columns(df)
        if not self.names.few:
            raise ValueError("too many names to be tested in the plan; use columns_with_area_names")
        return df.observe(self.seen, *[F.count_if(self.names.held(c)).alias(c) for c in self.watched])

    @property
    def columns(self) -> dict[str, int]:
        """Columns with a name and their rows; waits for the first action on the watched table."""
        return {c: n for c, n in self.seen.get.items() if n}

    def warn(self, stacklevel: int = 2) -> dict[str, int]:
        found = self.columns
        for column in found:
            warnings.warn(f"column {column!r} holds area names; consider leaving it out", stacklevel=stacklevel + 1)
        return found


def distinct_codes(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("code")).distinct()


def code_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct codes, a missing code counted as one."""
    return distinct_codes(df, column).agg(F.count(F.lit(1)).alias("n_codes"))


def code_difference(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Distinct codes of ``before`` that ``after`` lacks."""
    return distinct_codes(before, column).subtract(distinct_codes(after, column))


def code_sides(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Every code with the side it occurs on: both, left_only or right_only.

    A union of the two code sets with one shuffle; a full outer join gives
    the same rows.
    """
    left = before.select(F.col(column).alias("code"), F.lit(True).alias("l"), F.lit(False).alias("r"))
    right = after.select(F.col(column).alias("code"), F.lit(False).alias("l"), F.lit(True).alias("r"))
    seen = left.unionByName(right).groupBy("code").agg(F.bool_or("l").alias("l"), F.bool_or("r").alias("r"))
    side = F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left_only").otherwise("right_only")
    return seen.select("code", side.alias("side"))


def recode_sides(df: DataFrame, column: str, lookup: Lookup, new: str, measures: Sequence[str] = ("value",)) -> DataFrame:
    """``code_sides`` of a table before and after the recode and sum of one column.

    Only the codes are shuffled: the lookup is applied to the set of codes, not to
    the rows. Rows with a missing key are not summed, so a code that has no other
    rows does not come out. ``new`` is the column of the lookup with the new code.
    """
    keys = [c for c in df.columns if c not in measures]
    codes = df.groupBy(F.col(column).alias("code")).agg(F.bool_or(all_present(keys)).alias("summed"))
    after = lookup.attach(codes.where("summed").select("code"), "code", {new: "__new"}, "left")
    return code_sides(codes, after.select(F.coalesce("__new", "code").alias("code")), "code")


def changed_codes(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    return only_changed(code_sides(before, after, column))


def only_changed(sides: DataFrame) -> DataFrame:
    return sides.where(F.col("side") != "both")


def added_removed_codes(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Codes gained and lost, with the number of distinct codes before and after."""
    return added_and_removed(code_sides(before, after, column))


def added_and_removed(sides: DataFrame) -> DataFrame:
    """Codes gained and lost and the two counts, of ``code_sides`` or ``recode_sides``.

    Each code is laid out under every heading it counts for, so the sides are
    made once for the lists and the counts.
    """
    side, code = F.col("side"), F.col("code")

    def entry(heading: str, condition: Column, listed: Column) -> Column:
        return F.when(condition, F.struct(F.lit(heading).alias("change"), listed.alias("listed")))

    nothing = F.lit(None).cast("string")
    entries = F.array(
        entry("removed", side == "left_only", code),
        entry("added", side == "right_only", code),
        entry("n_before", side != "right_only", nothing),
        entry("n_after", side != "left_only", nothing),
    )
    laid_out = sides.select(F.inline(entries)).where(F.col("change").isNotNull())
    counts = F.explode(F.array(F.lit("n_before"), F.lit("n_after"))).alias("change")
    zeros = sides.sparkSession.range(1).select(counts, nothing.alias("listed"), F.lit(0).alias("n"))
    entered = laid_out.withColumn("n", F.lit(1)).unionByName(zeros)
    counted = entered.groupBy("change", "listed").agg(F.sum("n").cast("string").alias("n"))
    is_count = F.col("change").startswith("n_")
    return counted.select("change", F.when(is_count, F.col("n")).otherwise(F.col("listed")).alias("code"))


def changes_for_years(changes: DataFrame, years: Iterable[int], column: str = "year") -> DataFrame:
    return year_in_set(changes, years, column)


def distinct_years(df: DataFrame) -> DataFrame:
    return df.select("year").distinct()


def year_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def row_and_column_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def preview(df: DataFrame, order: Iterable[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def sort_years(df: DataFrame) -> DataFrame:
    return df.orderBy("year")
