"""Carrying area codes from one geography vintage to another.

The table of code changes is closed into a lookup of one row per changed
code; the flow table is then relabelled by a join with that lookup and, where
asked, summed or averaged over its new keys.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflux.functions.codes import LOCAL_AUTHORITY_PATTERN, is_local_authority
from odflux.functions.nulls import all_present, sum_or_zero, with_keys
from odflux.operators.audit import AreaNameWatch, columns_with_area_names
from odflux.operators.lookups import Lookup

# Earliest vintage, latest vintage, and separator of split targets.
FIRST_VINTAGE = 2008
LAST_VINTAGE = 2024
SPLIT_SEPARATOR = ", "

FROM, TO = "changed_from_code", "changed_to_code"
AGGREGATES = {"sum": sum_or_zero, "mean": F.avg}


def check_recode(
    df: DataFrame,
    col_code: str,
    col_data: str | Sequence[str],
    recode_from_year: int,
    recode_to_year: int,
    fun: str = "sum",
    database_year: int = LAST_VINTAGE,
) -> DataFrame:
    """Raise on arguments the recode cannot work with; else give back ``df``."""
    if not isinstance(df, DataFrame):
        raise TypeError("the input must be a DataFrame")
    if not isinstance(col_code, str):
        raise TypeError("col_code names one column")
    measures = [col_data] if isinstance(col_data, str) else col_data
    if not isinstance(measures, (list, tuple)) or not all(isinstance(m, str) for m in measures):
        raise TypeError("col_data names one column or a list of columns")
    if fun not in AGGREGATES:
        raise ValueError(f"fun is one of {sorted(AGGREGATES)}, not {fun!r}")
    for name, year in (("recode_from_year", recode_from_year), ("recode_to_year", recode_to_year)):
        if isinstance(year, bool) or not isinstance(year, (int, float)):
            raise TypeError(f"{name} is a year")
        if not FIRST_VINTAGE <= year <= database_year:
            raise ValueError(f"{name} lies between {FIRST_VINTAGE} and {database_year}, not {year}")
    types = {f.name: f.dataType for f in df.schema}
    absent = [c for c in (col_code, *measures) if c not in types]
    if absent:
        raise ValueError(f"no column {absent} in the input")
    texts = [m for m in measures if not isinstance(types[m], T.NumericType)]
    if texts:
        raise ValueError(f"measures must be numeric: {texts}")
    return df


def reverse_changes(changes: DataFrame) -> DataFrame:
    """Changes read backwards: ends and flags swapped, effective a year earlier."""
    swapped = {
        FROM: TO,
        TO: FROM,
        "changed_from_name": "changed_to_name",
        "changed_to_name": "changed_from_name",
        "split": "merge",
        "merge": "split",
    }
    return changes.select(
        *[
            (F.col("year") - 1).alias("year") if c == "year" else F.col(swapped.get(c, c)).alias(c)
            for c in changes.columns
        ]
    )


def walk_changes(changes: DataFrame, recode_from_year: int, recode_to_year: int) -> DataFrame:
    """(from, to) pairs after following the changes year by year.

    Each year adds that year's changes and moves every target on by at most
    one change of the same year, so an identity change cannot loop and two
    changes of one code within a year are not chained further. Both years
    count. The loop is over years of the range, not over data; the joins are
    between changes only, so how to do them is left to Spark.
    """
    forward = recode_from_year <= recode_to_year
    edges = changes if forward else reverse_changes(changes)
    step = 1 if forward else -1
    edges = edges.select(FROM, TO, "year").where(all_present([FROM, TO]))
    reached = None
    for year in range(int(recode_from_year), int(recode_to_year) + step, step):
        of_year = edges.where(F.col("year") == year).select(FROM, TO)
        starts = of_year if reached is None else reached.unionByName(of_year)
        onward = of_year.select(F.col(FROM).alias("__via"), F.col(TO).alias("__onward"))
        moved = starts.join(onward, F.col(TO) == F.col("__via"), "left")
        reached = moved.select(FROM, F.coalesce("__onward", TO).alias(TO))
    return reached


def distinct_changes(pairs: DataFrame) -> DataFrame:
    """Pairs without repeats and without codes that stay the same."""
    return pairs.where(F.col(FROM) != F.col(TO)).dropDuplicates([FROM, TO])


def split_code_list(pairs: DataFrame) -> DataFrame:
    """One row per code; the targets of a split become one sorted label."""
    return pairs.groupBy(FROM).agg(F.array_join(F.array_sort(F.collect_set(TO)), SPLIT_SEPARATOR).alias(TO))


def recode_lookup(changes: DataFrame, recode_from_year: int, recode_to_year: int) -> DataFrame:
    """Lookup of the codes that differ between two vintages, unique on the old code."""
    pairs = walk_changes(changes, recode_from_year, recode_to_year)
    return split_code_list(pairs.where(F.col(FROM) != F.col(TO)))


def as_recode_lookup(changes: DataFrame, recode_from_year: int, recode_to_year: int) -> Lookup:
    """``recode_lookup`` evaluated once, for both ends of any number of tables."""
    return Lookup.kept(recode_lookup(changes, recode_from_year, recode_to_year), FROM)


def relabel(df: DataFrame, column: str, lookup: Lookup) -> DataFrame:
    """New code where the lookup has one, the old code elsewhere; columns keep their order."""
    found = lookup.attach(df, column, {TO: "__new_code"}, "left")
    return found.select(*[F.coalesce("__new_code", c).alias(c) if c == column else F.col(c) for c in df.columns])


def aggregate_measures(df: DataFrame, measures: Sequence[str], fun: str = "sum") -> DataFrame:
    """Sum or mean of the measures over all other columns; rows with a missing key are left out."""
    keys = [c for c in df.columns if c not in measures]
    summed = with_keys(df, keys).groupBy(*keys).agg(*[AGGREGATES[fun](m).alias(m) for m in measures])
    return summed.select(*df.columns)


def _watched(df: DataFrame, register: DataFrame | AreaNameWatch) -> DataFrame:
    """``df``, watched or warned of; a plain register is compared with it by one aggregate at once."""
    if isinstance(register, AreaNameWatch):
        return register.on(df)
    for row in columns_with_area_names(df, register).collect():  # at most a row for each column
        warnings.warn(f"column {row['column_name']!r} holds area names; consider leaving it out", stacklevel=3)
    return df


def recode_gss(
    df_in: DataFrame,
    col_code: str = "gss_code",
    col_data: str | Sequence[str] = "value",
    fun: str = "sum",
    recode_from_year: int | None = None,
    recode_to_year: int | None = None,
    aggregate_data: bool = True,
    lad_code_changes: DataFrame | Lookup | None = None,
    all_lad_codes_dates: DataFrame | AreaNameWatch | None = None,
    database_year: int = LAST_VINTAGE,
) -> DataFrame:
    """Recode one column of a table between two vintages.

    ``lad_code_changes`` is the table of changes, or a lookup made from it by
    ``as_recode_lookup`` to be used more than once. When a register of codes
    is given, one aggregate over the text columns warns of area names in them. An
    ``AreaNameWatch`` in its place adds no job: it counts while the first action on
    the result runs, and tells or warns when asked.
    """
    check_recode(df_in, col_code, col_data, recode_from_year, recode_to_year, fun, database_year)
    if lad_code_changes is None:
        raise ValueError("a table of code changes is needed")
    if all_lad_codes_dates is not None:
        df_in = _watched(df_in, all_lad_codes_dates)
    lookup = lad_code_changes
    if not isinstance(lookup, Lookup):
        lookup = as_recode_lookup(lookup, recode_from_year, recode_to_year)
    recoded = relabel(df_in, col_code, lookup)
    if not aggregate_data:
        return recoded
    measures = [col_data] if isinstance(col_data, str) else list(col_data)
    return aggregate_measures(recoded, measures, fun)


def sum_or_pass(df: DataFrame, measure: str, passes: Column) -> DataFrame:
    """Sum over all other columns; rows that pass stay as they are, each as a group of its own.

    So both go through one scan and one shuffle.
    """
    keys = [c for c in df.columns if c != measure]
    marked = df.withColumn("__row", F.when(passes, F.monotonically_increasing_id()))
    marked = marked.where(F.col("__row").isNotNull() | all_present(keys))
    summed = marked.groupBy(*keys, "__row").agg(sum_or_zero(measure).alias("__sum"), F.max(measure).alias("__only"))
    value = F.when(F.col("__row").isNull(), F.col("__sum")).otherwise(F.col("__only")).alias(measure)
    return summed.select(*[value if c == measure else F.col(c) for c in df.columns])


def recode_end(
    flows: DataFrame, column: str, lookup: Lookup, measure: str = "value", pattern: str = LOCAL_AUTHORITY_PATTERN
) -> DataFrame:
    """Recode and sum the flows whose ``column`` holds the pattern; the others pass unchanged."""
    hit = is_local_authority(F.col(column), pattern)
    found = lookup.attach(flows.withColumn("__hit", hit), column, {TO: "__new_code"}, "left")
    new = F.coalesce(F.when(F.col("__hit"), F.col("__new_code")), column).alias(column)
    recoded = found.select(*[new if c == column else F.col(c) for c in flows.columns], "__hit")
    return sum_or_pass(recoded, measure, ~F.col("__hit")).drop("__hit")


def _known_codes(lookup: Lookup) -> Lookup:
    """The lookup with its targets as further codes, which have no new code."""
    targets = lookup.frame.select(F.col(TO).alias(FROM), F.lit(None).cast("string").alias(TO))
    known = lookup.frame.select(FROM, TO).unionByName(targets).groupBy(FROM).agg(F.max(TO).alias(TO))
    return Lookup(known.withColumn("known", F.lit(True)), FROM, lookup.max_bytes)


def _new_ends(marked: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    ends = {
        "gss_in": F.coalesce(F.when(F.col("__in"), F.col("__new_in")), "gss_in").alias("gss_in"),
        "gss_out": F.coalesce(F.when(F.col("__out"), F.col("__new_out")), "gss_out").alias("gss_out"),
    }
    return marked.select(*[ends.get(c, F.col(c)) for c in columns], "__out", *more)


def recode_both_ends(
    flows: DataFrame,
    lookup: Lookup,
    measure: str = "value",
    pattern: str = LOCAL_AUTHORITY_PATTERN,
    unique_keys: bool = False,
) -> DataFrame:
    """``recode_end`` on gss_in and then on gss_out, with one shuffle in place of two.

    Sums of sums are sums, so a flow that either step would aggregate goes
    through a single aggregation over its final codes. Flows only the first
    step sums must not merge with flows the second one sums, hence the flag in
    the key; flows neither step touches pass unchanged. All of them come from
    one scan and share one shuffle.

    Where the caller knows that no key repeats (``unique_keys``), a flow can
    only merge when one of its codes is an old or a new code of the lookup,
    so just those flows are shuffled, for a second scan of the others.
    """
    columns = flows.columns
    hit_in, hit_out = (is_local_authority(F.col(c), pattern) for c in ("gss_in", "gss_out"))
    marked = flows.withColumns({"__in": hit_in, "__out": hit_out})
    touched = F.col("__in") | F.col("__out")
    if not unique_keys:
        found = lookup.attach(marked, "gss_in", {TO: "__new_in"}, "left")
        found = lookup.attach(found, "gss_out", {TO: "__new_out"}, "left")
        ends = _new_ends(found, columns, touched.alias("__touched"))
        return sum_or_pass(ends, measure, ~F.col("__touched")).select(*columns)
    known = _known_codes(lookup)
    found = known.attach(marked, "gss_in", {TO: "__new_in", "known": "__known_in"}, "left")
    found = known.attach(found, "gss_out", {TO: "__new_out", "known": "__known_out"}, "left")
    can_merge = touched & F.coalesce("__known_in", "__known_out", F.lit(False))
    summed = aggregate_measures(_new_ends(found.where(can_merge), columns), [measure])
    kept = found.where(~can_merge & (~touched | all_present([c for c in columns if c != measure])))
    alone = F.when(touched, F.coalesce(measure, F.lit(0))).otherwise(F.col(measure)).alias(measure)
    return summed.select(*columns).unionByName(kept.select(*[alone if c == measure else F.col(c) for c in columns]))
