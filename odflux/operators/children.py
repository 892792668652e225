"""Flows of children between regions, within London and in total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions import codes
from odflux.functions.nulls import all_present, sum_or_zero, with_keys
from odflux.operators.filters import age_at_most, both_ends_in_set, code_prefix
from odflux.operators.flows import Geography, alike_areas, net_flows, stack_lookups, sum_value
from odflux.operators.lookups import Lookup, map_both_ends
from odflux.operators.reshape import pivot_age_wide, unpivot_direction

# Fixed value: oldest age counted as a child.
CHILD_AGE = 15

OD_AGE_KEYS = ("gss_in", "gss_out", "age", "year")
REGION, INNER_OUTER, LONDON = "region", "inner_outer", "london"


def _children(flows: DataFrame, max_age: int) -> DataFrame:
    return age_at_most(flows, max_age).select(*OD_AGE_KEYS, "value")


def _mapped(flows: DataFrame, lookup: Lookup | DataFrame, target: str, key: str) -> DataFrame:
    mapped = map_both_ends(flows, lookup, target, key)
    return mapped.select(F.col("area_in").alias("gss_in"), F.col("area_out").alias("gss_out"), "age", "year", "value")


def region_flows(
    flows: DataFrame, lookup: Lookup | DataFrame, target: str, key: str = "lad_code", max_age: int = CHILD_AGE
) -> DataFrame:
    """Children's flows between regions by age and year; all years at once."""
    return sum_value(_mapped(_children(flows, max_age), lookup, target, key), *OD_AGE_KEYS)


def inner_outer_flows(
    flows: DataFrame, lookup: Lookup | DataFrame, target: str, key: str = "lad_code", max_age: int = CHILD_AGE
) -> DataFrame:
    """Children's flows between inner and outer London: mapped first, then selected."""
    mapped = _mapped(_children(flows, max_age), lookup, target, key)
    return sum_value(both_ends_in_set(mapped), *OD_AGE_KEYS)


def london_rollup(flows: DataFrame, max_age: int = CHILD_AGE) -> DataFrame:
    """Children's flows into all London boroughs from each local area, under London's region code."""
    into = code_prefix(_children(flows, max_age))
    return sum_value(into.withColumn("gss_in", F.lit(codes.LONDON_REGION)), *OD_AGE_KEYS)


def total_inflow(pairs: DataFrame) -> DataFrame:
    total = sum_value(pairs, "gss_in", "age", "year").withColumn("gss_out", F.lit(codes.TOTAL))
    return total.select(*OD_AGE_KEYS, "value")


def total_outflow(pairs: DataFrame) -> DataFrame:
    total = sum_value(pairs, "gss_out", "age", "year").withColumn("gss_in", F.lit(codes.TOTAL))
    return total.select(*OD_AGE_KEYS, "value")


def pair_and_totals(pairs: DataFrame) -> DataFrame:
    """Pairs, totals per destination and totals per origin, by grouping sets.

    Takes flows that are already one row per pair, so the expansion works on
    the small table. Rows with a missing key would not be told from totals.
    """
    gss_in, gss_out, age, year = (F.col(c) for c in OD_AGE_KEYS)
    sets = [[gss_in, gss_out, age, year], [gss_in, age, year], [gss_out, age, year]]
    grouped = (
        with_keys(pairs, OD_AGE_KEYS)
        .groupingSets(sets, *OD_AGE_KEYS)
        .agg(
            F.grouping("gss_in").alias("__no_in"),
            F.grouping("gss_out").alias("__no_out"),
            sum_or_zero("value").alias("value"),
        )
    )
    return grouped.select(
        F.when(F.col("__no_in") == 1, codes.TOTAL).otherwise(gss_in).alias("gss_in"),
        F.when(F.col("__no_out") == 1, codes.TOTAL).otherwise(gss_out).alias("gss_out"),
        "age",
        "year",
        "value",
    )


def children_branches(
    flows: DataFrame, region: Geography, inner_outer: Geography, max_age: int = CHILD_AGE
) -> DataFrame:
    """``region_flows``, ``inner_outer_flows`` and ``london_rollup`` from one scan, told apart by ``branch``.

    The scan sums over local areas alike in both geographies, and keeps the
    origin of flows into London boroughs; the sums are then laid out under
    each branch.
    """
    if len({region.name, inner_outer.name, LONDON}) < 3:
        raise ValueError(f"geographies need names of their own, other than {LONDON!r}")
    stacked = stack_lookups([region, inner_outer])
    alike = alike_areas(stacked)
    found = alike.attach(_children(flows, max_age), "gss_in", {"alike": "alike_in"}, "left")
    found = alike.attach(found, "gss_out", {"alike": "alike_out"}, "left")
    keys = ["alike_in", "alike_out", "london_in", "london_out", "age", "year"]
    into_london = codes.is_london_borough(F.col("gss_in"))
    local = found.withColumns(
        {
            "london_in": F.when(into_london, F.lit(codes.LONDON_REGION)),
            "london_out": F.when(into_london, F.col("gss_out")),
        }
    ).where(all_present(["london_in", "london_out"]) | all_present(["alike_in", "alike_out"]))
    sums = with_keys(local, ["age", "year"]).groupBy(*keys).agg(sum_or_zero("value").alias("value"))

    laid_out = sums.withColumn("branch", F.explode(F.array(*map(F.lit, (region.name, inner_outer.name, LONDON)))))
    mapped = stacked.attach(laid_out, ["branch", "alike_in"], {"area": "area_in"}, "left")
    mapped = stacked.attach(mapped, ["branch", "alike_out"], {"area": "area_out"}, "left")
    is_london = F.col("branch") == LONDON
    areas = mapped.select(
        "branch",
        F.when(is_london, F.col("london_in")).otherwise(F.col("area_in")).alias("gss_in"),
        F.when(is_london, F.col("london_out")).otherwise(F.col("area_out")).alias("gss_out"),
        "age",
        "year",
        "value",
    )
    within = (F.col("branch") != inner_outer.name) | codes.both_in(F.col("gss_in"), F.col("gss_out"))
    return sum_value(areas.where(within), "branch", *OD_AGE_KEYS)


def all_od_flows(
    flows: DataFrame, region: Geography, inner_outer: Geography, max_age: int = CHILD_AGE
) -> DataFrame:
    """Region pairs, inner and outer London, London as a whole, and region totals.

    The flow table is scanned once. The totals come from the region pairs by
    a second, small aggregation, where every other row keeps its own group.
    """
    branches = children_branches(flows, region, inner_outer, max_age)

    def ends(kind: str, gss_in: Column, gss_out: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), gss_in.alias("gss_in"), gss_out.alias("gss_out"))

    gss_in, gss_out, total = F.col("gss_in"), F.col("gss_out"), F.lit(codes.TOTAL)
    is_region = F.col("branch") == region.name
    laid_out = F.array(
        ends("pair", gss_in, gss_out),
        F.when(is_region, ends("in", gss_in, total)),
        F.when(is_region, ends("out", total, gss_out)),
    )
    rows = branches.select("branch", "age", "year", "value", F.inline(laid_out)).where(F.col("kind").isNotNull())
    summed = rows.groupBy("branch", "kind", *OD_AGE_KEYS).agg(sum_or_zero("value").alias("value"))
    return summed.select(*OD_AGE_KEYS, "value")


def children_net_wide(net: DataFrame, ages: Sequence[int] | None = None) -> DataFrame:
    """Net flows with one row per direction and one column per age."""
    named = net.withColumnsRenamed({"gss_in": "gss_code", "gss_out": "origin_destination_code"})
    return pivot_age_wide(unpivot_direction(named), ages)


def children_net(flows: DataFrame, region: Geography, inner_outer: Geography, max_age: int = CHILD_AGE) -> DataFrame:
    return net_flows(all_od_flows(flows, region, inner_outer, max_age))
