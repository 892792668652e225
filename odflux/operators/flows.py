"""Gross, aggregated and net flows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflux.functions import codes
from odflux.functions.nulls import differs, sum_or_zero, with_keys
from odflux.functions.numbers import round_half_even
from odflux.operators.lookups import Lookup, LookupSize, map_both_ends
from odflux.operators.reshape import swap_endpoints, with_netflow


def sum_value(df: DataFrame, *keys: str) -> DataFrame:
    """Sum of ``value`` per group; rows with a missing key are left out."""
    return with_keys(df, keys).groupBy(*keys).agg(sum_or_zero("value").alias("value"))


def inflow_by_area(flows: DataFrame) -> DataFrame:
    sums = sum_value(flows, "gss_in", "year")
    return sums.select(F.col("gss_in").alias("gss_code"), "year", F.col("value").alias("inflow"))


def outflow_by_area(flows: DataFrame) -> DataFrame:
    sums = sum_value(flows, "gss_out", "year")
    return sums.select(F.col("gss_out").alias("gss_code"), "year", F.col("value").alias("outflow"))


def outer_fill(inflow: DataFrame, outflow: DataFrame) -> DataFrame:
    """Full outer join of two area tables, the missing measure 0."""
    return inflow.join(outflow, ["gss_code", "year"], "full_outer").fillna(0, ["inflow", "outflow"])


def _gross(flows: DataFrame, decimals: int, ends: Mapping[str, str], *keys: str) -> DataFrame:
    """Inflow and outflow per area in one pass: every flow is counted once at each end."""
    both = flows.select(
        *keys,
        "value",
        *[F.col(column).alias(measure) for column, measure in ends.items()],
    ).unpivot([*keys, "value"], ["inflow", "outflow"], "measure", "gss_code")
    measures = [
        round_half_even(sum_or_zero(F.when(F.col("measure") == m, F.col("value"))), decimals).alias(m)
        for m in ("inflow", "outflow")
    ]
    return with_keys(both, ["gss_code", *keys]).groupBy("gss_code", *keys).agg(*measures)


def gross_flows(flows: DataFrame, decimals: int = 1) -> DataFrame:
    """Total inflow and outflow of each area and year."""
    gross = _gross(flows, decimals, {"gss_in": "inflow", "gss_out": "outflow"}, "year")
    return gross.select("gss_code", "year", "inflow", "outflow")


def aggregate_areas(
    flows: DataFrame, lookup: Lookup | DataFrame, target: str, key: str = "lad_code", drop_self: bool = False
) -> DataFrame:
    """Flows between the areas that ``target`` names, moves inside an area included."""
    mapped = map_both_ends(flows.select("gss_in", "gss_out", "year", "value"), lookup, target, key)
    areas = mapped.select(F.col("area_in").alias("gss_in"), F.col("area_out").alias("gss_out"), "year", "value")
    if drop_self:
        areas = areas.where(differs(F.col("gss_in"), F.col("gss_out")))
    return sum_value(areas, "gss_in", "gss_out", "year")


@dataclass(frozen=True)
class Geography:
    """A named grouping of local areas, and the codes of it to report."""

    name: str
    lookup: DataFrame
    target: str
    key: str = "lad_code"
    only: str | None = None
    without: str | None = None

    def reported(self, geography: Column, code: Column) -> Column:
        wanted = F.lit(True)
        if self.only is not None:
            wanted = wanted & (code == self.only)
        if self.without is not None:
            wanted = wanted & differs(code, F.lit(self.without))
        return (geography == self.name) & wanted


def reporting_geographies(country: DataFrame, region: DataFrame, inner_outer: DataFrame) -> list[Geography]:
    """England, every region, and inner and outer London."""
    return [
        Geography("country", country, "country_code", only=codes.ENGLAND),
        Geography("region", region, "region_code"),
        Geography("inner_outer", inner_outer, "io_london", without=codes.NOT_LONDON),
    ]


def stack_lookups(geographies: list[Geography]) -> Lookup:
    """All lookups as one table (geography, lad_code, area)."""
    parts = [
        g.lookup.select(
            F.lit(g.name).alias("geography"), F.col(g.key).alias("lad_code"), F.col(g.target).alias("area")
        )
        for g in geographies
    ]
    return Lookup(reduce(DataFrame.unionByName, parts), ["geography", "lad_code"]).warn_if_not_unique()


def alike_areas(stacked: Lookup) -> Lookup:
    """One local area to stand for all that belong to the same areas.

    Its size is bounded by the stacked lookup's, so it is not measured again.
    """
    bound = LookupSize(stacked.size.rows, 2 * stacked.size.bytes)
    groups = F.sort_array(F.collect_list(F.struct("geography", "area")))
    members = stacked.frame.groupBy("lad_code").agg(groups.alias("belongs_to"))
    first = Lookup(members.groupBy("belongs_to").agg(F.min("lad_code").alias("alike")), "belongs_to", stacked.max_bytes)
    first.size = bound
    alike = Lookup(first.attach(members, "belongs_to", {"alike": "alike"}).drop("belongs_to"), "lad_code", stacked.max_bytes)
    alike.size = bound
    return alike


def map_to_geographies(flows: DataFrame, stacked: Lookup) -> DataFrame:
    """Both ends in every geography; the flows are repeated once per geography."""
    mapped = stacked.keyed_by("lad_code").attach(flows, "gss_in", {"geography": "geography", "area": "area_in"})
    mapped = stacked.attach(mapped, ["geography", "gss_out"], {"area": "area_out"})
    return mapped.select(
        "geography", F.col("area_in").alias("gss_in"), F.col("area_out").alias("gss_out"), "year", "value"
    )


def od_by_geography(flows: DataFrame, geographies: list[Geography]) -> DataFrame:
    """``aggregate_areas`` for several geographies from one scan.

    Local areas that agree in every geography are summed as one first, so
    only the few sums that remain are repeated per geography.
    """
    stacked = stack_lookups(geographies)
    alike = map_both_ends(flows.select("gss_in", "gss_out", "year", "value"), alike_areas(stacked), "alike")
    ends = alike.select(F.col("area_in").alias("gss_in"), F.col("area_out").alias("gss_out"), "year", "value")
    mapped = map_to_geographies(sum_value(ends, "gss_in", "gss_out", "year"), stacked)
    return sum_value(mapped, "geography", "gss_in", "gss_out", "year")


def gross_by_geography(od: DataFrame, geographies: list[Geography], decimals: int = 1) -> DataFrame:
    """Gross flows of the reported areas of ``od_by_geography``."""
    gross = _gross(od, decimals, {"gss_in": "inflow", "gss_out": "outflow"}, "geography", "year")
    reported = [g.reported(F.col("geography"), F.col("gss_code")) for g in geographies]
    return gross.where(reduce(lambda a, b: a | b, reported)).select("gss_code", "year", "inflow", "outflow")


def final_gross_flows(flows: DataFrame, geographies: list[Geography], decimals: int = 1) -> DataFrame:
    """Reported gross flows of all geographies from one scan."""
    return gross_by_geography(od_by_geography(flows, geographies), geographies, decimals)


def flows_outer_swapped(flows: DataFrame) -> DataFrame:
    """Full outer join of the flows with themselves turned round, missing measures 0.

    Repeated keys are summed first, so a pair meets its reverse once; the join
    uses the partitioning of the sums.
    """
    keys = ["gss_in", "gss_out", "age", "year"]
    once = flows.groupBy(*keys).agg(F.sum("value").alias("value"))
    inflow = once.select(*keys, F.col("value").alias("inflow"))
    outflow = swap_endpoints(once)
    return inflow.join(outflow, keys, "full_outer").fillna(0, ["inflow", "outflow"])


def net_flows(flows: DataFrame) -> DataFrame:
    """Inflow, outflow and their difference for every ordered pair of areas.

    Each flow is laid down twice, once per orientation, and summed: one scan
    and one shuffle in place of a self-join.
    """
    value = F.col("value")
    missing = F.lit(None).cast(flows.schema["value"].dataType)

    def side(gss_in: str, gss_out: str, inflow: Column, outflow: Column) -> Column:
        return F.struct(
            F.col(gss_in).alias("gss_in"),
            F.col(gss_out).alias("gss_out"),
            inflow.alias("inflow"),
            outflow.alias("outflow"),
        )

    sides = F.array(side("gss_in", "gss_out", value, missing), side("gss_out", "gss_in", missing, value))
    both = flows.select("age", "year", F.inline(sides))
    summed = both.groupBy("gss_in", "gss_out", "age", "year").agg(
        sum_or_zero("inflow").alias("inflow"), sum_or_zero("outflow").alias("outflow")
    )
    return with_netflow(summed)
