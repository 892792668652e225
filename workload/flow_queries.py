"""Gross, aggregated and net flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.functions.numbers import round_half_even
from odflux.operators import flows as ops
from odflux.operators.lookups import map_both_ends as map_ends
from workload.registry import query
from workload.sql import areas, gross, with_tables
from workload.standin import flows_long, geographies, lookup_for

AREAS = {
    "region_od": areas("region_lookup", "region_code"),
    "country_od": areas("country_lookup", "country_code"),
    "inner_outer_od": areas("inner_outer_lookup", "io_london"),
}
PAIRS = {"pairs": "SELECT gss_in, gss_out, age, year, sum(value) AS value FROM flows GROUP BY 1, 2, 3, 4"}


def inflow_sql(end: str, measure: str) -> str:
    return f"SELECT {end} AS gss_code, year, sum(value) AS {measure} FROM flows GROUP BY {end}, year"


@query("inflow_by_area", with_tables(inflow_sql("gss_in", "inflow")))
def inflow_by_area(spark: SparkSession, d: str) -> DataFrame:
    return ops.inflow_by_area(flows_long(spark, d))


@query("outflow_by_area", with_tables(inflow_sql("gss_out", "outflow")))
def outflow_by_area(spark: SparkSession, d: str) -> DataFrame:
    return ops.outflow_by_area(flows_long(spark, d))


@query(
    "outer_fill_join",
    with_tables(
        f"""SELECT coalesce(i.gss_code, o.gss_code) AS gss_code, coalesce(i.year, o.year) AS year,
                   coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow
            FROM ({inflow_sql("gss_in", "inflow")} HAVING gss_in LIKE 'E%') i
            FULL OUTER JOIN ({inflow_sql("gss_out", "outflow")} HAVING gss_out NOT LIKE 'E09%') o
              ON i.gss_code = o.gss_code AND i.year = o.year"""
    ),
)
def outer_fill_join(spark: SparkSession, d: str) -> DataFrame:
    flows = flows_long(spark, d)
    inflow = ops.inflow_by_area(flows.where(F.col("gss_in").startswith("E")))
    outflow = ops.outflow_by_area(flows.where(~F.col("gss_out").startswith("E09")))
    return ops.outer_fill(inflow, outflow)


@query("gross_flows", with_tables(gross("flows")))
def gross_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.gross_flows(flows_long(spark, d))


@query("round_half_even", with_tables("SELECT gss_out, gss_in, sex, year, age, round_even(value / 4, 1) AS value FROM flows"))
def round_half_even_query(spark: SparkSession, d: str) -> DataFrame:
    return flows_long(spark, d).withColumn("value", round_half_even(F.col("value") / 4, 1))


@query(
    "map_both_ends",
    with_tables(
        """SELECT gss_out, gss_in, sex, year, age, value, i.region_code AS area_in, o.region_code AS area_out
           FROM flows JOIN region_lookup i ON gss_in = i.lad_code JOIN region_lookup o ON gss_out = o.lad_code"""
    ),
)
def map_both_ends(spark: SparkSession, d: str) -> DataFrame:
    return map_ends(flows_long(spark, d), lookup_for(spark, d, "region_code"), "region_code")


def _areas(spark: SparkSession, d: str, target: str) -> DataFrame:
    return ops.aggregate_areas(flows_long(spark, d), lookup_for(spark, d, target), target)


@query("aggregate_to_region", with_tables(AREAS["region_od"]))
def aggregate_to_region(spark: SparkSession, d: str) -> DataFrame:
    return _areas(spark, d, "region_code")


@query("aggregate_to_country", with_tables(AREAS["country_od"]))
def aggregate_to_country(spark: SparkSession, d: str) -> DataFrame:
    return _areas(spark, d, "country_code")


@query("aggregate_to_inner_outer", with_tables(AREAS["inner_outer_od"]))
def aggregate_to_inner_outer(spark: SparkSession, d: str) -> DataFrame:
    return _areas(spark, d, "io_london")


@query(
    "od_by_geography",
    with_tables(
        "SELECT 'region' AS geography, * FROM region_od UNION ALL SELECT 'country', * FROM country_od "
        "UNION ALL SELECT 'inner_outer', * FROM inner_outer_od",
        **AREAS,
    ),
)
def od_by_geography(spark: SparkSession, d: str) -> DataFrame:
    return ops.od_by_geography(flows_long(spark, d), geographies(spark, d))


@query("region_gross_flows", with_tables(gross("region_od"), **AREAS))
def region_gross_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.gross_flows(_areas(spark, d, "region_code"))


@query("country_gross_flows", with_tables(gross("country_od"), **AREAS))
def country_gross_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.gross_flows(_areas(spark, d, "country_code"))


@query("inner_outer_gross_flows", with_tables(gross("inner_outer_od"), **AREAS))
def inner_outer_gross_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.gross_flows(_areas(spark, d, "io_london"))


@query(
    "final_gross_flows",
    with_tables(
        f"""{gross("country_od", "gss_code = 'E92000001'")} UNION ALL {gross("region_od")}
            UNION ALL {gross("inner_outer_od", "gss_code <> 'other'")}""",
        **AREAS,
    ),
)
def final_gross_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.final_gross_flows(flows_long(spark, d), geographies(spark, d))


SWAPPED = """
    SELECT coalesce(i.gss_in, o.gss_out) AS gss_in, coalesce(i.gss_out, o.gss_in) AS gss_out,
           coalesce(i.age, o.age) AS age, coalesce(i.year, o.year) AS year,
           coalesce(i.value, 0) AS inflow, coalesce(o.value, 0) AS outflow
    FROM pairs i FULL OUTER JOIN pairs o
      ON i.gss_in = o.gss_out AND i.gss_out = o.gss_in AND i.age = o.age AND i.year = o.year"""


def pair_sums(spark: SparkSession, d: str) -> DataFrame:
    return ops.sum_value(flows_long(spark, d), "gss_in", "gss_out", "age", "year")


@query("flows_outer_swapped", with_tables(SWAPPED, **PAIRS))
def flows_outer_swapped(spark: SparkSession, d: str) -> DataFrame:
    return ops.flows_outer_swapped(pair_sums(spark, d))


@query("net_flows", with_tables(f"SELECT *, inflow - outflow AS netflow FROM ({SWAPPED})", **PAIRS))
def net_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.net_flows(pair_sums(spark, d))
