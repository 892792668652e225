"""Children's flows: pairs, totals, London, net and wide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odflux.operators import children as ops
from workload.registry import query
from workload.sql import areas, with_tables
from workload.standin import CHILD, child_geographies, flows_long, lookup_for

KEYS = "gss_in, gss_out, age, year, value"
CHILD_FLOWS = f"age <= {CHILD}"
TABLES = {
    "pairs": areas("region_lookup", "region_code", "age, year", CHILD_FLOWS),
    "within_london": areas(
        "inner_outer_lookup",
        "io_london",
        "age, year",
        f"{CHILD_FLOWS} AND i.io_london IN ('E13000001', 'E13000002') AND o.io_london IN ('E13000001', 'E13000002')",
    ),
    "london": f"""SELECT 'E12000007' AS gss_in, gss_out, age, year, sum(value) AS value FROM flows
                  WHERE {CHILD_FLOWS} AND starts_with(gss_in, 'E09') GROUP BY gss_out, age, year""",
    "total_in": "SELECT gss_in, 'total' AS gss_out, age, year, sum(value) AS value FROM pairs GROUP BY gss_in, age, year",
    "total_out": "SELECT 'total' AS gss_in, gss_out, age, year, sum(value) AS value FROM pairs GROUP BY gss_out, age, year",
}


def union(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT {KEYS} FROM {name}" for name in names)


TABLES["all_od"] = union("pairs", "within_london", "london", "total_in", "total_out")
# Every flow in both orientations, summed.
TABLES["net"] = """
    SELECT gss_in, gss_out, age, year, sum(i) AS inflow, sum(o) AS outflow, sum(i) - sum(o) AS netflow
    FROM (SELECT gss_in, gss_out, age, year, value AS i, 0 AS o FROM all_od
          UNION ALL SELECT gss_out, gss_in, age, year, 0, value FROM all_od)
    GROUP BY gss_in, gss_out, age, year"""


def region_pairs(spark: SparkSession, d: str) -> DataFrame:
    return ops.region_flows(flows_long(spark, d), lookup_for(spark, d, "region_code"), "region_code", max_age=CHILD)


@query("children_region_flows", with_tables(union("pairs"), **TABLES))
def children_region_flows(spark: SparkSession, d: str) -> DataFrame:
    return region_pairs(spark, d)


@query("total_inflow", with_tables(union("total_in"), **TABLES))
def total_inflow(spark: SparkSession, d: str) -> DataFrame:
    return ops.total_inflow(region_pairs(spark, d))


@query("total_outflow", with_tables(union("total_out"), **TABLES))
def total_outflow(spark: SparkSession, d: str) -> DataFrame:
    return ops.total_outflow(region_pairs(spark, d))


@query("pair_and_totals", with_tables(union("pairs", "total_in", "total_out"), **TABLES))
def pair_and_totals(spark: SparkSession, d: str) -> DataFrame:
    return ops.pair_and_totals(region_pairs(spark, d))


@query("inner_outer_children_flows", with_tables(union("within_london"), **TABLES))
def inner_outer_children_flows(spark: SparkSession, d: str) -> DataFrame:
    lookup = lookup_for(spark, d, "io_london")
    return ops.inner_outer_flows(flows_long(spark, d), lookup, "io_london", max_age=CHILD)


@query("london_rollup", with_tables(union("london"), **TABLES))
def london_rollup(spark: SparkSession, d: str) -> DataFrame:
    return ops.london_rollup(flows_long(spark, d), CHILD)


@query("all_od_flows", with_tables(union("all_od"), **TABLES))
def all_od_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.all_od_flows(flows_long(spark, d), *child_geographies(spark, d), CHILD)


@query("children_net_flows", with_tables("SELECT * FROM net", **TABLES))
def children_net_flows(spark: SparkSession, d: str) -> DataFrame:
    return ops.children_net(flows_long(spark, d), *child_geographies(spark, d), CHILD)


@query(
    "children_net_wide",
    with_tables(
        "SELECT gss_in AS gss_code, gss_out AS origin_destination_code, direction, year, "
        + ", ".join(f'coalesce(avg(value) FILTER (WHERE age = {a}), 0) AS "{a}"' for a in range(1, CHILD + 1))
        + """ FROM (SELECT gss_in, gss_out, age, year, unnest(['inflow', 'outflow', 'netflow']) AS direction,
                          unnest([inflow, outflow, netflow]) AS value FROM net)
              GROUP BY gss_in, gss_out, direction, year""",
        **TABLES,
    ),
)
def children_net_wide(spark: SparkSession, d: str) -> DataFrame:
    net = ops.children_net(flows_long(spark, d), *child_geographies(spark, d), CHILD)
    return ops.children_net_wide(net, range(1, CHILD + 1))
