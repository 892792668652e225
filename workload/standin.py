"""Flow tables, lookups, code changes and pages derived from the given tables.

Customers' nations are origins, suppliers' nations destinations, line numbers
ages, return flags sexes and ship years years; quantities are the flow values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.operators.flows import Geography, reporting_geographies
from odflux.operators.reshape import map_sex
from odflux.sources.readers import read_parquet

# Stand-ins for the cut-over year, the oldest child and the two vintages.
CUTOVER = 1998
CHILD = 3
OLD_VINTAGE, NEW_VINTAGE = 2021, 2023
AGES = range(1, 8)
LINK_BASE = "https://example.org"
LINK_TEXT = "the"

CODE_PREFIX = {0: "E09", 1: "E06", 2: "E07", 3: "W06", 4: "S12"}
REGION_CODE = {0: "E12000007", 1: "E12000001", 2: "E12000002", 3: "W92000004"}
COUNTRY_CODE = {0: "E92000001", 1: "E92000001", 2: "E92000001", 3: "W92000004", 4: "S92000003"}

CHANGES_SQL = """
SELECT * FROM (VALUES
  ('E06000001', 'Nation 1', 'E06000101', 'Nation 101', 2021, false, false),
  ('E06000101', 'Nation 101', 'E06000201', 'Nation 201', 2023, false, false),
  ('E07000002', 'Nation 2', 'E06000301', 'Nation 301', 2023, false, true),
  ('E07000007', 'Nation 7', 'E06000301', 'Nation 301', 2023, false, true),
  ('E06000006', 'Nation 6', 'E06000401', 'Nation 401', 2022, true, false),
  ('E06000006', 'Nation 6', 'E06000402', 'Nation 402', 2022, true, false),
  ('W06000003', 'Nation 3', 'W06000003', 'Nation 3', 2022, false, false),
  ('E06000011', 'Nation 11', 'E06000501', 'Nation 501', 2019, false, false),
  ('E06000016', 'Nation 16', 'E06000601', 'Nation 601', 2024, false, false)
) AS t(changed_from_code, changed_from_name, changed_to_code, changed_to_name, "year", split, "merge")
"""


# Columns used of each table; a stated schema saves the job that infers one.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def case(column: str, values: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {key} THEN '{value}'" for key, value in values.items())
    return f"CASE {column} {whens} END"


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area code of each nation."""
    code = f"{case('n_regionkey', CODE_PREFIX)} || lpad(CAST(n_nationkey AS STRING), 6, '0') AS code"
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_regionkey", "n_name", code)


def od_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with raw sex codes (F, M, X), one row per key.

    Orders meet customers first, so line items are shuffled only with tables
    that grow too; nation keys are summed before they become codes.
    """
    origin = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    items = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(origin, F.expr("l_orderkey = o_orderkey"))
        .selectExpr("c_nationkey", "s_nationkey", "l_returnflag", "year(l_shipdate) AS year", "l_linenumber AS age", "l_quantity")
    )
    summed = items.groupBy("c_nationkey", "s_nationkey", "l_returnflag", "year", "age").agg(
        F.sum("l_quantity").alias("value")
    )
    codes = nations(spark, sf_dir)
    return (
        summed.join(codes.selectExpr("n_nationkey AS c_nationkey", "code AS gss_out"), "c_nationkey")
        .join(codes.selectExpr("n_nationkey AS s_nationkey", "code AS gss_in"), "s_nationkey")
        .selectExpr(
            "gss_out",
            "gss_in",
            "CASE l_returnflag WHEN 'A' THEN 'F' WHEN 'R' THEN 'M' ELSE 'X' END AS sex",
            "year",
            "age",
            "value",
        )
    )


def flows_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with sex labels; the unmapped code is missing."""
    return od_flows(spark, sf_dir).withColumn("sex", map_sex(F.col("sex")))


def sheet(spark: SparkSession, sf_dir: str, fill: bool = True) -> DataFrame:
    """Yearly sheet: one row per pair, sex and year, one column per age."""
    cells = []
    for age in AGES:
        cell = f"sum(value) FILTER (WHERE age = {age})"
        cells.append(F.expr(f"coalesce({cell}, 0.0D)" if fill else cell).alias(f"Age_{age}"))
    flows = od_flows(spark, sf_dir).selectExpr(
        "gss_out AS outla", "gss_in AS inla", "sex AS Sex", "year AS Year", "age", "value"
    )
    return flows.groupBy("outla", "inla", "Sex", "Year").agg(*cells)


def new_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheet(spark, sf_dir).where(F.col("Year") >= CUTOVER)


def lad_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target code of each area; a missing target means no row in that lookup."""
    return nations(spark, sf_dir).selectExpr(
        "code AS lad_code",
        f"{case('n_regionkey', REGION_CODE)} AS region_code",
        f"{case('n_regionkey', COUNTRY_CODE)} AS country_code",
        "CASE WHEN n_regionkey <> 0 THEN 'other' WHEN n_nationkey % 2 = 0 THEN 'E13000001' "
        "ELSE 'E13000002' END AS io_london",
    )


def lookup_for(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    return lad_lookup(spark, sf_dir).select("lad_code", target).where(F.col(target).isNotNull())


def geographies(spark: SparkSession, sf_dir: str) -> list[Geography]:
    return reporting_geographies(
        *[lookup_for(spark, sf_dir, target) for target in ("country_code", "region_code", "io_london")]
    )


def child_geographies(spark: SparkSession, sf_dir: str) -> tuple[Geography, Geography]:
    _, region, inner_outer = geographies(spark, sf_dir)
    return region, inner_outer


def code_changes(spark: SparkSession) -> DataFrame:
    return spark.sql(CHANGES_SQL.replace('"', "`"))


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("gss_name"))
