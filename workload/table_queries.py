"""Reshaping, filters, unions and counts over the flow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.operators import audit, filters, reshape, sets
from odflux.operators.flows import gross_flows
from workload import standin
from workload.registry import query
from workload.sql import UNPIVOTED, gross, with_tables
from workload.standin import AGES, CUTOVER, od_flows, flows_long

GROSS = gross("flows")
AGE_CELLS = ", ".join(f'"Age_{a}"' for a in AGES)


@query(
    "lowercase_headers",
    with_tables(
        'SELECT outla, inla, "Sex" AS sex, "Year" AS year, '
        + ", ".join(f'"Age_{a}" AS age_{a}' for a in AGES)
        + " FROM sheet"
    ),
)
def lowercase_headers(spark: SparkSession, d: str) -> DataFrame:
    return reshape.lowercase_headers(standin.sheet(spark, d))


@query(
    "rename_keys",
    with_tables(
        f'SELECT outla AS gss_out, inla AS gss_in, "Sex" AS sex, "Year" AS year, {AGE_CELLS} FROM sheet'
    ),
)
def rename_keys(spark: SparkSession, d: str) -> DataFrame:
    return reshape.rename_keys(standin.sheet(spark, d))


@query("unpivot_age", with_tables(UNPIVOTED))
def unpivot_age(spark: SparkSession, d: str) -> DataFrame:
    return reshape.unpivot_age(standin.new_sheet(spark, d))


@query("parse_age", with_tables("SELECT 'Age_' || age AS label, age, sum(value) AS value FROM flows GROUP BY age"))
def parse_age(spark: SparkSession, d: str) -> DataFrame:
    sheet = standin.sheet(spark, d)
    cells = sheet.unpivot(["outla", "inla"], [f"Age_{a}" for a in AGES], "label", "value")
    summed = cells.groupBy("label").agg(F.sum("value").alias("value"))
    return summed.withColumn("age", reshape.parse_age(F.col("label")))


@query("map_sex", with_tables("SELECT * FROM flows"))
def map_sex(spark: SparkSession, d: str) -> DataFrame:
    return od_flows(spark, d).withColumn("sex", reshape.map_sex(F.col("sex")))


@query("cast_year", with_tables("SELECT outla, inla, \"Sex\", \"Year\" AS year FROM sheet"))
def cast_year(spark: SparkSession, d: str) -> DataFrame:
    text = standin.sheet(spark, d).withColumn("Year", F.col("Year").cast("string"))
    return text.select("outla", "inla", "Sex", reshape.cast_year(F.col("Year")).alias("year"))


@query(
    "pivot_age_wide",
    with_tables(
        "SELECT gss_in AS gss_code, gss_out AS origin_destination_code, 'inflow' AS direction, year, "
        + ", ".join(f'coalesce(avg(value) FILTER (WHERE age = {a}), 0) AS "{a}"' for a in AGES)
        + " FROM flows GROUP BY gss_in, gss_out, year"
    ),
)
def pivot_age_wide(spark: SparkSession, d: str) -> DataFrame:
    named = flows_long(spark, d).withColumnsRenamed({"gss_in": "gss_code", "gss_out": "origin_destination_code"})
    return reshape.pivot_age_wide(reshape.constant_column(named, "direction", "inflow"), AGES)


@query(
    "unpivot_direction",
    with_tables(
        f"""SELECT gss_code, year, unnest(['inflow', 'outflow', 'netflow']) AS direction,
                   unnest([inflow, outflow, inflow - outflow]) AS value FROM ({GROSS})"""
    ),
)
def unpivot_direction(spark: SparkSession, d: str) -> DataFrame:
    gross = reshape.with_netflow(gross_flows(flows_long(spark, d)))
    return reshape.unpivot_direction(gross, ids=["gss_code", "year"])


@query(
    "swap_endpoints",
    with_tables("SELECT gss_out AS gss_in, gss_in AS gss_out, sex, year, age, value AS outflow FROM flows"),
)
def swap_endpoints(spark: SparkSession, d: str) -> DataFrame:
    return reshape.swap_endpoints(flows_long(spark, d))


@query(
    "constant_column",
    with_tables("SELECT gss_in, age, year, sum(value) AS value, 'total' AS gss_out FROM flows GROUP BY gss_in, age, year"),
)
def constant_column(spark: SparkSession, d: str) -> DataFrame:
    sums = flows_long(spark, d).groupBy("gss_in", "age", "year").agg(F.sum("value").alias("value"))
    return reshape.constant_column(sums, "gss_out", "total")


@query("restore_column_order", with_tables("SELECT gss_out, gss_in, sex, year, age, value FROM flows"))
def restore_column_order(spark: SparkSession, d: str) -> DataFrame:
    flows = flows_long(spark, d)
    return reshape.restore_column_order(flows.select(*reversed(flows.columns)), flows)


@query("derived_measure", with_tables(f"SELECT *, inflow - outflow AS netflow FROM ({GROSS})"))
def derived_measure(spark: SparkSession, d: str) -> DataFrame:
    return reshape.with_netflow(gross_flows(flows_long(spark, d)))


@query("drop_column", with_tables("SELECT gss_out, gss_in, year, age, value FROM flows"))
def drop_column(spark: SparkSession, d: str) -> DataFrame:
    return reshape.drop_columns(flows_long(spark, d), "sex")


@query(
    "drop_any_null",
    with_tables("SELECT * FROM sheet_gaps WHERE " + " AND ".join(f'"Age_{a}" IS NOT NULL' for a in AGES)),
)
def drop_any_null(spark: SparkSession, d: str) -> DataFrame:
    return filters.drop_any_null(standin.sheet(spark, d, fill=False))


@query("year_before", with_tables(f"SELECT * FROM flows WHERE year < {CUTOVER}"))
def year_before(spark: SparkSession, d: str) -> DataFrame:
    return filters.year_before(flows_long(spark, d), CUTOVER)


@query("year_in_set", with_tables("SELECT * FROM flows WHERE year IN (1996, 1998)"))
def year_in_set(spark: SparkSession, d: str) -> DataFrame:
    return filters.year_in_set(flows_long(spark, d), [1996, 1998])


@query(
    "code_pattern_split",
    with_tables("SELECT *, CASE WHEN regexp_matches(gss_in, 'E0|W0') THEN 'match' ELSE 'rest' END AS branch FROM flows"),
)
def code_pattern_split(spark: SparkSession, d: str) -> DataFrame:
    hit, rest = filters.code_pattern_split(flows_long(spark, d), "gss_in")
    return hit.withColumn("branch", F.lit("match")).unionByName(rest.withColumn("branch", F.lit("rest")))


@query("drop_self_flows", with_tables("SELECT * FROM flows WHERE gss_in IS DISTINCT FROM gss_out"))
def drop_self_flows(spark: SparkSession, d: str) -> DataFrame:
    return filters.drop_self_flows(flows_long(spark, d))


@query(
    "drop_zero_values",
    with_tables(
        """SELECT gss_out, gss_in, year, CASE WHEN age = 1 THEN NULL ELSE value - 25 END AS value FROM flows
           WHERE age = 1 OR value <> 25"""
    ),
)
def drop_zero_values(spark: SparkSession, d: str) -> DataFrame:
    value = F.when(F.col("age") != 1, F.col("value") - 25)
    return filters.drop_zero_values(flows_long(spark, d).select("gss_out", "gss_in", "year", value.alias("value")))


@query("age_at_most", with_tables(f"SELECT * FROM flows WHERE age <= {standin.CHILD}"))
def age_at_most(spark: SparkSession, d: str) -> DataFrame:
    return filters.age_at_most(flows_long(spark, d), standin.CHILD)


@query(
    "both_ends_in_set",
    with_tables("SELECT * FROM flows WHERE gss_in IN ('E09000000', 'E09000005') AND gss_out IN ('E09000000', 'E09000005')"),
)
def both_ends_in_set(spark: SparkSession, d: str) -> DataFrame:
    return filters.both_ends_in_set(flows_long(spark, d), ("E09000000", "E09000005"))


@query("code_prefix", with_tables("SELECT * FROM flows WHERE starts_with(gss_in, 'E09')"))
def code_prefix(spark: SparkSession, d: str) -> DataFrame:
    return filters.code_prefix(flows_long(spark, d))


@query("code_equals", with_tables(f"SELECT * FROM ({GROSS}) WHERE gss_code = 'E09000000'"))
def code_equals(spark: SparkSession, d: str) -> DataFrame:
    return filters.code_equals(gross_flows(flows_long(spark, d)), "E09000000")


@query("code_not_equals", with_tables(f"SELECT * FROM ({GROSS}) WHERE gss_code <> 'E09000000'"))
def code_not_equals(spark: SparkSession, d: str) -> DataFrame:
    return filters.code_not_equals(gross_flows(flows_long(spark, d)), "E09000000")


@query(
    "union_by_name_superset",
    with_tables(
        f"""SELECT gss_out, gss_in, sex, year, age, value FROM flows WHERE year < {CUTOVER}
            UNION ALL SELECT gss_out, gss_in, NULL, year, age, value FROM flows WHERE year >= {CUTOVER}"""
    ),
)
def union_by_name_superset(spark: SparkSession, d: str) -> DataFrame:
    flows = flows_long(spark, d)
    later = flows.where(F.col("year") >= CUTOVER).drop("sex").withColumn("value", F.col("value").cast("long"))
    return sets.union_by_name([filters.year_before(flows, CUTOVER), later])


@query("distinct_rows", with_tables("SELECT DISTINCT gss_out, gss_in, year FROM flows"))
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return sets.distinct_rows(flows_long(spark, d).select("gss_out", "gss_in", "year"))


@query("distinct_years", with_tables("SELECT DISTINCT year FROM flows"))
def distinct_years(spark: SparkSession, d: str) -> DataFrame:
    return audit.distinct_years(flows_long(spark, d))


@query("sort_years", with_tables("SELECT year, sum(value) AS value FROM flows GROUP BY year ORDER BY year"))
def sort_years(spark: SparkSession, d: str) -> DataFrame:
    return audit.sort_years(flows_long(spark, d).groupBy("year").agg(F.sum("value").alias("value")))


@query("distinct_codes", with_tables("SELECT count(DISTINCT gss_in) AS n_codes FROM flows"))
def distinct_codes(spark: SparkSession, d: str) -> DataFrame:
    return audit.code_count(flows_long(spark, d), "gss_in")


@query("year_range", with_tables("SELECT min(year) AS first_year, max(year) AS last_year FROM flows"))
def year_range(spark: SparkSession, d: str) -> DataFrame:
    return audit.year_range(flows_long(spark, d))


@query("row_and_column_counts", with_tables("SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns FROM flows"))
def row_and_column_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.row_and_column_counts(flows_long(spark, d))


@query("preview", with_tables("SELECT * FROM od_flows ORDER BY gss_out, gss_in, sex, year, age LIMIT 5"))
def preview(spark: SparkSession, d: str) -> DataFrame:
    return audit.preview(od_flows(spark, d), ["gss_out", "gss_in", "sex", "year", "age"])
