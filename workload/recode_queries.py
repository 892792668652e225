"""Recoding between vintages, its audits, and the combined series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.operators import audit, filters, recode
from odflux.operators.lookups import Lookup
from odflux.plans.series import combine_series as combine
from workload import standin
from workload.registry import query
from workload.sql import HISTORICAL, UNPIVOTED, recoded, with_tables
from workload.standin import AGES, CUTOVER, NEW_VINTAGE, OLD_VINTAGE, code_changes, flows_long

IN_FLOWS = "changed_from_code IN (SELECT gss_in FROM flows)"


def old_series(spark: SparkSession, d: str) -> DataFrame:
    return filters.year_before(flows_long(spark, d), CUTOVER)


def forward(spark: SparkSession) -> Lookup:
    return recode.as_recode_lookup(code_changes(spark), OLD_VINTAGE, NEW_VINTAGE)


def occurring(pairs: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    return filters.code_present(pairs, "changed_from_code", flows_long(spark, d), "gss_in")


# Arguments that differ from good ones, and the error they give.
REJECTED = (
    ("good", {}, "none"),
    ("recode_from_year=2007", {"recode_from_year": 2007}, "ValueError"),
    ("recode_to_year=2025", {"recode_to_year": 2025}, "ValueError"),
    ("recode_to_year=2025, database_year=2025", {"recode_to_year": 2025, "database_year": 2025}, "none"),
    ("recode_from_year='2021'", {"recode_from_year": "2021"}, "TypeError"),
    ("recode_from_year=None", {"recode_from_year": None}, "TypeError"),
    ("col_code=1", {"col_code": 1}, "TypeError"),
    ("col_code='area'", {"col_code": "area"}, "ValueError"),
    ("col_data=['value', 1]", {"col_data": ["value", 1]}, "TypeError"),
    ("col_data='sum'", {"col_data": "sum"}, "ValueError"),
    ("col_data='sex'", {"col_data": "sex"}, "ValueError"),
    ("col_data=['value', 'age']", {"col_data": ["value", "age"]}, "none"),
    ("fun='median'", {"fun": "median"}, "ValueError"),
    ("fun='mean'", {"fun": "mean"}, "none"),
    ("df=None", {"df": None}, "TypeError"),
)
REJECTED_ROWS = ", ".join("('" + text.replace("'", "''") + f"', '{error}')" for text, _, error in REJECTED)


@query(
    "recode_validate",
    with_tables(
        f"""SELECT arguments, error, CASE WHEN error = 'none' THEN n ELSE 0 END AS n_rows
            FROM (VALUES {REJECTED_ROWS}) v(arguments, error), (SELECT count(*) AS n FROM flows)"""
    ),
)
def recode_validate(spark: SparkSession, d: str) -> DataFrame:
    """Sets of arguments with the error they are rejected with, or the rows of the table that passes."""
    good = {"df": flows_long(spark, d), "col_code": "gss_in", "col_data": ["value"], "recode_from_year": OLD_VINTAGE, "recode_to_year": NEW_VINTAGE}
    outcomes = []
    for text, changed, _ in REJECTED:
        try:
            accepted, error = recode.check_recode(**(good | changed)), "none"
        except (TypeError, ValueError) as rejected:
            accepted, error = good["df"].limit(0), type(rejected).__name__
        outcomes.append(accepted.agg(F.lit(text).alias("arguments"), F.lit(error).alias("error"), F.count(F.lit(1)).alias("n_rows")))
    return reduce(DataFrame.unionByName, outcomes)


@query(
    "area_name_warning",
    with_tables(
        """SELECT 'label' AS column_name, count(*) AS n_rows
           FROM customer JOIN nations ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'"""
    ),
)
def area_name_warning(spark: SparkSession, d: str) -> DataFrame:
    named = standin.table(spark, d, "customer").join(
        standin.nations(spark, d), F.col("c_nationkey") == F.col("n_nationkey")
    )
    label = F.when(F.col("c_mktsegment") == "BUILDING", F.col("n_name")).otherwise(F.col("code"))
    return audit.columns_with_area_names(named.select("c_name", "code", label.alias("label")), standin.register(spark, d))


@query("code_present", with_tables(f"SELECT changed_from_code, changed_to_code, year FROM changes WHERE {IN_FLOWS}"))
def code_present(spark: SparkSession, d: str) -> DataFrame:
    return occurring(code_changes(spark), spark, d).select("changed_from_code", "changed_to_code", "year")


@query(
    "code_year_equals",
    with_tables(f"SELECT changed_from_code, changed_to_code, year FROM changes WHERE {IN_FLOWS} AND year = 2022"),
)
def code_year_equals(spark: SparkSession, d: str) -> DataFrame:
    of_year = filters.year_in_set(code_changes(spark), [2022])
    return occurring(of_year, spark, d).select("changed_from_code", "changed_to_code", "year")


@query(
    "changes_for_years",
    with_tables(
        f"""SELECT changed_from_code, changed_from_name, changed_to_code, changed_to_name, year, split, "merge"
            FROM changes WHERE year IN (2021, 2023) AND {IN_FLOWS}"""
    ),
)
def changes_for_years(spark: SparkSession, d: str) -> DataFrame:
    return occurring(audit.changes_for_years(code_changes(spark), [2021, 2023]), spark, d)


@query("lookup_chain_join", with_tables(f"SELECT * FROM forward_pairs WHERE {IN_FLOWS}"))
def lookup_chain_join(spark: SparkSession, d: str) -> DataFrame:
    return occurring(recode.walk_changes(code_changes(spark), OLD_VINTAGE, NEW_VINTAGE), spark, d)


@query("lookup_distinct_non_identity", with_tables(f"SELECT * FROM forward_distinct WHERE {IN_FLOWS}"))
def lookup_distinct_non_identity(spark: SparkSession, d: str) -> DataFrame:
    pairs = recode.walk_changes(code_changes(spark), OLD_VINTAGE, NEW_VINTAGE)
    return occurring(recode.distinct_changes(pairs), spark, d)


@query("split_code_list", with_tables(f"SELECT * FROM forward_lookup WHERE {IN_FLOWS} AND contains(changed_to_code, ',')"))
def split_code_list(spark: SparkSession, d: str) -> DataFrame:
    pairs = recode.distinct_changes(recode.walk_changes(code_changes(spark), OLD_VINTAGE, NEW_VINTAGE))
    labels = recode.split_code_list(pairs).where(F.col("changed_to_code").contains(","))
    return occurring(labels, spark, d)


@query("recode_lookup_forward", with_tables(f"SELECT * FROM forward_lookup WHERE {IN_FLOWS}"))
def recode_lookup_forward(spark: SparkSession, d: str) -> DataFrame:
    return occurring(recode.recode_lookup(code_changes(spark), OLD_VINTAGE, NEW_VINTAGE), spark, d)


@query(
    "recode_lookup_reverse",
    with_tables(
        f"""SELECT * FROM reverse_lookup
            WHERE changed_from_code IN (SELECT DISTINCT gss_in FROM ({recoded("SELECT * FROM flows", "gss_in", None)}))"""
    ),
)
def recode_lookup_reverse(spark: SparkSession, d: str) -> DataFrame:
    later = recode.relabel(flows_long(spark, d), "gss_in", forward(spark))
    reverse = recode.recode_lookup(code_changes(spark), NEW_VINTAGE, OLD_VINTAGE)
    return filters.code_present(reverse, "changed_from_code", later, "gss_in")


@query(
    "recode_reverse_sum",
    with_tables(
        """SELECT gss_out, coalesce(l.changed_to_code, gss_in) AS gss_in, year, sum(value) AS value
           FROM renamed LEFT JOIN reverse_lookup l ON gss_in = l.changed_from_code
           GROUP BY gss_out, coalesce(l.changed_to_code, gss_in), year""",
        renamed=recoded("SELECT * FROM flows", "gss_in", None),
    ),
)
def recode_reverse_sum(spark: SparkSession, d: str) -> DataFrame:
    later = recode.relabel(flows_long(spark, d), "gss_in", forward(spark))
    return recode.recode_gss(
        later.select("gss_out", "gss_in", "year", "value"),
        "gss_in",
        recode_from_year=NEW_VINTAGE,
        recode_to_year=OLD_VINTAGE,
        lad_code_changes=code_changes(spark),
    )


@query(
    "data_recode_join",
    with_tables(
        """SELECT gss_out, gss_in, sex, year, age, value, changed_to_code AS new_code
           FROM flows LEFT JOIN forward_lookup ON gss_in = changed_from_code"""
    ),
)
def data_recode_join(spark: SparkSession, d: str) -> DataFrame:
    return forward(spark).attach(flows_long(spark, d), "gss_in", {"changed_to_code": "new_code"}, "left")


@query("recode_apply", with_tables(recoded("SELECT * FROM flows", "gss_in", None)))
def recode_apply(spark: SparkSession, d: str) -> DataFrame:
    return recode.relabel(flows_long(spark, d), "gss_in", forward(spark))


def _recode(spark: SparkSession, df: DataFrame, column: str, measures: str | list[str], **options: object) -> DataFrame:
    return recode.recode_gss(
        df,
        column,
        measures,
        recode_from_year=OLD_VINTAGE,
        recode_to_year=NEW_VINTAGE,
        lad_code_changes=code_changes(spark),
        **options,
    )


@query("recode_sum", with_tables(recoded("SELECT * FROM flows", "gss_in")))
def recode_sum(spark: SparkSession, d: str) -> DataFrame:
    return _recode(spark, flows_long(spark, d), "gss_in", "value")


@query(
    "recode_sum_many",
    with_tables(
        'SELECT s.outla, coalesce(changed_to_code, s.inla) AS inla, s."Sex", s."Year", '
        + ", ".join(f'sum(s."Age_{a}") AS "Age_{a}"' for a in AGES)
        + ' FROM sheet s LEFT JOIN forward_lookup ON s.inla = changed_from_code GROUP BY 1, 2, 3, 4'
    ),
)
def recode_sum_many(spark: SparkSession, d: str) -> DataFrame:
    return _recode(spark, standin.sheet(spark, d), "inla", [f"Age_{a}" for a in AGES])


@query("recode_mean", with_tables(recoded("SELECT * FROM flows", "gss_in", "avg")))
def recode_mean(spark: SparkSession, d: str) -> DataFrame:
    return _recode(spark, flows_long(spark, d), "gss_in", "value", fun="mean")


@query("recode_no_aggregate", with_tables(recoded("SELECT * FROM flows", "gss_out", None)))
def recode_no_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return _recode(spark, flows_long(spark, d), "gss_out", "value", aggregate_data=False)


@query("recode_gss_in", with_tables("SELECT * FROM historical_in", **HISTORICAL))
def recode_gss_in(spark: SparkSession, d: str) -> DataFrame:
    return recode.recode_end(old_series(spark, d), "gss_in", forward(spark))


@query("recode_gss_out", with_tables("SELECT * FROM historical_both", **HISTORICAL))
def recode_gss_out(spark: SparkSession, d: str) -> DataFrame:
    lookup = forward(spark)
    return recode.recode_end(recode.recode_end(old_series(spark, d), "gss_in", lookup), "gss_out", lookup)


@query("recode_both_ends", with_tables("SELECT * FROM historical_both", **HISTORICAL))
def recode_both_ends(spark: SparkSession, d: str) -> DataFrame:
    return recode.recode_both_ends(old_series(spark, d), forward(spark))


@query("recode_both_ends_unique", with_tables("SELECT * FROM historical_both", **HISTORICAL))
def recode_both_ends_unique(spark: SparkSession, d: str) -> DataFrame:
    return recode.recode_both_ends(old_series(spark, d), forward(spark), unique_keys=True)


BEFORE = "SELECT DISTINCT gss_in AS code FROM flows"
AFTER = f"SELECT DISTINCT gss_in AS code FROM ({recoded('SELECT * FROM flows', 'gss_in')})"


def sides(spark: SparkSession, d: str) -> DataFrame:
    return audit.recode_sides(flows_long(spark, d), "gss_in", forward(spark), recode.TO)


@query(
    "added_removed_codes",
    with_tables(
        f"""SELECT 'removed' AS change, code FROM ({BEFORE} EXCEPT {AFTER})
            UNION ALL SELECT 'added', code FROM ({AFTER} EXCEPT {BEFORE})
            UNION ALL SELECT 'n_before', CAST(count(*) AS VARCHAR) FROM ({BEFORE})
            UNION ALL SELECT 'n_after', CAST(count(*) AS VARCHAR) FROM ({AFTER})"""
    ),
)
def added_removed_codes(spark: SparkSession, d: str) -> DataFrame:
    return audit.added_and_removed(sides(spark, d))


@query(
    "changed_codes",
    with_tables(
        f"""SELECT coalesce(b.code, a.code) AS code,
                   CASE WHEN a.code IS NULL THEN 'left_only' ELSE 'right_only' END AS side
            FROM ({BEFORE}) b FULL OUTER JOIN ({AFTER}) a ON b.code = a.code
            WHERE a.code IS NULL OR b.code IS NULL"""
    ),
)
def changed_codes(spark: SparkSession, d: str) -> DataFrame:
    return audit.only_changed(sides(spark, d))


@query("code_difference", with_tables(f"{AFTER} EXCEPT {BEFORE}"))
def code_difference(spark: SparkSession, d: str) -> DataFrame:
    return sides(spark, d).where("side = 'right_only'").select("code")


@query(
    "combine_series",
    with_tables(
        f"""SELECT gss_out, gss_in, sex, year, age, value
            FROM (SELECT * FROM historical_both UNION ALL SELECT * FROM ({UNPIVOTED}))
            WHERE gss_in IS DISTINCT FROM gss_out""",
        **HISTORICAL,
    ),
)
def combine_series(spark: SparkSession, d: str) -> DataFrame:
    return combine(flows_long(spark, d), standin.new_sheet(spark, d), code_changes(spark), CUTOVER)
