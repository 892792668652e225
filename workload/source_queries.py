"""Scans and sinks: what is written must read back as the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.schemas import FLOWS_LONG
from odflux.sources import readers, releases, sinks
from odflux.sources.workdir import fresh_path
from workload import standin
from workload.registry import query
from workload.sql import with_tables
from workload.standin import AGES, CUTOVER, flows_long

FLOWS = with_tables("SELECT gss_out, gss_in, sex, year, age, value FROM flows")
ORDER = ["gss_out", "gss_in", "sex", "year", "age"]


@query(
    "file_listing_by_suffix",
    with_tables(
        f"SELECT year, CAST(1 AS BIGINT) AS n_files, count(*) AS n, sum(value) AS value FROM flows WHERE year < {CUTOVER} GROUP BY year"
    ),
)
def file_listing_by_suffix(spark: SparkSession, d: str) -> DataFrame:
    """One CSV file a year up to a year and Parquet from it on: the files listed for one suffix, and the rows read by it."""
    root = fresh_path(spark, "by_suffix")
    flows = flows_long(spark, d)
    old = flows.where(F.col("year") < CUTOVER).withColumn("folder", F.col("year")).repartition("folder")
    old.write.option("header", True).partitionBy("folder").csv(f"{root}/old")
    sinks.write_parquet(flows.where(F.col("year") >= CUTOVER), f"{root}/new")
    year = F.regexp_extract("path", "/folder=([0-9]+)/", 1).cast("int").alias("year")
    files = readers.list_files(spark, root, ".csv").groupBy(year).agg(F.count(F.lit(1)).alias("n_files"))
    found = readers.read_files(spark, root, FLOWS_LONG, ".csv")
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).join(files, "year")


@query("parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def parquet_scan(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_parquet(spark, f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query("csv_scan", FLOWS)
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "flows_csv")
    sinks.write_csv(flows_long(spark, d), path)
    return readers.read_csv(spark, path, FLOWS_LONG)


@query(
    "csv_sample",
    with_tables(
        "SELECT gss_out, gss_in, sex, year, age, value FROM od_flows ORDER BY gss_out, gss_in, sex, year, age LIMIT 100"
    ),
)
def csv_sample(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "flows_csv")
    sinks.write_csv(standin.od_flows(spark, d), path)
    return readers.sample_csv(spark, path, FLOWS_LONG, 100, ORDER)


@query("csv_sink", with_tables("SELECT gss_in, sum(value) AS value, count(*) AS n FROM flows GROUP BY gss_in"))
def csv_sink(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "flows_csv")
    sinks.write_csv(flows_long(spark, d), path)
    back = readers.read_csv(spark, path, FLOWS_LONG)
    return back.groupBy("gss_in").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))


@query("parquet_sink", FLOWS)
def parquet_sink(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "flows")
    sinks.write_parquet(flows_long(spark, d), path)
    return readers.read_parquet(spark, path, FLOWS_LONG)


@query("partitioned_sink", FLOWS)
def partitioned_sink(spark: SparkSession, d: str) -> DataFrame:
    """All years written once, the later ones a second time."""
    root = fresh_path(spark, "flows_by_year")
    sinks.write_partitioned(flows_long(spark, d), root)
    sinks.write_partitioned(flows_long(spark, d).where(F.col("year") >= CUTOVER), root)
    return readers.read_partitioned(spark, root)


@query(
    "partitioned_scan",
    with_tables(f"SELECT gss_out, gss_in, sex, year, age, value FROM flows WHERE year = {CUTOVER}"),
)
def partitioned_scan(spark: SparkSession, d: str) -> DataFrame:
    root = fresh_path(spark, "flows_by_year")
    sinks.write_partitioned(flows_long(spark, d), root)
    return readers.read_partitioned(spark, root).where(F.col("year") == CUTOVER)


@query("write_summary", with_tables("SELECT count(*) AS n_rows, count(DISTINCT year) AS n_partitions FROM flows"))
def write_summary(spark: SparkSession, d: str) -> DataFrame:
    """What the write itself counted."""
    done = sinks.write_partitioned(flows_long(spark, d), fresh_path(spark, "flows_by_year"))
    return spark.createDataFrame([(done.rows, done.partitions)], "n_rows long, n_partitions long")


@query("skip_unreadable_files", FLOWS)
def skip_unreadable_files(spark: SparkSession, d: str) -> DataFrame:
    """Flow files next to files that are not Parquet at all."""
    root = fresh_path(spark, "mixed")
    sinks.write_parquet(flows_long(spark, d), f"{root}/part=flows")
    standin.table(spark, d, "pages").select("url").write.text(f"{root}/part=pages")
    return readers.read_parquet(spark, root, FLOWS_LONG, skip_unreadable=True).drop("part")


@query(
    "combine_cleaned",
    with_tables(
        'SELECT outla, inla, "Sex" AS sex, "Year" AS year, '
        + ", ".join(f'"Age_{a}" AS age_{a}' for a in AGES[:-1])
        + f', CASE WHEN "Year" < {CUTOVER} THEN "Age_7" END AS age_7 FROM sheet'
    ),
)
def combine_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Two releases: capital headers with all ages, and small ones without the last age."""
    root = fresh_path(spark, "cleaned")
    sheet = standin.sheet(spark, d)
    sinks.write_csv(sheet.where(F.col("Year") < CUTOVER).coalesce(2), f"{root}/old")
    later = sheet.where(F.col("Year") >= CUTOVER).drop("Age_7")
    sinks.write_csv(later.toDF(*[c.lower() for c in later.columns]).coalesce(2), f"{root}/new")
    return releases.combine_cleaned(spark, root)


def _raw_sheets(spark: SparkSession, d: str) -> str:
    """Sheets with gaps, of one name in two folders and with different headers, beside one that is no sheet."""
    raw = fresh_path(spark, "raw")
    sheet = standin.sheet(spark, d, fill=False)
    old, new = (sheet.where(F.col("Year") < CUTOVER), sheet.where(F.col("Year") >= CUTOVER))
    for folder, part in (("old", old), ("new", new.select("inla", "outla", *new.columns[2:]))):
        named = part.withColumn("name", F.lit("flows.csv")).coalesce(1)
        named.write.option("header", True).partitionBy("name").csv(f"{raw}/{folder}")
    standin.table(spark, d, "pages").select("url").coalesce(1).write.option("header", True).csv(f"{raw}/noise")
    return raw


@query(
    "clean_sheets",
    with_tables(
        'SELECT outla, inla, "Sex" AS sex, "Year" AS year, '
        + ", ".join(f'"Age_{a}" AS age_{a}' for a in AGES)
        + " FROM sheet_gaps WHERE "
        + " AND ".join(f'"Age_{a}" IS NOT NULL' for a in AGES)
    ),
)
def clean_sheets(spark: SparkSession, d: str) -> DataFrame:
    raw, clean = _raw_sheets(spark, d), fresh_path(spark, "clean")
    releases.clean_sheets(spark, raw, clean, prefix="clean_", skip_unreadable=True, needs=("outla", "inla"))
    return releases.combine_cleaned(spark, clean)


FULL = " AND ".join(f'"Age_{a}" IS NOT NULL' for a in AGES)


@query(
    "clean_report",
    with_tables(
        f"""SELECT CASE WHEN "Year" < {CUTOVER} THEN 'old' ELSE 'new' END AS folder, count(*) AS n_read,
            count(*) FILTER (WHERE NOT ({FULL})) AS n_gaps, count(*) FILTER (WHERE {FULL}) AS n_written,
            'written' AS status, CAST(NULL AS VARCHAR) AS reason FROM sheet_gaps GROUP BY ALL
        UNION ALL
        SELECT 'noise', count(*), 0, 0, 'skipped', 'lacks columns' FROM pages"""
    ),
)
def clean_report(spark: SparkSession, d: str) -> DataFrame:
    """A row for each sheet of a cleaning run: records read, left out and written, or why it was skipped."""
    done = releases.clean_sheets(spark, _raw_sheets(spark, d), fresh_path(spark, "clean"), skip_unreadable=True, needs=("outla", "inla"))
    folder = F.regexp_extract("source", "^[^/]*", 0).alias("folder")
    return done.report.select(folder, "n_read", "n_gaps", "n_written", "status", "reason")


@query(
    "read_report",
    with_tables(
        f"""SELECT 'flows' AS part, CAST(sum(n) AS BIGINT) AS n_rows, 'read' AS status FROM (SELECT count(*) AS n FROM flows)
        UNION ALL SELECT 'pages', 0, 'unreadable' FROM (SELECT 1 FROM pages LIMIT 1)"""
    ),
)
def read_report(spark: SparkSession, d: str) -> DataFrame:
    """Flow files next to files that are not Parquet at all, with the state of every file."""
    root = fresh_path(spark, "mixed")
    sinks.write_parquet(flows_long(spark, d).coalesce(1), f"{root}/part=flows")
    standin.table(spark, d, "pages").select("url").coalesce(1).write.text(f"{root}/part=pages")
    part = F.regexp_extract("path", "/part=([a-z]+)/", 1).alias("part")
    report = readers.parquet_report(spark, root, FLOWS_LONG)
    return report.select(part, F.col("n_read").alias("n_rows"), "status")
