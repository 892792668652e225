"""Download links over the pages table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.functions.text import output_name
from odflux.operators import links
from workload.registry import query
from workload.standin import LINK_BASE, LINK_TEXT, table

HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAGS = f"""
    SELECT page_id, unnest(tags) AS href, CAST(unnest(range(len(tags))) AS INTEGER) AS pos
    FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '{HIDDEN}', '', 'g'), '<a href="([^"]*)"', 1) AS tags
          FROM pages)"""
ANCHORS = f"SELECT page_id, pos, replace(href, '&amp;', '&') AS href FROM ({TAGS})"
# No href of the pages holds a year, so the ones in lower case get one.
DETAIL = """CASE WHEN NOT regexp_matches(href, '^/[a-z]') THEN href
                 ELSE href || '/detail' || CAST(2012 + (page_id + pos) % 12 AS VARCHAR) || 'on2021and2023.xlsx' END"""
DATED = f"SELECT page_id, pos, '{LINK_BASE}' || {DETAIL} AS link_url FROM ({ANCHORS})"
WITH_YEAR = f"""
    SELECT * FROM (SELECT page_id, pos, link_url,
                          TRY_CAST(regexp_extract(link_url, '(20[0-9][0-9])', 1) AS INTEGER) AS year FROM ({DATED}))
    WHERE year IS NOT NULL"""


def dated(spark: SparkSession, d: str) -> DataFrame:
    found = links.harvest_links(table(spark, d, "pages"))
    year = (2012 + (F.col("page_id") + F.col("pos")) % 12).cast("string")
    release = F.concat(F.col("href"), F.lit("/detail"), year, F.lit("on2021and2023.xlsx"))
    href = F.when(F.col("href").rlike("^/[a-z]"), release).otherwise(F.col("href"))
    return links.with_url(found.withColumn("href", href), LINK_BASE).drop("href")


@query("link_harvest", f"SELECT * FROM ({ANCHORS}) WHERE contains(href, '{LINK_TEXT}')")
def link_harvest(spark: SparkSession, d: str) -> DataFrame:
    return links.harvest_links(table(spark, d, "pages"), LINK_TEXT)


@query("link_absolute", f"SELECT *, '{LINK_BASE}' || href AS link_url FROM ({ANCHORS})")
def link_absolute(spark: SparkSession, d: str) -> DataFrame:
    return links.with_url(links.harvest_links(table(spark, d, "pages")), LINK_BASE)


@query("path_basename", f"SELECT *, regexp_extract(link_url, '[^/]*$') AS file_name FROM ({DATED})")
def path_basename(spark: SparkSession, d: str) -> DataFrame:
    return links.with_file_name(dated(spark, d))


@query("link_year", WITH_YEAR)
def link_year(spark: SparkSession, d: str) -> DataFrame:
    return links.with_year(dated(spark, d))


@query(
    "first_link_per_year",
    f"""SELECT year, page_id, pos, link_url FROM ({WITH_YEAR})
        QUALIFY row_number() OVER (PARTITION BY year ORDER BY page_id, pos) = 1 ORDER BY year""",
)
def first_link_per_year(spark: SparkSession, d: str) -> DataFrame:
    return links.first_link_per_year(links.with_year(dated(spark, d)))


@query(
    "output_name_rewrite",
    f"""SELECT page_id, pos, file_name, 'clean_' || replace(replace(replace(file_name, '2021and2023', '2023'),
               '.xlsx', '.csv'), '.xls', '.csv') AS output_name
        FROM (SELECT *, regexp_extract(link_url, '[^/]*$') AS file_name FROM ({DATED}))""",
)
def output_name_rewrite(spark: SparkSession, d: str) -> DataFrame:
    named = links.with_file_name(dated(spark, d)).select("page_id", "pos", "file_name")
    return named.withColumn("output_name", output_name(F.col("file_name"), prefix="clean_"))
