"""Download links in a table of web pages (page_id, url, html)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.functions.text import absolute_url, anchor_tags, basename, first_year, href_of


def harvest_links(pages: DataFrame, containing: str = "") -> DataFrame:
    """Every href that holds the text, in document order, repeats kept."""
    tags = pages.select("page_id", F.posexplode(anchor_tags(F.col("html"))).alias("pos", "tag"))
    links = tags.select("page_id", "pos", href_of(F.col("tag")).alias("href"))
    return links.where(F.col("href").contains(containing))


def with_url(links: DataFrame, base: str) -> DataFrame:
    return links.withColumn("link_url", absolute_url(base, F.col("href")))


def with_file_name(links: DataFrame, column: str = "link_url") -> DataFrame:
    return links.withColumn("file_name", basename(F.col(column)))


def with_year(links: DataFrame, column: str = "link_url") -> DataFrame:
    """Year in the address; links without one are left out."""
    return links.withColumn("year", first_year(F.col(column))).where(F.col("year").isNotNull())


def first_link_per_year(links: DataFrame) -> DataFrame:
    """Earliest link of each year, years ascending; a partial aggregate, not a window sort."""
    first = F.min_by(F.struct("page_id", "pos", "link_url"), F.struct("page_id", "pos"))
    return links.groupBy("year").agg(first.alias("f")).select("year", "f.page_id", "f.pos", "f.link_url").orderBy("year")
