"""Writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from odflux.sources.readers import RFC_QUOTES


@dataclass(frozen=True)
class WriteSummary:
    rows: int
    partitions: int


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **RFC_QUOTES).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, root: str, column: str = "year", rebalance: bool = True) -> WriteSummary:
    """One folder per year; a second run replaces the years it holds and no others.

    The rebalance brings a year's rows together but cuts a large year into
    files of the advisory size, so no task has to hold one. Where every task
    already holds enough of each year to fill a file, ``rebalance=False``
    saves that shuffle. Rows without a year are left out. The counts are
    observed while writing, not by another job; the set of years is as small
    as the list of folders.
    """
    seen = Observation()
    rows = df.where(F.col(column).isNotNull())
    if rebalance:
        rows = rows.hint("rebalance", column)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(column).alias("parts"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(root)
    )
    return WriteSummary(rows=seen.get["n"], partitions=len(seen.get["parts"]))


def write_summary(df: DataFrame, column: str = "year") -> DataFrame:
    """The counts of ``write_partitioned`` as a table, for data already written."""
    present = df.where(F.col(column).isNotNull())
    return present.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(column).alias("n_partitions"))
