"""Tables written once to the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from odflux.sources.workdir import fresh_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back: later jobs start from the files."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffles(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
